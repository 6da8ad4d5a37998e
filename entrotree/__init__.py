"""entrotree: entropy-based decision-tree analytics as Spark DataFrame jobs."""

from entrotree.operators.binary import fit_binary
from entrotree.operators.counts import class_histogram, compact_rows, contingency, unpivot_features
from entrotree.operators.entropy import (best_feature, dataset_entropy, feature_scores,
                                         label_stats, value_stats, weighted_scores)
from entrotree.operators.grow import fit_id3
from entrotree.operators.metrics import confusion_counts, confusion_matrix, label_metrics, summary
from entrotree.operators.prep import bin_occupancy, column_bounds, equal_width_bins, select_features
from entrotree.operators.score import leaf_labels, predict, tree_listing
from entrotree.operators.validate import (assign_equal_folds, assign_folds, cross_validate, exact_split,
                                          feature_group_error, keyed_split, random_split, split_frames)
from entrotree.sources.delimited import infer_kinds, read_binned_csv, read_lines_as_fields, typed_fields

__version__ = "0.1.0"

__all__ = [
    "assign_equal_folds", "assign_folds", "best_feature", "bin_occupancy", "class_histogram", "column_bounds",
    "compact_rows", "confusion_counts", "confusion_matrix", "contingency", "cross_validate",
    "dataset_entropy", "equal_width_bins", "exact_split", "feature_group_error", "feature_scores", "fit_binary",
    "fit_id3", "infer_kinds", "keyed_split", "label_metrics", "label_stats", "leaf_labels", "predict",
    "random_split", "read_binned_csv", "read_lines_as_fields", "select_features", "split_frames", "summary",
    "tree_listing", "typed_fields", "unpivot_features", "value_stats", "weighted_scores",
]
