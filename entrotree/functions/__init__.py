"""Column expressions (all JVM-side, codegen friendly)."""

from entrotree.functions.exprs import (  # noqa: F401
    NULL_BRANCH,
    binary_path,
    child_path,
    entropy_from_sums,
    equal_width_bin,
    feature_index,
    keyed_fold,
    keyed_hash,
    keyed_train_flag,
    nlog2n,
    pick_feature,
)
