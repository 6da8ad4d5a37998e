"""Sources: delimited text (S1-S3), parquet tables, and the derived fixture views."""

from entrotree.sources.delimited import read_binned_csv, read_lines_as_fields  # noqa: F401
from entrotree.sources.fixtures import doc_bins, ev_bins, li_bins  # noqa: F401
from entrotree.sources.tables import read_table  # noqa: F401
