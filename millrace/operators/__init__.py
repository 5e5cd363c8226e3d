from .conform import (COLUMN_ALIASES, EXPECTED_SCHEMA, ConformError, conform,
                      lowercase_columns, rename_fixed, resolve_aliases, stamp_batch,
                      transform_v1, transform_v2)
from .incremental import batch_identity, in_window, run_cutoff, select_new_files
from .islands import islands, runs
from .joins import equi_join, join_cardinality
from .positions import global_lag, global_row_number
from .quality import quality_counts, split_by_key
from .ranking import top_n_per_group, top_n_sum
from .ratios import ratio_to_max
from .series import declines, ordered_lag

__all__ = [
    "COLUMN_ALIASES", "EXPECTED_SCHEMA", "ConformError", "conform", "lowercase_columns",
    "rename_fixed", "resolve_aliases", "stamp_batch", "transform_v1", "transform_v2",
    "batch_identity", "in_window", "run_cutoff", "select_new_files", "islands", "runs",
    "equi_join", "join_cardinality", "quality_counts", "split_by_key",
    "top_n_per_group", "top_n_sum", "ratio_to_max", "declines", "ordered_lag",
    "global_lag", "global_row_number",
]
