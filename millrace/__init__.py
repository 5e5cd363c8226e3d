"""millrace: incremental file ingestion and tabular analytics on Spark.

Sub-packages: ``sources`` (file manifests, header-aware CSV, tables, JSON
control records), ``operators`` (conform, quality, incremental window, top-N,
islands, ordered lag, ratios, join cardinality), ``functions`` (null-safe
conversions, value helpers), ``sinks`` (curated/quarantine tables, ledger),
``plans`` (the ingest job and the registered queries), ``streaming``
(file-stream front end). The names below are the everyday API.
"""

from .functions import legacy_integral, parse_date, safe_ratio, swap_values, to_type
from .operators import (conform, declines, equi_join, in_window, islands, join_cardinality,
                        ordered_lag, quality_counts, ratio_to_max, runs, select_new_files,
                        split_by_key, top_n_per_group, top_n_sum, transform_v1, transform_v2)
from .plans.ingest import IngestConfig, plan_batch, process_batch, run_batch
from .session import build_session, shared_root
from .sources import list_files, read_csv_batch, read_curated

__version__ = "0.1.0"

__all__ = [
    "legacy_integral", "parse_date", "safe_ratio", "swap_values", "to_type",
    "conform", "declines", "equi_join", "in_window", "islands", "join_cardinality",
    "ordered_lag", "quality_counts", "ratio_to_max", "runs", "select_new_files",
    "split_by_key", "top_n_per_group", "top_n_sum", "transform_v1", "transform_v2",
    "IngestConfig", "plan_batch", "process_batch", "run_batch",
    "build_session", "shared_root", "list_files", "read_csv_batch", "read_curated",
]
