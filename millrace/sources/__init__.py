from .control_json import import_control_records, read_batch_records, read_watermark_record
from .csv import group_by_header, read_csv_batch, sniff_files, sniff_headers
from .manifest import MANIFEST_SCHEMA, hidden_files, list_files, stream_files
from .tables import TEST_TABLES, read_curated, test_table

__all__ = ["import_control_records", "read_batch_records", "read_watermark_record",
           "sniff_headers", "group_by_header", "read_csv_batch", "MANIFEST_SCHEMA",
           "list_files", "stream_files", "TEST_TABLES", "read_curated", "test_table",
           "hidden_files", "sniff_files"]
