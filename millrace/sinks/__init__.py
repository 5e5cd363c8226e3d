from .ledger import (ABANDONED, FAILED, NO_FILES, PLANNED, RELEASED, SUCCESS, WATERMARK, abandon_batch,
                     advance_watermark, batch_files, batch_states, control_state, current_watermark,
                     file_rows, latest_batch, ledger_rows, pending_batch, record_batch, record_files,
                     taken_files, watermark)
from .tables import (quarantine_path, record_schema, recorded_schema, write_curated,
                     write_quarantine)

__all__ = ["ABANDONED", "FAILED", "NO_FILES", "PLANNED", "RELEASED", "SUCCESS", "WATERMARK",
           "abandon_batch", "advance_watermark", "batch_files", "batch_states", "control_state",
           "current_watermark", "file_rows", "latest_batch", "ledger_rows", "pending_batch",
           "record_batch", "record_files", "taken_files", "watermark", "quarantine_path",
           "record_schema", "recorded_schema", "write_curated", "write_quarantine"]
