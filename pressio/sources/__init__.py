"""Sources and sinks: declared schemas, readers, writers, driver-table adapters."""

from . import adapters, schemas
from .io import (observe_rejects, publish_csv, publish_frame, read_result, read_table,
                 read_with_rejects, reject_counts, write_result)

__all__ = ["adapters", "schemas", "publish_csv", "publish_frame", "read_result",
           "read_table", "write_result", "observe_rejects", "read_with_rejects", "reject_counts"]
