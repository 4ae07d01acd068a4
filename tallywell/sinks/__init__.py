from .audit import folder_bytes, sink_audit
from .jdbc import write_jdbc
from .lake import between_dates, by_date, date_unit, write_parquet

__all__ = [
    "between_dates",
    "by_date",
    "date_unit",
    "folder_bytes",
    "sink_audit",
    "write_jdbc",
    "write_parquet",
]
