from .clean import stream_clean, stream_dedup, stream_latest
from .log import latest_updates, read_batches, write_updates
from .revenue import closed_top_products, stream_top_products, stream_windowed_revenue
from .sinks import current_kpi, current_transactions, stream_to_sinks

__all__ = [
    "closed_top_products",
    "current_kpi",
    "current_transactions",
    "latest_updates",
    "read_batches",
    "stream_clean",
    "stream_dedup",
    "stream_latest",
    "stream_to_sinks",
    "stream_top_products",
    "stream_windowed_revenue",
    "write_updates",
]
