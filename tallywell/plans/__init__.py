from .intake import merged_clean, take_in
from .publish import publish_synthetic
from .run import RunResult, run, run_summary
from .store import store_clean, store_kpis
from .stream import start_stream

__all__ = [
    "RunResult",
    "merged_clean",
    "publish_synthetic",
    "run",
    "run_summary",
    "start_stream",
    "store_clean",
    "store_kpis",
    "take_in",
]
