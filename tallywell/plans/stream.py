from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_clients, clean_products
from ..settings import Settings
from ..sources.messages import read_messages
from ..streaming.clean import stream_clean
from ..streaming.sinks import stream_to_sinks
from .store import store_clean


def start_stream(
    spark: SparkSession, settings: Settings, until_empty: bool = False
) -> StreamingQuery:
    """Clients and products as they are now, transactions as they come.

    ``until_empty`` works through what the topic holds and then stops, instead of
    waiting for more.
    """
    sources = settings.sources
    dimensions = store_clean(
        {
            "clients": clean_clients(read_messages(spark, sources["clients"])),
            "products": clean_products(read_messages(spark, sources["products"])),
        },
        settings.lake,
        settings.jdbc,
    )
    return stream_to_sinks(
        stream_clean(spark, sources["transactions"], "transactions"),
        dimensions["clients"],
        dimensions["products"],
        settings.lake,
        settings.checkpoint or f"{settings.lake}/checkpoints/transactions",
        width=settings.window,
        limit=settings.top,
        horizon=settings.horizon,
        trigger=None if until_empty else settings.trigger,
        jdbc=settings.jdbc,
    )
