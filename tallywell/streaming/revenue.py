"""KPIs per event-time window, kept up to date in streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.kpis import (
    PERIOD,
    group_totals,
    key_measures,
    shape_category,
    shape_country,
    shape_segments,
    shape_top,
)
from ..operators.windows import window_top
from .log import BATCH, kpi_schema, read_batches, write_batch

# KPI table: join key, attribute of the dimension, columns
_SHAPES = {
    "kpi_revenue_by_category": ("product_id", "category", shape_category),
    "kpi_revenue_by_country": ("client_id", "country", shape_country),
    "kpi_customer_segments": ("client_id", "segment", shape_segments),
}


def stream_windowed_revenue(
    kpi: str,
    transactions: DataFrame,
    dimension: DataFrame,
    width: str = "1 day",
    delay: str | None = None,
    orphans: str = "keep",
) -> DataFrame:
    """A KPI table as a streaming aggregate over windows of ``width``, for append mode.

    As in batch, transactions are first summed per window and key, here in state, so a hot
    key reaches the join as one row per window, and distinct clients are an exact count of
    rows. The dimension is joined as a static table with one row per id.

    ``delay`` sets the watermark; leave it out when the stream already has one. A window
    comes out once, when the watermark has passed its end, and takes no more rows then; windows
    still open at the end of the stream do not come out. Top products are ranked as windows close, see
    :func:`stream_top_products`.
    """
    if kpi not in _SHAPES:
        raise ValueError(f"no streaming form of {kpi!r}, only of {', '.join(_SHAPES)}")
    key, attribute, shape = _SHAPES[kpi]
    totals = _totals(transactions, key, width, delay)
    again = F.window("period", width).alias("period")
    groups = group_totals(totals, dimension, key, attribute, orphans, [again])
    return shape(groups, F.col("period.start"), F.col("period.end"))


def _totals(transactions: DataFrame, key: str, width: str, delay: str | None) -> DataFrame:
    """Totals per window and key, in state."""
    if delay is not None:
        transactions = transactions.withWatermark("transaction_time", delay)
    period = F.window("transaction_time", width).alias("period")
    return transactions.groupBy(period, key).agg(*key_measures())


# --- top products -------------------------------------------------------------


def stream_top_products(
    transactions: DataFrame,
    products: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 day",
    limit: int = 20,
    delay: str | None = None,
    orphans: str = "keep",
    trigger: str | None = None,
) -> StreamingQuery:
    """Start a query that logs the top products of each window as it closes.

    State holds a window's totals per product. When the watermark passes the window's end, all of them come out
    in one batch, which ranks them as the batch operator does, in shares first: only ``limit`` rows of each share
    meet, so a window may hold any number of products. Equal units go by product id.

    A window comes out once, as in :func:`stream_windowed_revenue`; a batch that is run again replaces its
    rows. ``trigger`` is the query's interval, none means all there is, then stop.
    """
    totals = _totals(transactions, "product_id", width, delay)

    def rank(closed: DataFrame, batch_id: int) -> None:
        named = closed.select(F.col("period.start").alias(PERIOD[0]), F.col("period.end").alias(PERIOD[1]), "*")
        best = window_top(named.drop("period"), products, limit, orphans)
        write_batch(shape_top(best, F.col(PERIOD[0]), F.col(PERIOD[1])), path, batch_id)

    writer = totals.writeStream.foreachBatch(rank).option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def closed_top_products(spark: SparkSession, path: str) -> DataFrame:
    """The top products of all windows that have closed."""
    return read_batches(spark, path, kpi_schema("kpi_top_products")).drop(BATCH)
