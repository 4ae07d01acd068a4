from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import valid_rows
from ..settings import Source
from ..sources.messages import stream_messages


def stream_clean(spark: SparkSession, source: Source, topic: str) -> DataFrame:
    """A topic as a stream of valid, normalized rows; copies of an id included."""
    return valid_rows(stream_messages(spark, source), topic)


def stream_dedup(
    rows: DataFrame, key: str, time: str, delay: str, salts: int = 1
) -> DataFrame:
    """The first arrival of each id among copies at most ``delay`` apart.

    State is kept for ``delay`` only. Unlike in batch, which keeps the latest copy, a
    later copy cannot take back a row already emitted; copies that differ need
    :func:`stream_latest` or :func:`~tallywell.streaming.sinks.stream_to_sinks`.

    A stream cannot drop copies before the shuffle. Where one id has very many copies that differ,
    ``salts`` above one first drops equal ones in that many shares, dealt by the whole row, and only
    the rest by id alone, at the price of a second state.
    """
    marked = rows.withWatermark(time, delay)
    if salts > 1:
        marked = (
            marked.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
            .dropDuplicatesWithinWatermark([key, "salt"])
            .drop("salt")
        )
    return marked.dropDuplicatesWithinWatermark([key])


def stream_latest(rows: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The latest copy of each id, for update mode: a batch puts out the latest row of each id it brings.

    The order is that of :func:`~tallywell.operators.dedup.dedup_latest`: greatest by ``order_by``, then by the other columns, nulls
    last. State holds one row per id, whatever the number of copies, and drops none: a correction may come
    after any time. Copies meet as one row per task. What comes out replaces what came out for that id before, which is how a later copy takes an earlier one back;
    :func:`~tallywell.streaming.log.write_updates` logs it so and :func:`~tallywell.streaming.log.latest_updates` reads it.
    """
    rest = [c for c in rows.columns if c not in (key, *order_by)]
    ordered = [*order_by, *rest]
    # a struct's null fields are its least
    best = rows.groupBy(key).agg(F.max(F.struct(*ordered)).alias("latest"))
    return best.select(*(F.col(key) if c == key else F.col(f"latest.{c}") for c in rows.columns))
