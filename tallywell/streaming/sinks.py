"""Micro-batches of transactions to the lake and the database.

The lake holds the valid rows, the latest for each id, by date under the batch that
brought them; finished batches are merged. Of all rows with one id the latest by event time counts, as in batch, so a batch may take an earlier row
out of its window. Each batch therefore recomputes the windows that hold any row
with one of its ids, from the lake and with the batch operators: exact distinct
clients and top products included.

Which dates hold rows with an id is kept in an index by hash of the id, of which a batch reads the
buckets of its own ids. Where an id has rows on several dates, its latest row is also kept under the others, as a moved
row. A date's rows and moved rows thus tell which of them count, and a batch reads the dates
of its ids and windows only, however long the log and however far apart the copies. A KPI's current table is, for each window, what
the last batch to touch it computed; a window left without rows has none. The
database gets the touched windows and the batch's ids in place of what it has of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import ENTITIES
from ..operators.dedup import dedup_latest
from ..operators.windows import BY_PRODUCT, period_totals, windowed_kpi
from ..schemas import KPI_NAMES
from ..scratch import store_at
from ..settings import JdbcTarget
from ..sinks.jdbc import replace_rows, storable
from ..sinks.lake import DATE
from .log import (
    BATCH,
    BUCKET,
    bucketed,
    drop_merged,
    due_merges,
    kpi_schema,
    parts_of,
    read_batches,
    read_buckets,
    write_batch,
    write_merged,
)

_ID = ENTITIES["transactions"].key
_ORDER = ENTITIES["transactions"].order_by
_DATES = T.StructType([T.StructField(_ID, T.StringType()), T.StructField(DATE, T.DateType())])
_TOUCHED = T.StructType([T.StructField("window_start", T.TimestampType())])


def _rows_path(lake: str) -> str:
    return f"{lake}/transactions_log"


def _moved_path(lake: str) -> str:
    return f"{lake}/moved_log"


def _dates_path(lake: str) -> str:
    return f"{lake}/dates_log"


def _touched_path(lake: str) -> str:
    return f"{lake}/windows_log"


def _kpi_path(lake: str, kpi: str) -> str:
    return f"{lake}/kpis_log/{kpi}"


def _rows_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DATE, T.DateType())])


def stream_to_sinks(
    transactions: DataFrame,
    clients: DataFrame,
    products: DataFrame,
    lake: str,
    checkpoint: str,
    width: str = "1 day",
    limit: int = 20,
    horizon: str | None = None,
    trigger: str | None = None,
    jdbc: JdbcTarget | None = None,
    merge_every: int = 64,
    log_unit: str = "day",
) -> StreamingQuery:
    """Start the query; ``trigger`` is its interval, none means all there is, then stop.

    ``transactions`` are the rows of :func:`~tallywell.streaming.clean.stream_clean`.
    ``horizon`` promises that copies of an id lie at most that far apart in event
    time; a batch then reads the dates that such copies and their windows can be
    on, and keeps no index. Without it a batch looks up the dates of its ids. A lake stays with the
    choice it began with. Before every ``merge_every``-th batch so many earlier ones are
    merged. ``log_unit`` (day, month, year) is what the log is partitioned by: the smallest
    that still fills a file.
    """
    schema = transactions.schema
    dimensions = {
        kpi: products if kpi in BY_PRODUCT else clients
        for kpi in KPI_NAMES
    }

    def store(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        for merge in due_merges(batch_id, merge_every):
            _merge(spark, lake, schema, merge, merge_every, horizon is None)
        # one row per id and batch: a hot id adds no more than that to the log
        batch = dedup_latest(rows, _ID, _ORDER).withColumn(DATE, _date("transaction_time", log_unit))
        batch = write_batch(batch, _rows_path(lake), batch_id, DATE)
        start = F.window("transaction_time", width)["start"].alias("window_start")

        log = read_batches(spark, _rows_path(lake), _rows_schema(schema))
        if horizon is None:
            dates = batch.select(_ID, DATE)
            write_batch(bucketed(dates, _ID, 0, merge_every), _dates_path(lake), batch_id, BUCKET)
            dates = store_at(dates_of(spark, lake, batch, batch_id, merge_every), f"{lake}/_dates")
            held = on_dates(log, dates).drop(BATCH)
            # rows as a whole are dealt by id once, and none are stored; windows need the time only
            apart = dates.groupBy(_ID).agg(F.count("*").alias("dates")).filter("dates > 1").select(_ID)
            copies = held.join(apart, _ID, "left_semi")
            write_batch(moved_rows(copies, dates), _moved_path(lake), batch_id, DATE)
            windows = held.select(_ID, start).join(batch.select(_ID), _ID, "left_semi").select("window_start")
            touched = store_at(windows.distinct(), f"{lake}/_touched")
            moved = read_batches(spark, _moved_path(lake), _rows_schema(schema))
            log = on_dates(log.unionByName(moved), covered(touched, width, log_unit)).drop(BATCH, DATE)
        else:
            log = near(log, batch, horizon, width, log_unit).drop(BATCH, DATE)
            same_id = log.select(_ID, "transaction_time").join(batch.select(_ID), _ID, "left_semi")
            touched = store_at(same_id.select(start).distinct(), f"{lake}/_touched")

        placed = log.select("*", start)
        ids = placed.join(touched, "window_start", "left_semi").select(_ID).distinct()
        current = dedup_latest(placed.join(ids, _ID, "left_semi"), _ID, _ORDER)
        # batches come one after another and take turns in one folder
        current = store_at(current.join(touched, "window_start", "left_semi"), f"{lake}/_windows")
        # two KPIs sum up the totals per product, two those per client
        totals = {
            by_product: store_at(period_totals(kpi, current, width), f"{lake}/_totals_{int(by_product)}")
            for by_product, kpi in ((True, "kpi_top_products"), (False, "kpi_customer_segments"))
        }
        results = {
            kpi: write_batch(
                windowed_kpi(kpi, current, dimension, width, limit, totals=totals[kpi in BY_PRODUCT]),
                _kpi_path(lake, kpi),
                batch_id,
            )
            for kpi, dimension in dimensions.items()
        }
        # only now do readers look for this batch's rows of these windows
        write_batch(touched, _touched_path(lake), batch_id)
        if jdbc is not None:
            changed = current.drop("window_start").join(batch.select(_ID), _ID, "left_semi")
            replace_rows(storable(changed, "transactions"), "transactions", [_ID], jdbc)
            for kpi, result in results.items():
                replace_rows(storable(result, kpi), kpi, ["window_start"], jdbc, touched)

    writer = transactions.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def _date(time: str, unit: str) -> Column:
    """The first date of the unit that a time is in."""
    return F.date_trunc(unit, time).cast("date")


def dates_of(spark: SparkSession, lake: str, batch: DataFrame, batch_id: int, every: int) -> DataFrame:
    """``id`` and date of all rows so far with an id of the batch, by the index."""
    return read_buckets(spark, _dates_path(lake), _DATES, batch.select(_ID), _ID, batch_id, every)


def moved_rows(copies: DataFrame, dates: DataFrame) -> DataFrame:
    """Of ids with rows on several dates, the latest row under each date but its own.

    ``copies`` are rows with their date, the latest one of each id among them.
    """
    latest = dedup_latest(copies, _ID, _ORDER)
    others = dates.select(F.col(_ID).alias("of"), F.col(DATE).alias("under"))
    return (
        latest.join(others, (F.col(_ID) == F.col("of")) & (F.col(DATE) != F.col("under")))
        .withColumn(DATE, F.col("under"))
        .drop("of", "under")
    )


def on_dates(log: DataFrame, dates: DataFrame) -> DataFrame:
    """The log's rows on some dates. The driver sees the dates, so that others are not even listed."""
    found = [r[0] for r in dates.select(DATE).distinct().collect()]
    return log.filter(F.col(DATE).isin(found))


def covered(touched: DataFrame, width: str, unit: str = "day") -> DataFrame:
    """The dates that rows of the windows are on, a day more on both sides for other time zones."""
    start, one = F.col("window_start"), F.expr("interval '1 day'")
    days = F.sequence(F.to_date(start - one), F.to_date(start + F.expr(f"interval '{width}'") + one))
    return touched.select(F.explode(days).alias("day")).select(_date("day", unit).alias(DATE)).distinct()


def near(log: DataFrame, batch: DataFrame, horizon: str, width: str, unit: str = "day") -> DataFrame:
    """The dates of the log that copies of the batch's rows and their windows can be on.

    Windows that a copy up to one horizon away lies in are touched and needed as a whole;
    rows that compete with those in them lie up to one horizon further. The driver sees the
    dates, so that others are not even listed.
    """
    day, reach = F.col("day").cast("timestamp"), F.expr(f"2 * interval '{horizon}' + interval '{width}'")
    one = F.expr("interval '1 day'")
    dates = (
        # a day more on both sides: the other end of the date, and other time zones
        batch.select(F.to_date("transaction_time").alias("day"))
        .distinct()
        .select(F.explode(F.sequence(F.to_date(day - reach - one), F.to_date(day + reach + one))).alias("day"))
        .select(_date("day", unit).alias("day"))
        .distinct()
        .collect()
    )
    return log.filter(F.col(DATE).isin([r.day for r in dates]))


def _merge(
    spark: SparkSession,
    lake: str,
    schema: T.StructType,
    merge: tuple[int, int, int],
    every: int,
    indexed: bool,
) -> None:
    """Merge finished batches of all logs.

    An id's latest row is all that later batches need, a window's last KPI rows all that
    readers do. KPI rows come before the windows that name their batch, as in a batch.
    """
    rows, touched = _rows_path(lake), _touched_path(lake)
    arrived = parts_of(spark, rows, _rows_schema(schema), merge).drop(BATCH)
    write_merged(dedup_latest(arrived, _ID, _ORDER), rows, merge, DATE)
    logs = [rows, *(_kpi_path(lake, kpi) for kpi in KPI_NAMES), touched]
    if indexed:
        # under each date the latest of an id's moved rows
        moved = parts_of(spark, _moved_path(lake), _rows_schema(schema), merge).drop(BATCH)
        write_merged(dedup_latest(moved, [_ID, DATE], _ORDER), _moved_path(lake), merge, DATE)
        dates = parts_of(spark, _dates_path(lake), _DATES, merge).drop(BATCH).distinct()
        write_merged(bucketed(dates, _ID, merge[0] + 1, every), _dates_path(lake), merge, BUCKET)
        logs += [_moved_path(lake), _dates_path(lake)]
    windows = parts_of(spark, touched, _TOUCHED, merge)
    for kpi in KPI_NAMES:
        parts = parts_of(spark, _kpi_path(lake, kpi), kpi_schema(kpi), merge)
        write_merged(_of_last(parts, windows), _kpi_path(lake, kpi), merge)
    write_merged(windows.select("window_start").distinct(), touched, merge)
    for path in logs:
        drop_merged(spark, path, merge, every)


def _of_last(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """A KPI's rows, for each window those of the last batch that touched it."""
    last = touched.groupBy("window_start").agg(F.max(BATCH).alias(BATCH))
    return rows.join(last, ["window_start", BATCH], "left_semi").drop(BATCH).distinct()


def current_transactions(spark: SparkSession, lake: str, schema: T.StructType) -> DataFrame:
    """The clean transactions of all batches so far, one row per id."""
    rows = read_batches(spark, _rows_path(lake), _rows_schema(schema)).drop(BATCH, DATE)
    return dedup_latest(rows, _ID, _ORDER)


def current_kpi(spark: SparkSession, lake: str, kpi: str) -> DataFrame:
    """A KPI table as of the last batch."""
    rows = read_batches(spark, _kpi_path(lake, kpi), kpi_schema(kpi))
    return _of_last(rows, read_batches(spark, _touched_path(lake), _TOUCHED))
