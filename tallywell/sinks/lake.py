"""Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

DATE = "transaction_date"
TIME = "transaction_time"
#: what the folders of a dated table may span, and the columns they are named by
PERIODS = {"day": DATE, "month": "transaction_month", "year": "transaction_year"}
#: bytes that a folder should have on average
FOLDER_BYTES = 64 * 1024 * 1024
#: days for which a table of so many bytes each goes by days without a look at them
SURE_DAYS = 3653


def by_date(transactions: DataFrame, unit: str = "day") -> DataFrame:
    """Transactions with the column the lake is partitioned by: the first date of a row's day, month or year."""
    return transactions.withColumn(PERIODS[unit], F.date_trunc(unit, TIME).cast("date"))


def date_unit(transactions: DataFrame, size: int, folder_bytes: int = FOLDER_BYTES) -> str:
    """The shortest unit whose folders get ``folder_bytes`` each, of ``size`` bytes in all; years if none does.

    Days that hold rows count, not the span, so one wrong date changes little. They are looked up in a pass over
    ``transactions`` of its own, which a large table is spared: ``folder_bytes`` for each day of ten years are days.
    """
    if size >= folder_bytes * SURE_DAYS:
        return "day"
    days = transactions.select(F.to_date(TIME).alias("day")).distinct()
    found = days.agg(F.count("*").alias("day"), F.count_distinct(F.trunc("day", "month")).alias("month")).first()
    return next((unit for unit in ("day", "month") if size >= folder_bytes * found[unit]), "year")


def between_dates(stored: DataFrame, first: str | date, last: str | date) -> DataFrame:
    """The rows of a dated table from one date to another, both included, whatever unit its folders have.

    Only folders of these dates are read; inside, the times are compared with the statistics of row groups.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    found = (F.col(TIME) >= low.cast("timestamp")) & (F.col(TIME) < F.date_add(high, 1).cast("timestamp"))
    for unit, column in PERIODS.items():
        if column in stored.columns:
            found &= F.col(column).between(F.date_trunc(unit, low).cast("date"), high)
    return stored.filter(found)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    touched_only: bool = False,
    counted: Observation | None = None,
    cluster_by: Sequence[str] = (),
    row_group: int | None = None,
) -> None:
    """Write a folder, replacing what it holds unless ``mode`` says otherwise.

    With ``partition_by`` rows are first brought together by partition value, so that
    a value gets few files; a value too large for one task is split over several.
    ``touched_only`` makes an overwrite replace only the partitions ``df`` has rows for.
    ``counted`` gets the number of ``rows`` as they are written, see :func:`rows_of`. It is taken by the tasks
    that write, of which each counts once, whether it is tried again or done twice.

    ``cluster_by`` sorts each file by these columns, so that readers who look for some of their values skip
    row groups, of ``row_group`` bytes, by their statistics. It takes a sort in each task and no shuffle.
    """
    if partition_by is None:
        if touched_only:
            raise ValueError("touched_only needs partition_by")
        rows = _counted(df, counted)
        _grouped(rows.sortWithinPartitions(*cluster_by) if cluster_by else rows, mode, row_group).parquet(path)
        return
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    rows = _counted(df.hint("rebalance", *columns), counted)
    if cluster_by:
        rows = rows.sortWithinPartitions(*columns, *cluster_by)
    (
        _grouped(rows, mode, row_group)
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
        .partitionBy(*columns)
        .parquet(path)
    )


def _grouped(rows: DataFrame, mode: str, row_group: int | None) -> DataFrameWriter:
    writer = rows.write.mode(mode)
    return writer if row_group is None else writer.option("parquet.block.size", row_group)


def _counted(df: DataFrame, counted: Observation | None) -> DataFrame:
    """With a count of its rows, after the last shuffle: what comes before one may be done again for lost executors."""
    return df if counted is None else df.observe(counted, F.count(F.lit(1)).alias("rows"))


def rows_of(counted: Observation) -> int:
    """How many rows were written; none are seen of a table that is known to be empty."""
    return int(counted.get.get("rows") or 0)
