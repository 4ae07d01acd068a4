"""Both sinks at once: the lake, and the database if there is one.

A frame is evaluated once, by the write to the lake. Everything later, the database
included, works from the stored copy; nothing is cached, so a lost executor costs a
re-read and the two copies are the same. That write also counts the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, MutableMapping, Sequence

from pyspark.sql import DataFrame, Observation

from ..scratch import store_bucketed
from ..settings import JdbcTarget
from ..sinks.jdbc import storable, write_jdbc
from ..sinks.lake import PERIODS, by_date, rows_of, write_parquet

#: dimensions and the keys they have one row for
_DIMENSIONS = {"clients": "client_id", "products": "product_id"}


def _store(df, path, table, jdbc, counts, partition_by=None, cluster_by=(), buckets=None) -> DataFrame:
    counted = None if counts is None else Observation()
    if buckets is not None and table in _DIMENSIONS:
        stored = store_bucketed(df, path, _DIMENSIONS[table], buckets, counted)
    else:
        write_parquet(df, path, partition_by=partition_by, counted=counted, cluster_by=cluster_by)
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
    if counted is not None:
        counts[table] = rows_of(counted)
    if jdbc is not None:
        write_jdbc(storable(stored, table), table, jdbc, mode="overwrite")
    return stored


def store_clean(
    frames: Mapping[str, DataFrame],
    lake: str,
    jdbc: JdbcTarget | None = None,
    dated_lake: bool = False,
    counts: MutableMapping[str, int] | None = None,
    unit: str = "day",
    cluster_by: Sequence[str] = (),
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Store the clean tables under their topic names; returns the stored copies.

    ``dated_lake`` partitions the transactions by date, in folders of a ``unit``, and ``cluster_by`` sorts their files.
    ``buckets`` stores the dimensions in so many buckets by their keys. ``counts`` gets the number of rows of each table.
    """
    stored = {}
    for topic, df in frames.items():
        facts = topic == "transactions"
        dated = dated_lake and facts
        stored[topic] = _store(
            by_date(df, unit) if dated else df,
            f"{lake}/{topic}",
            topic,
            jdbc,
            counts,
            PERIODS[unit] if dated else None,
            cluster_by if facts else (),
            buckets,
        )
    return stored


def store_kpis(
    kpis: Mapping[str, DataFrame],
    lake: str,
    jdbc: JdbcTarget | None = None,
    counts: MutableMapping[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Store KPI tables under ``kpis/``; returns the stored copies. ``counts`` gets their numbers of rows."""
    return {name: _store(df, f"{lake}/kpis/{name}", name, jdbc, counts) for name, df in kpis.items()}
