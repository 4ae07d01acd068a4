"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform_to_target
from ..operators.kpis import ORPHAN_LABEL
from ..schemas import TARGETS
from ..settings import JdbcTarget


def write_jdbc(df: DataFrame, table: str, target: JdbcTarget, mode: str = "append") -> None:
    """Append to a table, or with ``mode="overwrite"`` empty and refill it.

    Refilling truncates, so the table keeps its definition, keys and indexes. Each
    task inserts in one transaction over its own connection.
    """
    writer = (
        df.write.mode(mode)
        .option("batchsize", str(target.batch_rows))
        .option("numPartitions", str(target.connections))
    )
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.jdbc(
        target.url,
        table,
        properties={
            "user": target.user,
            "password": target.password,
            "driver": target.driver,
            # lets the server cast strings to its column types
            "stringtype": "unspecified",
        },
    )


def execute(spark: SparkSession, target: JdbcTarget, statements: Sequence[str]) -> None:
    """Run statements in the database, all in one transaction, from the driver."""
    jvm = spark._jvm
    login = jvm.java.util.Properties()
    login.setProperty("user", target.user)
    login.setProperty("password", target.password)
    # drivers given to the session are known to the thread's loader only
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    connection = loader.loadClass(target.driver).newInstance().connect(target.url, login)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().execute(statement)
        connection.commit()
    finally:
        connection.close()


def replace_rows(
    df: DataFrame, table: str, keys: Sequence[str], target: JdbcTarget, stale: DataFrame | None = None
) -> None:
    """Put rows in place of the table's rows with the same ``keys``, in one transaction.

    Tasks fill a staging table; the database moves it over. ``stale`` has the keys whose
    rows go, for keys that have no new row; without it those of ``df``.
    """
    stage = f"{table}_stage"
    write_jdbc(df, stage, target, "overwrite")
    gone = stage
    if stale is not None:
        gone = f"{table}_stale"
        write_jdbc(stale.select(*keys).distinct(), gone, target, "overwrite")
    same = " AND ".join(f"{gone}.{k} = {table}.{k}" for k in keys)
    names = ", ".join(df.columns)
    execute(
        df.sparkSession,
        target,
        [
            f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {gone} WHERE {same})",
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}",
        ],
    )


def storable(df: DataFrame, table: str) -> DataFrame:
    """What the database gets: its types, and a label where a KPI's group is null.

    Values out of a type's range fail the write here, before the database sees them.
    An attribute that has the label as a real value needs ``orphans="label"`` when
    the KPI is computed, which merges the two groups.
    """
    if table.startswith("kpi_"):
        names = [c for c in (*TARGETS[table].key, "product_name") if c in df.columns]
        texts = [c for c in names if not c.startswith("window_") and c != "product_id"]
        df = df.withColumns({c: F.coalesce(c, F.lit(ORPHAN_LABEL)) for c in texts})
    return conform_to_target(df, table, strict=True)
