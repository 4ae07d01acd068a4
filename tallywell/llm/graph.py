"""Connected components of a graph that no one machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Reconnect each node's larger (or smaller) neighbours to the least node around it."""
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
    if not large:
        both = both.filter("b < a")
    least = both.groupBy(F.col("a").alias("of")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    around = both.join(least, F.col("a") == F.col("of"))
    if large:
        moved = around.filter("b > a").select(F.col("m").alias("a"), "b")
    else:
        moved = around.select(F.explode(F.array(F.struct(F.col("m").alias("a"), "b"), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
    return moved.filter("a < b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for all but the roots.

    ``edges`` has longs ``a`` and ``b``. Large and small stars take turns until nothing
    changes; each round is written, so a lost executor costs a round at most. Only
    counts and check sums reach the driver.
    """
    edges = materialize(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b"), label
    )
    mark = None
    while True:
        check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        now = edges.agg(F.count("*").alias("n"), check).first()
        if now == mark or not now.n:
            break
        mark = now
        edges = materialize(_star(materialize(_star(edges, large=True), label), large=False), label)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
