"""Distinct clients as sketches that are kept per period and merged, without a second look at the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: binary logarithm of a sketch's registers: 4,096 registers, 2 to 4 KB a sketch
LG_K = 12


def client_sketches(transactions: DataFrame, unit: str = "day", lg_k: int = LG_K) -> DataFrame:
    """``period`` (its start), ``clients`` (a sketch) and ``orders`` per ``unit`` of transaction time.

    Sketches are of one bounded size, made where rows are read and merged after that, so a
    period of any size is no heavier than another. Rows without a client count as orders only.
    """
    return transactions.groupBy(F.date_trunc(unit, "transaction_time").alias("period")).agg(
        F.hll_sketch_agg("client_id", F.lit(lg_k)).alias("clients"), F.count("*").alias("orders")
    )


def merged_sketches(sketches: DataFrame, unit: str) -> DataFrame:
    """The sketches of wider periods, and of periods that came in several parts."""
    return sketches.groupBy(F.date_trunc(unit, "period").alias("period")).agg(
        F.hll_union_agg("clients").alias("clients"), F.sum("orders").alias("orders")
    )


def distinct_clients(sketches: DataFrame) -> DataFrame:
    """``period``, ``unique_clients`` as estimated, and ``orders``."""
    return sketches.select("period", F.hll_sketch_estimate("clients").alias("unique_clients"), "orders")


def relative_error(lg_k: int = LG_K, deviations: float = 4) -> float:
    """How far an estimate of merged sketches is off, as a share of the number; beyond four standard
    deviations once in 16,000 estimates."""
    return deviations * 1.04 / math.sqrt(2**lg_k)
