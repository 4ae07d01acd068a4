"""The KPIs over tumbling windows of the transaction's own time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KPI_NAMES
from .kpis import (
    PERIOD,
    client_totals,
    group_totals,
    marked,
    product_totals,
    resolve_orphans,
    shape_category,
    shape_country,
    shape_segments,
    shape_top,
)

#: KPIs of products; the others are of clients
BY_PRODUCT = ("kpi_revenue_by_category", "kpi_top_products")
#: parts of a window's products that are ranked by themselves
_SHARES = 64


def windowed_kpi(
    kpi: str,
    transactions: DataFrame,
    dimension: DataFrame,
    width: str = "1 day",
    limit: int = 20,
    orphans: str = "keep",
    totals: DataFrame | None = None,
) -> DataFrame:
    """One KPI table with a row set per window of ``width``, aligned to the epoch.

    ``dimension`` is the products for ``kpi_revenue_by_category`` and
    ``kpi_top_products``, the clients for the other two. ``limit`` applies to the
    top products of each window. ``totals`` are those of the transactions per window and product or client
    (:func:`period_totals`), for callers of several KPIs.
    """
    totals = period_totals(kpi, transactions, width) if totals is None else totals
    start, end = F.col(PERIOD[0]), F.col(PERIOD[1])
    if kpi == "kpi_revenue_by_category":
        groups = group_totals(totals, dimension, "product_id", "category", orphans, PERIOD)
        return shape_category(groups, start, end)
    if kpi == "kpi_revenue_by_country":
        groups = group_totals(totals, dimension, "client_id", "country", orphans, PERIOD)
        return shape_country(groups, start, end)
    if kpi == "kpi_customer_segments":
        groups = group_totals(totals, dimension, "client_id", "segment", orphans, PERIOD)
        return shape_segments(groups, start, end)
    return shape_top(window_top(totals, dimension, limit, orphans), start, end)


def period_totals(kpi: str, transactions: DataFrame, width: str) -> DataFrame:
    """Totals per window and product or client, whichever the KPI sums up."""
    if kpi not in KPI_NAMES:
        raise ValueError(f"unknown KPI {kpi!r}, expected one of {', '.join(KPI_NAMES)}")
    return (product_totals if kpi in BY_PRODUCT else client_totals)(transactions, width)


def window_top(totals: DataFrame, products: DataFrame, limit: int, orphans: str = "keep") -> DataFrame:
    """Rank the products' totals within each window, then name the winners.

    Products of a window are ranked in shares first, and only the first ``limit`` of each
    share meet, so a window may hold any number of products whatever the limit.
    """
    names = marked(products, "product_id", F.col("name").alias("product_name"))
    if orphans == "drop":
        totals = resolve_orphans(totals.join(names, "product_id", "left"), "product_name", orphans)
    best = (F.desc("units"), F.asc("product_id"))
    totals = totals.withColumn("share", F.pmod(F.xxhash64("product_id"), F.lit(_SHARES)))
    for group in ([*PERIOD, "share"], PERIOD):
        order = Window.partitionBy(*group).orderBy(*best)
        totals = totals.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
    if orphans == "drop":
        return totals
    return resolve_orphans(totals.join(names, "product_id", "left"), "product_name", orphans)
