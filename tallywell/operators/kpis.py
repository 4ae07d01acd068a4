"""The four KPIs.

Each works in two steps. Transactions are first summed per product or per client,
map-side before the shuffle, so a hot product or client reaches the join as a
single row; then the dimension is joined, the unmatched kept, and the totals are
summed again per attribute. Sums, counts and their quotient come out the same as
over the joined transactions, and distinct clients turn into a plain count, because
the totals already have one row per client.

This relies on dimensions with one row per id, which the cleaners guarantee.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_timestamp, average, exact_amount, inexact_amount, revenue
from ..schemas import KPI_NAMES
from ..scratch import store_at, store_bucketed

ORPHAN_LABEL = "Unknown"
MATCHED = "matched"
PERIOD = ("window_start", "window_end")
#: what :func:`compute_all` reads of each table
KPI_COLUMNS = {
    "transactions": ("transaction_id", "client_id", "product_id", "quantity", "total_amount"),
    "clients": ("client_id", "country", "segment"),
    "products": ("product_id", "name", "category"),
}


# --- per-key totals -----------------------------------------------------------


def key_measures() -> list[Column]:
    """What is summed of transactions: units, orders and amounts."""
    amount = F.col("total_amount")
    return [
        F.sum("quantity").alias("units"),
        F.count("transaction_id").alias("orders"),
        F.sum(exact_amount(amount)).alias("exact"),
        F.sum(inexact_amount(amount)).alias("inexact"),
    ]


def key_totals(transactions: DataFrame, key: str, width: str | None = None) -> DataFrame:
    """Units, orders and amounts per ``key``, within each event-time window if any."""
    by = [F.col(key)]
    if width is not None:
        transactions = transactions.withColumn("period", F.window("transaction_time", width))
        by = [F.col("period.start").alias(PERIOD[0]), F.col("period.end").alias(PERIOD[1]), *by]
    return transactions.groupBy(*by).agg(*key_measures())


def product_totals(transactions: DataFrame, width: str | None = None) -> DataFrame:
    return key_totals(transactions, "product_id", width)


def client_totals(transactions: DataFrame, width: str | None = None) -> DataFrame:
    return key_totals(transactions, "client_id", width)


# --- from totals to KPIs ------------------------------------------------------


def marked(dimension: DataFrame, key: str, attribute: Column | str) -> DataFrame:
    """Key and attribute of a dimension, and a mark that tells a match from none.

    A null attribute does not: the cleaners keep rows that have one.
    """
    return dimension.select(key, attribute, F.lit(True).alias(MATCHED))


def resolve_orphans(rows: DataFrame, attribute: str, orphans: str) -> DataFrame:
    """What becomes of rows without a match: kept under null, labelled, or dropped."""
    if orphans == "keep":
        return rows
    if orphans == "label":
        named = F.when(F.col(MATCHED).isNull(), F.lit(ORPHAN_LABEL)).otherwise(F.col(attribute))
        return rows.withColumn(attribute, named)
    if orphans == "drop":
        return rows.filter(F.col(MATCHED).isNotNull())
    raise ValueError(f"orphans must be keep, label or drop, not {orphans!r}")


def group_totals(
    totals: DataFrame,
    dimension: DataFrame,
    key: str,
    attribute: str,
    orphans: str,
    periods: Sequence[str | Column] = (),
) -> DataFrame:
    """Totals per attribute of the dimension: revenue, orders and distinct keys."""
    joined = totals.join(marked(dimension, key, attribute), key, "left")
    return (
        resolve_orphans(joined, attribute, orphans)
        .groupBy(*periods, attribute)
        .agg(
            F.sum("exact").alias("exact"),
            F.sum("inexact").alias("inexact"),
            F.sum("orders").alias("order_count"),
            F.count(key).alias("unique_keys"),
        )
    )


def _total() -> Column:
    return revenue(F.col("exact"), F.col("inexact")).alias("total_revenue")


def _mean(name: str) -> Column:
    return average(F.col("exact"), F.col("inexact"), F.col("order_count")).alias(name)


def shape_category(groups: DataFrame, start: Column, end: Column) -> DataFrame:
    return groups.select(
        start.alias(PERIOD[0]), end.alias(PERIOD[1]), "category",
        _total(), "order_count", _mean("avg_order_value"),
    )


def shape_country(groups: DataFrame, start: Column, end: Column) -> DataFrame:
    return groups.select(
        start.alias(PERIOD[0]), end.alias(PERIOD[1]), "country",
        _total(), "order_count", F.col("unique_keys").alias("unique_clients"),
    )


def shape_segments(groups: DataFrame, start: Column, end: Column) -> DataFrame:
    return groups.select(
        start.alias(PERIOD[0]), end.alias(PERIOD[1]), "segment",
        _total(), "order_count", F.col("unique_keys").alias("unique_clients"), _mean("avg_spend"),
    )


def shape_top(named: DataFrame, start: Column, end: Column) -> DataFrame:
    return named.select(
        start.alias(PERIOD[0]), end.alias(PERIOD[1]), "product_id", "product_name",
        F.col("units").alias("units_sold"),
        _total(),
    )


def _category(totals, products, at, orphans):
    groups = group_totals(totals, products, "product_id", "category", orphans)
    return shape_category(groups, at, at)


def _country(totals, clients, at, orphans):
    return shape_country(group_totals(totals, clients, "client_id", "country", orphans), at, at)


def _segments(totals, clients, at, orphans):
    return shape_segments(group_totals(totals, clients, "client_id", "segment", orphans), at, at)


def _top(totals, products, limit, at, orphans):
    """Rank first, then look up names for the few winners only.

    The limit gives the winners a size Spark knows when it plans, so it broadcasts
    them and scans the products without shuffling those. As it can broadcast no
    outer side, names are joined inner and the winners added once more without a
    name; both uses read the same exchange. Dropping orphans has to come before
    ranking and so joins first.
    """
    ranking = [F.desc("units"), F.asc("product_id")]
    names = marked(products, "product_id", F.col("name").alias("product_name"))
    if orphans == "drop":
        named = resolve_orphans(totals.join(names, "product_id", "left"), "product_name", orphans)
        return shape_top(named.orderBy(*ranking).limit(limit), at, at)
    top = totals.orderBy(*ranking).limit(limit)
    named = (
        names.join(top, "product_id")
        .unionByName(top, allowMissingColumns=True)
        .groupBy(*top.columns)
        .agg(F.max("product_name").alias("product_name"), F.max(MATCHED).alias(MATCHED))
    )
    return shape_top(resolve_orphans(named, "product_name", orphans).orderBy(*ranking), at, at)


# --- public operators ---------------------------------------------------------


def revenue_by_category(
    transactions: DataFrame,
    products: DataFrame,
    run_ts: datetime | str | None = None,
    orphans: str = "keep",
) -> DataFrame:
    """Revenue, orders and average order value per product category."""
    return _category(product_totals(transactions), products, as_timestamp(run_ts), orphans)


def revenue_by_country(
    transactions: DataFrame,
    clients: DataFrame,
    run_ts: datetime | str | None = None,
    orphans: str = "keep",
) -> DataFrame:
    """Revenue, orders and distinct clients per country."""
    return _country(client_totals(transactions), clients, as_timestamp(run_ts), orphans)


def top_products(
    transactions: DataFrame,
    products: DataFrame,
    limit: int = 20,
    run_ts: datetime | str | None = None,
    orphans: str = "keep",
) -> DataFrame:
    """The ``limit`` products with most units sold; equal units go by product id."""
    return _top(product_totals(transactions), products, limit, as_timestamp(run_ts), orphans)


def customer_segments(
    transactions: DataFrame,
    clients: DataFrame,
    run_ts: datetime | str | None = None,
    orphans: str = "keep",
) -> DataFrame:
    """Revenue, orders, distinct clients and average spend per client segment."""
    return _segments(client_totals(transactions), clients, as_timestamp(run_ts), orphans)


def compute_all(
    transactions: DataFrame,
    clients: DataFrame,
    products: DataFrame,
    run_ts: datetime | str | None = None,
    limit: int = 20,
    orphans: str = "keep",
    share: str | None = None,
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """All four KPIs by table name, with one and the same run time.

    Category and top products derive from one set of product totals, the other two
    from one set of client totals. ``share`` names a folder these totals are written to
    first, for callers that run the KPIs as separate jobs. With ``buckets`` they are written in so many buckets by
    their key, and joined without a shuffle to dimensions that are stored alike. Transactions are not: a
    hot product or client would be one task's, while its totals are one row.
    """
    at = as_timestamp(run_ts)
    by_product, by_client = product_totals(transactions), client_totals(transactions)
    if share is None and buckets is not None:
        raise ValueError("buckets need a folder to share")
    if buckets is not None:
        by_product = store_bucketed(by_product, f"{share}/products", "product_id", buckets)
        by_client = store_bucketed(by_client, f"{share}/clients", "client_id", buckets)
    elif share is not None:
        by_product = store_at(by_product, f"{share}/products")
        by_client = store_at(by_client, f"{share}/clients")
    return {
        "kpi_revenue_by_category": _category(by_product, products, at, orphans),
        "kpi_revenue_by_country": _country(by_client, clients, at, orphans),
        "kpi_top_products": _top(by_product, products, limit, at, orphans),
        "kpi_customer_segments": _segments(by_client, clients, at, orphans),
    }


def kpi_row_counts(kpis: dict[str, DataFrame]) -> DataFrame:
    """Rows per KPI table, in one job; equal exchanges below are computed once."""
    counts = [
        kpis[name].agg(F.count("*").alias("row_count")).select(F.lit(name).alias("kpi"), "row_count")
        for name in KPI_NAMES
    ]
    return reduce(DataFrame.unionByName, counts)
