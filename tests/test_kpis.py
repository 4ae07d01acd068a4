import math
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallywell.operators import (
    compute_all,
    customer_segments,
    kpi_row_counts,
    revenue_by_category,
    revenue_by_country,
    top_products,
    windowed_kpi,
)
from tallywell.plans import store_clean
from tallywell.schemas import KPI_NAMES, TOPICS

from .conftest import plan

AT = "2024-06-01T12:00:00Z"
TXN = (
    "transaction_id string, client_id string, product_id string, quantity int, "
    "total_amount double, transaction_time string"
)


@pytest.fixture(scope="module")
def data():
    """Half the rows belong to one product and one client; some keys are orphans."""
    rng = random.Random(11)
    txn = []
    for i in range(600):
        client = "C0" if i % 2 else f"C{rng.randrange(25)}"
        product = "P0" if i % 2 else f"P{rng.randrange(40)}"
        day = 1 + rng.randrange(4)
        txn.append((f"T{i}", client, product, 1 + rng.randrange(3),
                    rng.randrange(1, 10**6) / 100, f"2024-01-0{day} 0{rng.randrange(10)}:00:00"))
    products = [(f"P{i}", f"name {i}", None if i == 3 else f"cat {i % 3}") for i in range(30)]
    clients = [(f"C{i}", f"country {i % 4}", f"segment {i % 2}") for i in range(20)]
    return txn, clients, products


@pytest.fixture(scope="module")
def frames(spark, data):
    txn, clients, products = data
    return (
        spark.createDataFrame(txn, TXN)
        .withColumn("transaction_time", F.col("transaction_time").cast("timestamp"))
        .repartition(5),
        spark.createDataFrame(clients, "client_id string, country string, segment string"),
        spark.createDataFrame(products, "product_id string, name string, category string"),
    )


def cents(x):
    return Decimal(repr(x)) * 100


def half_up(x):
    return float(x.quantize(Decimal("0.01"), ROUND_HALF_UP))


def brute(txn, dimension, key, column, days=False):
    """Plain loops over joined rows: totals per attribute, and per day if asked for."""
    lookup = {row[0]: row[column] for row in dimension}
    groups = defaultdict(lambda: [Decimal(0), 0, set()])
    for row in txn:
        group = lookup.get(row[key])
        entry = groups[(row[5][:10], group) if days else group]
        entry[0] += cents(row[4])
        entry[1] += 1
        entry[2].add(row[key])
    return {
        g: (float(total / 100), n, len(keys), half_up(total / 100 / n))
        for g, (total, n, keys) in groups.items()
    }


def test_category(frames, data):
    got = revenue_by_category(frames[0], frames[2], AT).collect()
    want = brute(data[0], data[2], 2, 2)
    assert {r.category: (r.total_revenue, r.order_count, r.avg_order_value) for r in got} == {
        g: (t, n, mean) for g, (t, n, _, mean) in want.items()
    }
    assert None in want


def test_country_and_segments(frames, data):
    got = revenue_by_country(frames[0], frames[1], AT).collect()
    want = brute(data[0], data[1], 1, 1)
    assert {r.country: (r.total_revenue, r.order_count, r.unique_clients) for r in got} == {
        g: (t, n, u) for g, (t, n, u, _) in want.items()
    }
    got = customer_segments(frames[0], frames[1], AT).collect()
    want = brute(data[0], data[1], 1, 2)
    assert {
        r.segment: (r.total_revenue, r.order_count, r.unique_clients, r.avg_spend) for r in got
    } == want


def brute_top(txn, products, limit):
    names = {p[0]: p[1] for p in products}
    units, total = defaultdict(int), defaultdict(Decimal)
    for row in txn:
        units[row[2]] += row[3]
        total[row[2]] += cents(row[4])
    order = sorted(units, key=lambda p: (-units[p], p))[:limit]
    return [(p, names.get(p), units[p], float(total[p] / 100)) for p in order]


@pytest.mark.parametrize("limit", [1, 7, 20, 1000])
def test_top_products(frames, data, limit):
    got = top_products(frames[0], frames[2], limit, AT).collect()
    assert [(r.product_id, r.product_name, r.units_sold, r.total_revenue) for r in got] == brute_top(
        data[0], data[2], limit
    )


def test_orphans(frames, data):
    txn, _, products = frames
    kept = revenue_by_category(txn, products, AT)
    labelled = revenue_by_category(txn, products, AT, orphans="label")
    dropped = revenue_by_category(txn, products, AT, orphans="drop")
    assert {r.category for r in kept.collect()} == {None, "cat 0", "cat 1", "cat 2"}
    # a product without a category is known all the same, and its revenue stays under null
    matched = txn.join(products, "product_id").groupBy("category").agg(F.sum("total_amount").alias("total"))
    want = {r.category: r.total for r in matched.collect()}
    assert None in want
    assert {r.category: r.total_revenue for r in dropped.collect()} == pytest.approx(want, nan_ok=True)
    found = {r.category: r.total_revenue for r in labelled.collect()}
    assert found.pop("Unknown") > 0 and found == pytest.approx(want, nan_ok=True)
    with pytest.raises(ValueError):
        revenue_by_category(txn, products, AT, orphans="hide")
    known = {p[0] for p in data[2]}
    top = top_products(txn, products, 35, AT, orphans="drop").collect()
    assert [r.product_id for r in top] == [
        p for p, *_ in brute_top([t for t in data[0] if t[2] in known], data[2], 35)
    ]
    top = top_products(txn, products, 40, AT, orphans="label").collect()
    assert "Unknown" in {r.product_name for r in top}


def test_revenue_adds_up_to_the_transactions(frames):
    txn, clients, products = frames
    total = txn.agg(F.sum(F.col("total_amount").cast("decimal(18,2)"))).first()[0]
    kpis = compute_all(txn, clients, products, AT)
    for name in KPI_NAMES:
        if name != "kpi_top_products":
            rows = kpis[name].collect()
            assert sum(cents(r.total_revenue) for r in rows) == total * 100


def test_one_run_time_for_all(frames):
    kpis = compute_all(*frames)
    stamps = {tuple(r) for k in kpis.values() for r in k.select("window_start", "window_end").collect()}
    again = {tuple(r) for k in kpis.values() for r in k.select("window_start", "window_end").collect()}
    assert len(stamps) == 1
    assert stamps == again


def test_shared_totals_change_nothing(frames, tmp_path):
    alone, shared = compute_all(*frames, AT), compute_all(*frames, AT, share=str(tmp_path))
    for name in KPI_NAMES:
        assert sorted(alone[name].collect(), key=str) == sorted(shared[name].collect(), key=str)
    counts = {r.kpi: r.row_count for r in kpi_row_counts(alone).collect()}
    assert counts == {n: alone[n].count() for n in KPI_NAMES}


def test_bucketed_tables_are_joined_without_a_shuffle(spark, frames, tmp_path):
    stored = store_clean(dict(zip(TOPICS, frames)), str(tmp_path), buckets=6, counts=(counts := {}))
    assert counts == {t: df.count() for t, df in zip(TOPICS, frames)}
    assert 1 < len(list((tmp_path / "clients").glob("*.parquet"))) <= 6
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = compute_all(*(stored[t] for t in TOPICS), "2024-05-05", orphans="drop", share=f"{tmp_path}/totals", buckets=6)
        for name, df in got.items():
            above, below = plan(df).split("SortMergeJoin", 1)
            assert "Exchange" not in below and "Bucketed: true" in below, name
        want = compute_all(*frames, "2024-05-05", orphans="drop")
        assert {n: sorted(df.collect(), key=str) for n, df in got.items()} == {n: sorted(df.collect(), key=str) for n, df in want.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # written again, in place of what was there
    again = store_clean({"clients": frames[1].limit(2)}, str(tmp_path), buckets=6)
    assert again["clients"].count() == spark.read.parquet(str(tmp_path / "clients")).count() == 2
    with pytest.raises(ValueError):
        compute_all(*frames, buckets=6)


def test_amounts_no_decimal_holds(spark, frames):
    rows = [("a", "C0", "P0", 1, float("nan")), ("b", "C1", "P1", 1, 1e20), ("c", "C1", "P1", 1, 0.5)]
    txn = spark.createDataFrame([(*r, "2024-01-01") for r in rows], TXN)
    got = {r.category: r for r in revenue_by_category(txn, frames[2], AT).collect()}
    assert math.isnan(got["cat 0"].total_revenue)
    assert math.isnan(got["cat 0"].avg_order_value)
    assert got["cat 1"].total_revenue == 1e20
    assert got["cat 1"].order_count == 2


def test_means_are_rounded_half_up_exactly(spark, frames):
    # 241968.21 / 6 = 40328.035, which no double holds
    amounts = [40328.03] * 5 + [40328.06]
    txn = spark.createDataFrame(
        [(f"T{i}", "C0", "P0", 1, a, "2024-01-01") for i, a in enumerate(amounts)], TXN
    )
    (row,) = revenue_by_category(txn, frames[2], AT).collect()
    assert (row.total_revenue, row.avg_order_value) == (241968.21, 40328.04)


def test_transactions_are_summed_before_they_are_joined(frames):
    text = plan(revenue_by_country(frames[0], frames[1], AT))
    join = text.index("Join")
    assert "partial_sum" in text[join:] and "partial_sum" in text[:join]
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(
    ("kpi", "dimension", "key", "column"),
    [
        ("kpi_revenue_by_category", 2, 2, 2),
        ("kpi_revenue_by_country", 1, 1, 1),
        ("kpi_customer_segments", 1, 1, 2),
    ],
)
def test_windows(frames, data, kpi, dimension, key, column):
    got = windowed_kpi(kpi, frames[0], frames[dimension], "1 day")
    attribute = {2: "category"}.get(dimension, {1: "country", 2: "segment"}[column])
    want = brute(data[0], data[dimension], key, column, days=True)
    assert {
        (str(r.day), r[attribute]): (r.total_revenue, r.order_count)
        for r in got.withColumn("day", F.to_date("window_start")).collect()
    } == {g: (t, n) for g, (t, n, _, _) in want.items()}
    spans = got.select(F.col("window_end") - F.col("window_start")).distinct().collect()
    assert [s[0].days for s in spans] == [1]


@pytest.mark.parametrize("orphans", ["keep", "drop"])
def test_window_top(frames, data, orphans):
    known = {p[0] for p in data[2]}
    got = windowed_kpi("kpi_top_products", frames[0], frames[2], "1 day", 5, orphans)
    rows = defaultdict(list)
    for r in got.withColumn("day", F.to_date("window_start").cast("string")).collect():
        rows[r.day].append((r.product_id, r.product_name, r.units_sold, r.total_revenue))
    for day in {t[5][:10] for t in data[0]}:
        txn = [t for t in data[0] if t[5].startswith(day) and (orphans == "keep" or t[2] in known)]
        assert sorted(rows[day]) == sorted(brute_top(txn, data[2], 5))


def test_window_ranking_is_cut_before_the_shuffle(frames):
    text = plan(windowed_kpi("kpi_top_products", frames[0], frames[2], "1 day", 5))
    assert text.count("WindowGroupLimit") == 4
    # beyond what Spark cuts by itself, shares of a window are ranked and cut first
    text = plan(windowed_kpi("kpi_top_products", frames[0], frames[2], "1 day", 2000))
    ranked = [x for x in text.splitlines() if "Window [row_number" in x]
    assert len(ranked) == 2 and "share" in ranked[1]


def test_unknown_kpi(frames):
    with pytest.raises(ValueError):
        windowed_kpi("kpi_weather", frames[0], frames[1])


@pytest.mark.parametrize("orphans, want", [("keep", {None: 12.0}), ("drop", {None: 5.0}), ("label", {None: 5.0, "Unknown": 7.0})])
def test_a_null_attribute_is_no_orphan(spark, orphans, want):
    txn = spark.createDataFrame(
        [("a", "P", "C", 1, 5.0), ("b", "X", "Y", 1, 7.0)],
        "transaction_id string, product_id string, client_id string, quantity int, total_amount double",
    )
    products = spark.createDataFrame([("P", None, None)], "product_id string, name string, category string")
    clients = spark.createDataFrame([("C", None, None)], "client_id string, country string, segment string")
    for kpi, dimension in ((revenue_by_category, products), (revenue_by_country, clients), (customer_segments, clients)):
        got = kpi(txn, dimension, AT, orphans=orphans)
        assert {r[2]: r.total_revenue for r in got.collect()} == want
    top = {r.product_id: r.product_name for r in top_products(txn, products, 5, AT, orphans).collect()}
    assert top == {"keep": {"P": None, "X": None}, "drop": {"P": None}, "label": {"P": None, "X": "Unknown"}}[orphans]


def test_window_top_beyond_any_limit_of_the_optimizer(spark):
    n = 3000
    txn = spark.range(n).selectExpr(
        "concat('t', id) AS transaction_id", "concat('p', id) AS product_id", "int(id + 1) AS quantity",
        "1.0D AS total_amount", "timestamp'2024-01-01 00:00:00' AS transaction_time",
    )
    products = spark.createDataFrame([], "product_id string, name string")
    got = windowed_kpi("kpi_top_products", txn, products, "1 day", 2000).collect()
    assert sorted(r.units_sold for r in got) == list(range(n - 2000 + 1, n + 1))


def test_windowed_kpis_share_totals(frames):
    from tallywell.operators.windows import period_totals

    for kpi, dimension in (("kpi_top_products", frames[2]), ("kpi_customer_segments", frames[1])):
        want = windowed_kpi(kpi, frames[0], dimension)
        got = windowed_kpi(kpi, frames[0].limit(0), dimension, totals=period_totals(kpi, frames[0], "1 day"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
