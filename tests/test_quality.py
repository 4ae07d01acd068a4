from decimal import Decimal

import pytest

from tallywell.operators import conform_to_target, orphan_keys, stage_counts, target_violations
from tallywell.schemas import KPI_NAMES, TARGETS

from .conftest import message, raw


def test_targets():
    assert set(TARGETS) == {"transactions", "clients", "products", "pipeline_runs", *KPI_NAMES}
    txn = TARGETS["transactions"]
    assert [f.name for f in txn.fields][-1] == "ingested_at"
    assert "ingested_at" not in [f.name for f in txn.written]
    assert {f.name: f.max_chars for f in txn.fields}["currency"] == 3
    optional = {f.name for f in TARGETS["products"].fields if not f.required}
    assert optional == {"sub_category", "weight_kg", "rating"}


def product(spark, **changes):
    values = {"product_id": "'P'", "name": "'n'", "category": "'c'", "sub_category": "NULL",
              "brand": "'b'", "price": "1.005D", "weight_kg": "0.5D", "rating": "NULL",
              "stock": "1", **changes}
    return spark.range(1).selectExpr(*(f"{v} AS {k}" for k, v in values.items()))


def test_conform(spark):
    row = conform_to_target(product(spark), "products").first()
    assert row.price == Decimal("1.01")
    assert row.weight_kg == Decimal("0.500")
    assert row.asDict().keys() == {f.name for f in TARGETS["products"].written}


@pytest.mark.parametrize("value", ["1e11D", "double('Infinity')", "double('NaN')"])
def test_what_does_not_fit_becomes_null(spark, value):
    assert conform_to_target(product(spark, price=value), "products").first().price is None


def test_strict_conform_fails(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        conform_to_target(product(spark, price="1e11D"), "products", strict=True).collect()


def found(df, table):
    return {(r.column, r.rule): r.row_count for r in target_violations(df, table).collect()}


def test_violations(spark):
    df = product(spark)
    for changes in (
        {},
        {"product_id": "NULL"},
        {"product_id": "NULL"},
        {"product_id": "'Q'", "price": "double('NaN')"},
        {"product_id": "'R'", "name": "repeat('x', 257)", "rating": "12D"},
        {"product_id": "'S'", "name": "repeat('é', 256)", "stock": "NULL"},
    ):
        df = df.unionByName(product(spark, **changes))
    assert found(df, "products") == {
        ("product_id", "null"): 2,
        ("product_id", "duplicate_key"): 1,
        ("price", "type"): 1,
        ("name", "length"): 1,
        ("rating", "type"): 1,
        ("stock", "null"): 1,
    }
    assert found(product(spark), "products") == {}


def test_violations_of_a_composite_key(spark):
    df = spark.sql("""
        SELECT timestamp'2024-01-01' AS window_start, timestamp'2024-01-01' AS window_end,
          country, 1D AS total_revenue, count AS order_count, 1L AS unique_clients
        FROM VALUES ('A', 1L), ('A', 2L), ('A', 3L), (NULL, 3000000000L) AS t(country, count)""")
    assert found(df, "kpi_revenue_by_country") == {
        ("window_start,window_end,country", "duplicate_key"): 2,
        ("country", "null"): 1,
        ("order_count", "type"): 1,
    }


def test_orphans(spark):
    used = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "product_id string")
    known = spark.createDataFrame([("a", 1), ("d", 1)], "product_id string, x int")
    assert sorted(map(tuple, orphan_keys(used, known, "product_id").collect())) == [("b", 2), ("c", 1)]


def test_stage_counts(spark):
    counts = stage_counts(
        {
            "transactions": raw(spark, message("transactions"), message("transactions"), "bad",
                                message("transactions", quantity=0)),
            "clients": raw(spark, message("clients"), message("clients", client_id="D")),
            "products": raw(spark, "bad"),
        }
    )
    assert {tuple(r) for r in counts.collect()} == {
        ("transactions", 4, 1), ("clients", 2, 2), ("products", 1, 0),
    }
