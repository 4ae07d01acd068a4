import pytest
from pyspark.sql import functions as F

from tallywell.operators import clean_clients, clean_products, clean_transactions
from tallywell.sources import (
    encode_messages,
    synth,
    synth_clients,
    synth_products,
    synth_transactions,
)

BASE = "2024-06-01 12:00:00"
N = 4000


@pytest.fixture(scope="module")
def clients(spark):
    return synth_clients(spark, N, BASE).toPandas()


@pytest.fixture(scope="module")
def products(spark):
    return synth_products(spark, N).toPandas()


@pytest.fixture(scope="module")
def transactions(spark):
    return synth_transactions(spark, N, 300, 200, BASE).toPandas()


def test_clients(clients):
    assert clients.client_id.is_unique
    assert set(clients.first_name) == set(synth.FIRST_NAMES)
    assert set(clients.last_name) == set(synth.LAST_NAMES)
    assert set(clients.segment) == set(synth.SEGMENTS)
    assert set(zip(clients.country, clients.city)) == {
        (country, city) for country, cities in synth.CITIES.items() for city in cities
    }
    assert clients.age.between(18, 79).all() and clients.age.nunique() == 62
    assert clients.email.str.fullmatch(r"[a-z]+\.[a-z]+\d{1,3}@example\.com").all()
    assert clients.registered_at.max() <= "2024-06-01T12:00:00Z"
    assert clients.registered_at.min() >= "2019-06-04T12:00:00Z"


def test_products(products):
    assert products.product_id.is_unique
    assert set(zip(products.category, products.sub_category)) == {
        (c, s) for c, subs in synth.SUB_CATEGORIES.items() for s in subs
    }
    for category, rows in products.groupby("category"):
        low, high = synth.PRICES[category]
        assert rows.price.between(low, high).all()
        assert rows.price.max() - rows.price.min() > 0.9 * (high - low)
    assert products.rating.between(1, 5).all() and products.weight_kg.between(0.1, 30).all()
    assert products.stock.between(0, 4999).all()
    assert products.name.str.fullmatch(r".+ \d{4}").all()


def test_transactions(transactions):
    assert transactions.transaction_id.is_unique
    assert set(transactions.client_id) == {f"CLI-{i:08x}" for i in range(300)}
    assert set(transactions.product_id) == {f"PRD-{i:08x}" for i in range(200)}
    assert set(transactions.quantity) == set(range(1, 11))
    assert transactions.unit_price.between(5, 1000).all()
    total = (transactions.quantity * transactions.unit_price).round(2)
    assert (total - transactions.total_amount).abs().max() < 1e-9
    share = transactions.status.value_counts(normalize=True)
    assert abs(share["completed"] - 4 / 6) < 0.05
    assert abs((transactions.currency == "USD").mean() - 3 / 7) < 0.05
    assert transactions.transaction_time.min() > "2024-05-25T12:00:00Z"


def test_a_row_depends_on_its_number_and_the_seed_only(spark):
    few, many = synth_clients(spark, 10, BASE), synth_clients(spark, 1000, BASE).repartition(7)
    assert sorted(few.collect()) == sorted(many.collect())[:10]
    other = synth_clients(spark, 10, BASE, seed=1)
    assert other.exceptAll(few).count() == 10


def test_ids_stay_unique_beyond_eight_digits(spark):
    numbers = spark.range(0xFFFFFFFF, 0xFFFFFFFF + 3).select(F.col("id").alias("n"))
    ids = [r[0] for r in synth.product_rows(numbers).select("product_id").collect()]
    assert ids == ["PRD-ffffffff", "PRD-100000000", "PRD-100000001"]


def test_every_client_can_be_drawn_from_a_large_pool(spark):
    pool = 20_000_000_000
    drawn = synth_transactions(spark, 2000, pool, 5, BASE).select(
        F.conv(F.substring("client_id", 5, 20), 16, 10).cast("bigint").alias("n")
    )
    low, high = drawn.agg(F.min("n"), F.max("n")).first()
    assert low < pool * 0.01 and pool * 0.99 < high < pool


def test_all_rows_pass_the_cleaners(spark):
    rows = {
        "client_id": (synth_clients(spark, 500, BASE), clean_clients),
        "product_id": (synth_products(spark, 500), clean_products),
        "transaction_id": (synth_transactions(spark, 500, 9, 9, BASE), clean_transactions),
    }
    for key, (df, clean) in rows.items():
        assert clean(encode_messages(df, key)).count() == 500
