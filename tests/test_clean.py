from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallywell.operators import clean_clients, clean_products, clean_transactions, valid_rows
from tallywell.sources import encode_messages

from .conftest import message, optimized, raw

CLEANERS = {
    "transactions": clean_transactions,
    "clients": clean_clients,
    "products": clean_products,
}


def cleaned(spark, topic, *values):
    df = CLEANERS[topic](raw(spark, *values))
    times = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}).collect()


def one(spark, topic, **changes):
    rows = cleaned(spark, topic, message(topic, **changes))
    return rows[0] if rows else None


def test_good_transaction(spark):
    row = one(spark, "transactions")
    assert row.total_amount == 4.5
    assert (row.currency, row.payment_method, row.status) == ("USD", "paypal", "completed")
    assert row.transaction_time == datetime(2024, 1, 1)


@pytest.mark.parametrize(
    "value", [None, "not json", "", "[]", '{"transaction_id":"T","client_id', "7", "null"]
)
def test_what_is_no_object_is_dropped(spark, value):
    assert cleaned(spark, "transactions", value) == []


@pytest.mark.parametrize(
    "changes",
    [
        {"transaction_id": None}, {"transaction_id": ""}, {"client_id": None},
        {"client_id": ""}, {"product_id": None}, {"product_id": ""},
        {"quantity": 0}, {"quantity": -1}, {"quantity": 2.0}, {"quantity": "3"},
        {"quantity": 99999999999}, {"quantity": None},
        {"unit_price": 0}, {"unit_price": "1.5"}, {"unit_price": None},
        {"total_amount": 0}, {"total_amount": -1.0}, {"total_amount": None},
        {"transaction_time": ""}, {"transaction_time": None},
        {"transaction_time": "garbage"}, {"transaction_time": "2024-02-30"},
        {"transaction_time": 1700000000},
    ],
    ids=str,
)
def test_dropped_transactions(spark, changes):
    assert one(spark, "transactions", **changes) is None


@pytest.mark.parametrize(
    ("changes", "column", "expected"),
    [
        ({"transaction_id": "  "}, "transaction_id", "  "),
        ({"transaction_id": 7}, "transaction_id", "7"),
        ({"total_amount": 123456.0}, "total_amount", 4.5),
        ({"currency": None}, "currency", None),
        ({"status": None}, "status", None),
        ({"currency": "\tusd "}, "currency", "\tUSD"),
        ({"transaction_time": "2024-01-01 10:00"}, "transaction_time", datetime(2024, 1, 1, 10)),
        ({"transaction_time": "2024"}, "transaction_time", datetime(2024, 1, 1)),
        (
            {"transaction_time": "2024-01-01T10:00:00.123456789+02:00"},
            "transaction_time",
            datetime(2024, 1, 1, 8, 0, 0, 123456),
        ),
        ({"unit_price": 1.005, "quantity": 3}, "total_amount", 3.01),
        ({"unit_price": 1.005, "quantity": 1}, "total_amount", 1.01),
        ({"unit_price": 0.001}, "total_amount", 0.0),
        ({"colour": "red"}, "total_amount", 4.5),
    ],
    ids=str,
)
def test_kept_transactions(spark, changes, column, expected):
    assert one(spark, "transactions", **changes)[column] == expected


def test_nan_price_passes(spark):
    assert str(one(spark, "transactions", unit_price="NaN").total_amount) == "nan"


def test_good_client(spark):
    row = one(spark, "clients")
    assert (row.first_name, row.last_name) == ("O'brien Mary-ann", "Smith")
    assert (row.email, row.country, row.city, row.segment) == ("a@b", "France", "Nice", "Vip")
    assert row.registered_at == datetime(2020, 2, 3, 4, 5, 6)


@pytest.mark.parametrize(
    "changes",
    [
        {"client_id": ""}, {"client_id": None}, {"email": "x"}, {"email": None},
        {"age": 12}, {"age": 121}, {"age": None}, {"registered_at": "soon"},
    ],
    ids=str,
)
def test_dropped_clients(spark, changes):
    assert one(spark, "clients", **changes) is None


def test_age_bounds_and_bare_at_sign(spark):
    assert one(spark, "clients", email="@", age=120).email == "@"


def test_good_product(spark):
    row = one(spark, "products")
    assert (row["name"], row.category, row.sub_category) == ("Brick", "Toys", "Lego")
    assert (row.brand, row.price, row.weight_kg) == ("FunFactory", 10.0, 1.235)


@pytest.mark.parametrize(
    ("rating", "expected"),
    [(None, None), (0.2, 1.0), (0.999, 1.0), (3.456, 3.46), (7, 5.0), ("NaN", 5.0), (5, 5.0)],
)
def test_rating_is_clamped(spark, rating, expected):
    assert one(spark, "products", rating=rating).rating == expected


@pytest.mark.parametrize("changes", [{"price": 0}, {"stock": -1}, {"stock": None}, {"product_id": ""}])
def test_dropped_products(spark, changes):
    assert one(spark, "products", **changes) is None


def test_price_is_tested_before_rounding(spark):
    assert one(spark, "products", price=0.001, sub_category="T-Shirts").price == 0.0


def test_optional_product_fields(spark):
    value = message("products", drop=("weight_kg", "rating", "sub_category"))
    (row,) = cleaned(spark, "products", value)
    assert (row.weight_kg, row.rating, row.sub_category) == (None, None, None)


@pytest.mark.parametrize("topic", list(CLEANERS))
def test_a_message_is_parsed_once(spark, topic):
    df = valid_rows(raw(spark, "x"), topic)
    assert optimized(df).count("from_json") == 1


def test_cleaning_cleaned_messages_changes_nothing(spark):
    values = [message("transactions", transaction_id=f"T{i}", quantity=i + 1) for i in range(9)]
    once = clean_transactions(raw(spark, *values))
    twice = clean_transactions(encode_messages(once, "transaction_id"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_input_order_does_not_matter(spark):
    values = [
        message("transactions", transaction_id=f"T{i % 5}", product_id=f"P{i % 3}", quantity=i + 1)
        for i in range(40)
    ]
    ahead = cleaned(spark, "transactions", *values)
    back = cleaned(spark, "transactions", *reversed(values))
    assert sorted(ahead) == sorted(back)
    assert len(ahead) == 5
