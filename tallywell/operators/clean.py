"""Validation and normalization of the three entities.

Each entity is a set of tests on the decoded message and a set of replaced columns.
The tests see the values as they came; only then are they normalized. That part is
stateless and the same for batch and stream (:func:`valid_rows`); the batch cleaners
go on to keep one row per id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import has_text, lower_text, title_text, upper_text
from ..schemas import CLIENT, PRODUCT, TRANSACTION
from ..sources.codec import decode_messages
from .dedup import dedup_latest

# --- fixed values: accepted and clamped ranges --------------------------------

AGE_MIN, AGE_MAX = 13, 120
RATING_MIN, RATING_MAX = 1.0, 5.0


@dataclass(frozen=True)
class Entity:
    """How to clean one topic.

    ``time`` names the text column parsed to a timestamp (a row whose text is no
    timestamp is invalid); ``order_by`` ranks the copies of one id, best last.
    """

    schema: T.StructType
    key: str
    time: str | None
    order_by: tuple[str, ...]
    tests: Callable[[], list[Column]]
    columns: Callable[[], dict[str, Column]]


def _rating() -> Column:
    rating = F.col("rating")
    # NaN orders above every number, so it is clamped down; null stays null
    return (
        F.when(rating < RATING_MIN, F.lit(RATING_MIN))
        .when(rating > RATING_MAX, F.lit(RATING_MAX))
        .otherwise(F.round(rating, 2))
    )


ENTITIES = {
    "transactions": Entity(
        schema=TRANSACTION,
        key="transaction_id",
        time="transaction_time",
        order_by=("transaction_time", "product_id", "client_id", "quantity", "unit_price"),
        tests=lambda: [
            *(has_text(c) for c in ("transaction_id", "client_id", "product_id")),
            *(F.col(c) > 0 for c in ("quantity", "unit_price", "total_amount")),
        ],
        columns=lambda: {
            # the total as sent is tested, then replaced by what it should be
            "total_amount": F.round(F.col("quantity") * F.col("unit_price"), 2),
            "currency": upper_text("currency"),
            "payment_method": lower_text("payment_method"),
            "status": lower_text("status"),
        },
    ),
    "clients": Entity(
        schema=CLIENT,
        key="client_id",
        time="registered_at",
        order_by=("registered_at",),
        tests=lambda: [
            has_text("client_id"),
            F.col("email").contains("@"),
            F.col("age").between(AGE_MIN, AGE_MAX),
        ],
        columns=lambda: {
            **{c: title_text(c) for c in ("first_name", "last_name", "segment")},
            **{c: F.trim(c) for c in ("country", "city")},
            "email": lower_text("email"),
        },
    ),
    "products": Entity(
        schema=PRODUCT,
        key="product_id",
        time=None,
        order_by=("name",),
        tests=lambda: [has_text("product_id"), F.col("price") > 0, F.col("stock") >= 0],
        columns=lambda: {
            **{c: F.trim(c) for c in ("name", "brand")},
            **{c: title_text(c) for c in ("category", "sub_category")},
            "price": F.round("price", 2),
            "weight_kg": F.round("weight_kg", 3),
            "rating": _rating(),
        },
    ),
}


def _time(entity: Entity) -> Column:
    # try_: an unreadable time is null here, not an error
    return F.try_to_timestamp(entity.time)


def is_valid(topic: str) -> Column:
    """The test a decoded message must pass; null counts as failed."""
    entity = ENTITIES[topic]
    tests = entity.tests()
    if entity.time:
        tests.append(_time(entity).isNotNull())
    return reduce(and_, tests)


def valid_rows(raw: DataFrame, topic: str) -> DataFrame:
    """Decoded, tested and normalized rows of a topic, copies of an id included."""
    entity = ENTITIES[topic]
    columns = entity.columns()
    if entity.time:
        columns[entity.time] = _time(entity)
    return decode_messages(raw, entity.schema).filter(is_valid(topic)).withColumns(columns)


def _clean(raw: DataFrame, topic: str) -> DataFrame:
    entity = ENTITIES[topic]
    return dedup_latest(valid_rows(raw, topic), entity.key, entity.order_by)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Valid transactions, the latest copy of each."""
    return _clean(raw, "transactions")


def clean_clients(raw: DataFrame) -> DataFrame:
    """Valid clients, the latest registration of each."""
    return _clean(raw, "clients")


def clean_products(raw: DataFrame) -> DataFrame:
    """Valid products, one per id; having no time, the greatest name wins."""
    return _clean(raw, "products")
