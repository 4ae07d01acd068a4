from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from ..settings import Source
from ..sources.codec import encode_messages
from ..sources.messages import write_messages
from ..sources.synth import synth_clients, synth_products, synth_transactions


def publish_synthetic(
    spark: SparkSession,
    topics: Mapping[str, Source],
    base_ts: str,
    transactions: int = 500,
    clients: int = 50,
    products: int = 100,
    seed: int = 0,
) -> None:
    """Fill the three topics with made-up messages up to ``base_ts``, a UTC time."""
    rows = {
        "clients": (synth_clients(spark, clients, base_ts, seed), "client_id"),
        "products": (synth_products(spark, products, seed), "product_id"),
        "transactions": (
            synth_transactions(spark, transactions, clients, products, base_ts, seed),
            "transaction_id",
        ),
    }
    for topic, (df, key) in rows.items():
        write_messages(encode_messages(df, key), topics[topic])
