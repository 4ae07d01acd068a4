"""Poisson replication of documents to target weights of their sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import col, fresh, let, uniform

#: largest mean of one draw; larger means are the sum of several
_DRAW = 16
#: terms of the distribution; beyond, a mean of ``_DRAW`` leaves less than 2^-53
_TERMS = 80


def _poisson_table(mean: Column) -> Column:
    """P(count <= 0), P(count <= 1), ... of a Poisson distribution."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("table"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        total = state["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.array_append(state["table"], total).alias("table"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), start, step, lambda s: s["table"])


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    alpha: float = 0.7,
    epochs: float = 1.0,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """A row per source: its size in bytes and its mean repetition rate.

    The mix holds ``epochs`` times the bytes of ``docs``, a source its weight's share
    of them. Without ``weights`` a source weighs its bytes to the power ``alpha``. Sources
    that ``weights`` leaves out get none; null is a source, named ``None`` in ``weights``.
    Sources without any bytes are kept once.
    """
    size = F.octet_length(F.coalesce(col(text), F.lit("")))
    sizes = materialize(
        docs.groupBy(col(source).alias("source")).agg(F.sum(size.cast("long")).alias("bytes")), "sources"
    )
    if weights is None:
        share = F.pow(F.col("bytes").cast("double"), F.lit(alpha))
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(share)
    sizes = sizes.withColumn("weight", share)
    total = sizes.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    rate = F.col("weight") / F.lit(total.weight or 1.0) * F.lit(epochs * (total.bytes or 0)) / F.col("bytes")
    # rounded, as sums of doubles depend on their order
    return sizes.withColumn("rate", F.when(F.col("bytes") > 0, F.round(rate, 9)).otherwise(F.lit(1.0)))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    alpha: float = 0.7,
    epochs: float = 1.0,
    seed: int = 20,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The columns of ``docs`` for each copy, with ``copy`` from 0 and ``rate``, in random order.

    A document's number of copies is where its hash, as a uniform number, falls in the
    Poisson distribution of its source's rate: the same in every run, whatever the
    partitions. The order is by a hash of key and copy over the whole result.

    Rows of one key in one source have equal numbers of copies. Rows without a key draw by their text instead, so
    those of one source and one text have equal numbers. An empty table stays empty; columns named
    ``copy`` or ``rate`` are replaced.
    """
    docs = docs.drop("copy", "rate")
    table, draws, count, order = fresh(docs, "table", "draws", "count", "order")
    rates = source_rates(docs, weights, alpha, epochs, source, text)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / _DRAW).cast("int"))
    rates = rates.select(
        F.col("source").alias(fresh(docs, "of")[0]),
        F.col("rate"),
        parts.alias(draws),
        let(F.col("rate") / parts, _poisson_table).alias(table),
    )

    def drawn(part: Column) -> Column:
        # rows without a key draw by their text, or all would be kept or go together
        own = F.when(col(key).isNull(), uniform(col(text), F.lit(-seed), part)).otherwise(uniform(col(key), F.lit(seed), part))
        return let(own, lambda u: F.size(F.filter(col(table), lambda p: p <= u)))

    joined = docs.join(rates, col(source).eqNullSafe(F.col(rates.columns[0])), "left")
    counted = joined.withColumn(
        count,
        F.aggregate(F.sequence(F.lit(0), col(draws) - 1), F.lit(0), lambda total, part: total + drawn(part)),
    )
    copies = counted.filter(col(count) > 0).select(
        *(col(c) for c in docs.columns), "rate", F.explode(F.sequence(F.lit(0), col(count) - 1)).alias("copy")
    )
    # the split number parts many copies of one key, should there be any
    return (
        copies.withColumn(order, F.xxhash64(col(key), F.when(col(key).isNull(), col(text)), F.col("copy"), F.lit(seed + 1)))
        .orderBy(order, F.spark_partition_id())
        .drop(order)
    )
