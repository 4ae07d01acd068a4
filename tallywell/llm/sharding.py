"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, number_within, uniform


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: of all shards the one whose draw for the key comes first.

    The draw of a shard is an exponential time with its weight as the rate, made from a
    hash of key and shard number. A shard therefore gets keys in proportion to its
    weight, and adding one moves only the keys that it wins. Equal keys share a
    shard; null is a key like any other; of equal draws the lower shard number wins.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    draws = [
        F.struct((-F.log(uniform(key, F.lit(shard))) / F.lit(float(w))).alias("at"), F.lit(shard).alias("shard"))
        for shard, w in enumerate(weights)
    ]
    return (F.array_min(F.array(*draws)) if len(draws) > 1 else draws[0])["shard"]


def assign_shards(
    docs: DataFrame, weights: Sequence[float], key: str = "doc_id", name: str = "shard"
) -> DataFrame:
    """All rows and columns with their shard, from 0, in column ``name``.

    A projection, nothing is shuffled. A column of that name is replaced; an empty
    table stays empty.
    """
    return docs.withColumn(name, rendezvous(col(key), weights))


def shard_slots(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    overhead: int = 8,
) -> DataFrame:
    """Where each row goes: shard, gapless place in it, and shard if one more is added.

    Columns: key, ``size`` (UTF-8 bytes plus ``overhead``; null is empty), ``text_crc32``,
    ``shard``, ``slot``, ``grown_shard`` (with one more shard of weight 1). Repeated rows
    get a slot each. Texts are not shuffled.
    """
    body = F.coalesce(col(text), F.lit(""))
    placed = docs.select(
        col(key),
        (F.octet_length(body).cast("long") + overhead).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        rendezvous(col(key), weights).alias("shard"),
        rendezvous(col(key), [*weights, 1.0]).alias("grown_shard"),
    )
    return number_within(placed, ["shard"], "slot", label="shards")
