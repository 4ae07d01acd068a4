"""SimHash fingerprints and their near duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import col, fresh, map_batches, slices
from .graph import components

BITS = 64
#: shingles hashed at a time
_BLOCK = 1 << 16
#: bytes of text that become Python's at a time, beside one whole text
_SLICE = 4_000_000
#: fingerprints of one bucket that are compared in one go
BUCKET = 512


# --- fingerprints -----------------------------------------------------------------


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Bits set in over half the XXH64 of the word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(min(width, len(words))))))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    votes = np.zeros(BITS, np.int64)
    for start in range(0, n, _BLOCK):
        block = np.fromiter(hashes, np.uint64, min(_BLOCK, n - start))
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "simhash", width: int = 3) -> DataFrame:
    """All rows and columns and the fingerprint of the whole text, as a long.

    Null texts count as empty. A column of that name is replaced.
    """
    docs = docs.drop(name)
    position = docs.columns.index(text)
    schema = docs.withColumn(name, F.lit(0).cast("long")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, position, _SLICE):
            found = [fingerprint(t, width) for t in batch.column(position).to_pylist()]
            longs = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, longs], names=[*batch.schema.names, name])

    return map_batches(docs, add, schema)


# --- pairs of fingerprints ----------------------------------------------------------


def covering_masks(free: list[int], radius: int) -> list[int]:
    """Masks over the ``free`` bits such that any ``radius`` of these are outside some mask.

    Bits get the non-zero vectors of ``radius + 1`` bits in turn, and a mask holds the
    bits with an odd product with its own vector. Some non-zero vector has even products with
    any ``radius`` others, so its mask leaves out any ``radius`` bits in which two
    fingerprints may differ.
    """
    count = (1 << (radius + 1)) - 1
    return [
        sum(1 << bit for i, bit in enumerate(free) if ((i % count + 1) & mask).bit_count() % 2)
        for mask in range(1, count + 1)
    ]


def mask_levels(radius: int) -> list[list[int]]:
    """Masks of ever finer tables, each of the next level refining one of the level before.

    Table ``t`` is refined by tables ``t * k`` to ``t * k + k - 1``, ``k`` being the number of masks
    of a level. They fix the bits of their table and, of the others, what a covering of those
    fixes. At the last level fewer than ten bits are left open.
    """
    levels = [covering_masks(list(range(BITS)), radius)]
    while max(BITS - m.bit_count() for m in levels[-1]) >= 10:
        levels.append(
            [
                mask | more
                for mask in levels[-1]
                for more in covering_masks([b for b in range(BITS) if not mask >> b & 1], radius)
            ]
        )
    return levels


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _star_edges(radius: int):
    """Within each bucket: every fingerprint with the least one reachable by links in it."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for members in batch.column(0).to_pylist():
                prints = np.unique(np.array(members, np.int64))
                bits = prints.view(np.uint64)
                near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
                root = np.full(len(prints), -1)
                for i in range(len(prints)):
                    frontier = np.array([i]) if root[i] < 0 else np.array([], int)
                    while len(frontier):
                        root[frontier] = i
                        frontier = np.flatnonzero(near[frontier].any(axis=0) & (root < 0))
                linked = root != np.arange(len(prints))
                low.append(prints[root[linked]])
                high.append(prints[linked])
            arrays = [np.concatenate([np.empty(0, np.int64), *x]) for x in (low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["a", "b"])

    return link


def near_fingerprints(prints: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a``, ``b`` that connect whatever fingerprints links connect.

    ``prints`` has distinct longs in ``simhash``. Two link if at most ``radius`` bits
    differ. Each fingerprint goes to one bucket in each table of the covering, so that two
    that link share one. Buckets of more than ``bucket`` are counted, not gathered, and dealt
    again by the next level's finer tables, in which their links meet again; at the
    last level a bucket holds fewer than a thousand for want of free bits. From a bucket
    come fewer edges than it has members, not all its pairs.
    """
    levels = mask_levels(radius)
    branches = len(levels[0])
    rows = prints.select(F.lit(0).alias("t"), "simhash")
    edges = []
    for depth, masks in enumerate(levels):
        literal = F.array(*(F.lit(_signed(m)) for m in masks[:branches])) if depth == 0 else _mask_table(masks, branches)
        dealt = rows.select(F.col("simhash"), F.col("t"), F.posexplode(literal).alias("i", "mask")).select(
            (F.col("t") * branches + F.col("i")).alias("t"),
            F.col("simhash").bitwiseAND(F.col("mask")).alias("k"),
            "simhash",
        )
        shared = materialize(dealt.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
        sized = dealt.join(shared, ["t", "k"])
        last = depth == len(levels) - 1
        small = sized if last else sized.filter(F.col("n") <= bucket)
        members = small.groupBy("t", "k").agg(F.collect_list("simhash").alias("members")).select("members")
        edges.append(map_batches(members, _star_edges(radius), "a long, b long"))
        if last or shared.filter(F.col("n") > bucket).isEmpty():
            break
        rows = sized.filter(F.col("n") > bucket).select("t", "simhash")
    return reduce(DataFrame.unionAll, edges).distinct()


def _mask_table(masks: list[int], branches: int) -> Column:
    """The masks that refine table ``t`` of the level before."""
    groups = [masks[i : i + branches] for i in range(0, len(masks), branches)]
    return F.get(F.array(*(F.array(*(F.lit(_signed(m)) for m in g)) for g in groups)), F.col("t"))


# --- documents ------------------------------------------------------------------------


def print_components(prints: DataFrame, key: str, radius: int = 3) -> DataFrame:
    """``simhash`` and ``component``: the least ``key`` of all rows reachable by links.

    ``prints`` has ``key`` and ``simhash``. Equal fingerprints link too. Null keys count last.
    """
    classes = materialize(
        prints.groupBy("simhash").agg(F.min(col(key)).alias("first_key")), "classes"
    )
    roots = components(near_fingerprints(classes.select("simhash"), radius))
    rooted = (
        classes.join(roots, classes.simhash == roots.node, "left")
        .select("simhash", "first_key", F.coalesce("root", "simhash").alias("root"))
    )
    least = rooted.groupBy(F.col("root").alias("of")).agg(F.min("first_key").alias("component"))
    return rooted.join(least, F.col("root") == F.col("of")).select("simhash", "component")


def simhash_components(docs: DataFrame, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` for each row.

    ``component_id`` is the least key that links reach. Null and blank texts have
    fingerprint zero and link like any other; repeated rows stay repeated; of null keys only,
    the component is null.
    """
    prints = materialize(
        with_fingerprint(docs.select(col(key), col(text).alias("text"))).select(col(key), "simhash"), "simhash"
    )
    found = print_components(prints, key, radius)
    return prints.join(found, "simhash").select(
        col(key),
        F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one stays.

    It is the one with the least key; of rows with equal keys, and where keys are
    null, the first read. Fingerprints are kept beside the rows, in a written table with
    numbered rows, so that what is dropped does not depend on a second reading.
    """
    row, simhash = fresh(docs, "row", "simhash")
    stored = materialize(
        with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()), text, simhash), "simhash"
    )
    prints = stored.select(
        F.struct(col(key).isNull().alias("none"), col(key).alias("key"), col(row).alias("row")).alias("place"),
        col(simhash).alias("simhash"),
    )
    found = print_components(prints, "place", radius)
    stays = (
        prints.join(found, "simhash").filter(F.col("place") != F.col("component")).select(F.col("place.row").alias("gone"))
    )
    return stored.join(stays, col(row) == F.col("gone"), "left_anti").drop(row, simhash)
