"""Ranked lexical search: hashed max-sketches bound the scores, the best bounds are scored exactly."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import col, map_batches, slices

# fixed values: ASCII letters and digits, and whatever is not ASCII, make terms; A-Z become a-z
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: bytes of text that become Python's at a time, beside one whole text
_SLICE = 4_000_000
#: coordinates of a sketch
WIDTH = 1024
#: documents whose sketches are made at a time
_BATCH = 2048
#: bounds that are looked into at a time before the threshold is looked at again
_STEP = 32
#: items, and their different terms, that are looked up in one pass over the documents
BLOCK_ITEMS, BLOCK_TERMS = 1_000, 100_000


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, repeats included, in UTF-8."""
    return (text or "").encode().translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Lookup:
    """A block of items: their terms, numbered, and for each item the numbers of its terms."""

    items: Sequence[int]
    numbers: dict[bytes, int]
    asked: Sequence[np.ndarray]

    @staticmethod
    def of(items: Sequence[tuple[int, Sequence[bytes]]]) -> Lookup:
        numbers = {t: i for i, t in enumerate(sorted({t for _, own in items for t in own}))}
        return Lookup(
            [item for item, _ in items],
            numbers,
            [np.array(sorted(numbers[t] for t in set(own)), np.int64) for _, own in items],
        )


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item`` and ``term``: the different terms of each item."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            of = np.repeat(np.arange(len(own)), [len(t) for t in own])
            found = pa.array([x for t in own for x in t], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), found], names=["item", "term"])

    rows = items.select(col(key).cast("long").alias("item"), col(text).alias("text"))
    return map_batches(rows, find, "item long, term binary").distinct()


def blocks(found: DataFrame, most_items: int, most_terms: int) -> Iterator[Lookup]:
    """The items in blocks of at most so many, and so many terms unless one item has more."""
    block: list[tuple[int, list[bytes]]] = []
    known: set[bytes] = set()
    ordered = found.groupBy("item").agg(F.collect_list("term").alias("terms")).orderBy("item")
    for row in ordered.toLocalIterator():
        own = [bytes(t) for t in row.terms]
        if block and (len(block) >= most_items or len(known.union(own)) > most_terms):
            yield Lookup.of(block)
            block, known = [], set()
        block.append((row["item"], own))
        known.update(own)
    if block:
        yield Lookup.of(block)


# --- documents ----------------------------------------------------------------------------


def hits(docs: DataFrame, lookup: Lookup, key: str, text: str) -> DataFrame:
    """``key``, ``n`` and, in order, the numbers and frequencies of the asked terms of each document.

    Only documents with a term come out. Whole texts are read, once for a block of items.
    """
    schema = "key long, n long, terms array<int>, tfs array<int>"
    numbers = lookup.numbers

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, _SLICE):
            of, lengths, starts, found, tfs = [], [], [0], [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                words = terms(body)
                if not words:
                    continue
                counts = Counter(map(numbers.get, words))
                counts.pop(None, None)
                own = sorted(counts)
                of.append(i)
                lengths.append(len(words))
                found += own
                tfs += map(counts.__getitem__, own)
                starts.append(len(found))
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of, pa.int64())),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ],
                names=["key", "n", "terms", "tfs"],
            )

    return map_batches(docs.select(col(key).cast("long").alias("key"), col(text).alias("text")), find, schema)


@dataclass(frozen=True)
class Corpus:
    """What scores need of all documents: how many have a term, their terms, and each asked term's weight."""

    documents: int
    length: int
    weights: np.ndarray

    def impacts(self, n: np.ndarray, tf: np.ndarray, term: np.ndarray) -> np.ndarray:
        """What a term adds to the score of a document of ``n`` terms that has it ``tf`` times."""
        m = 100 - 90 + (90 * n * self.documents) // self.length
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def corpus_of(found: DataFrame, terms_asked: int) -> Corpus:
    """Counted over all documents; the driver gets a number for each asked term."""
    total = found.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(terms_asked, np.int64)
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weights = [math.floor(1000 * math.log((2 * total.n + 2) / (2 * int(d) + 1))) for d in df]
    return Corpus(total.n, total.length, np.array(weights, np.int64))


def coordinates(lookup: Lookup, width: int) -> np.ndarray:
    """The coordinate of each asked term."""
    number = np.arange(len(lookup.numbers), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((number >> np.uint64(32)) % np.uint64(width)).astype(np.int64)


class _Best:
    """The highest scores of one task's documents for each item, equal ones by ascending key."""

    def __init__(self, items: int, limit: int):
        self.limit = limit
        self.scores = [np.empty(0, np.int64) for _ in range(items)]
        self.keys = [np.empty(0, np.int64) for _ in range(items)]
        #: what a document needs at least to be among them
        self.threshold = np.ones(items, np.int64)

    def add(self, item: int, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.concatenate([self.scores[item], scores]), np.concatenate([self.keys[item], keys])
        order = np.lexsort((keys, -scores))[: self.limit]
        order = order[scores[order] > 0]
        self.scores[item], self.keys[item] = scores[order], keys[order]
        if len(order) == self.limit:
            self.threshold[item] = self.scores[item][-1]


def _rank(
    best: _Best,
    keys: np.ndarray,
    starts: np.ndarray,
    term: np.ndarray,
    impact: np.ndarray,
    at: np.ndarray,
    mix: np.ndarray,
    asked: np.ndarray,
) -> None:
    """Bound all documents of a batch for all items, then score those whose bound reaches the threshold.

    ``mix`` has for each coordinate and item the number of the item's terms there, so that its product
    with the sketches adds up a bound for each document: every term of the item counts with the
    largest impact that the document has at the term's coordinate. ``asked`` says which terms an item has.
    """
    rows = len(keys)
    sketch = np.zeros(rows * len(mix))
    row = np.repeat(np.arange(rows), np.diff(starts))
    np.maximum.at(sketch, row * len(mix) + at[term], impact.astype(np.float64))
    # sums of whole numbers below 2^53 are exact
    bounds = sketch.reshape(rows, -1) @ mix
    reaching = bounds >= best.threshold
    for item in np.flatnonzero(reaching.any(axis=0)):
        open_ = np.flatnonzero(reaching[:, item])
        open_ = open_[np.argsort(-bounds[open_, item], kind="stable")]
        for step in range(0, len(open_), _STEP):
            some = open_[step : step + _STEP]
            some = some[bounds[some, item] >= best.threshold[item]]
            if not len(some):
                break
            lengths = starts[some + 1] - starts[some]
            first = np.cumsum(lengths) - lengths
            places = np.arange(lengths.sum()) + np.repeat(starts[some] - first, lengths)
            counted = np.where(asked[item][term[places]], impact[places], 0)
            scores = np.add.reduceat(np.append(counted, 0), first)
            best.add(item, np.where(lengths > 0, scores, 0), keys[some])


def best_of_tasks(found: DataFrame, lookup: Lookup, corpus: Corpus, limit: int, width: int) -> DataFrame:
    """``item``, ``key``, ``score``: the best of the documents of each task, ``limit`` for each item."""
    at = coordinates(lookup, width)
    none = np.iinfo(np.int64).min

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(lookup.items)
        mix, asked = np.zeros((width, items)), np.zeros((items, len(at)), bool)
        for i, own in enumerate(lookup.asked):
            np.add.at(mix[:, i], at[own], 1)
            asked[i, own] = True
        best = _Best(items, limit)
        for whole in batches:
            for start in range(0, len(whole), _BATCH):
                batch = whole.slice(start, _BATCH)
                keys = batch.column(0).fill_null(none).to_numpy()
                lists = batch.column(2)
                starts = lists.offsets.to_numpy().astype(np.int64)
                starts = starts - starts[0]
                term = lists.flatten().to_numpy().astype(np.int64)
                tf = batch.column(3).flatten().to_numpy().astype(np.int64)
                n = np.repeat(batch.column(1).to_numpy(), np.diff(starts))
                _rank(best, keys, starts, term, corpus.impacts(n, tf, term), at, mix, asked)
        item = np.repeat(np.arange(items), [len(s) for s in best.scores])
        keys = np.concatenate(best.keys)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(lookup.items, pa.int64()).take(pa.array(item)),
                pa.array(keys, pa.int64(), mask=keys == none),
                pa.array(np.concatenate(best.scores)),
            ],
            names=["item", "key", "score"],
        )

    return map_batches(found, rank, "item long, key long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    limit: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_items: int = BLOCK_ITEMS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_key``, ``rank`` (from 1), ``key`` and ``score`` of each item's ``limit`` best documents.

    Terms are runs of ASCII letters and digits and of other than ASCII characters, A-Z as a-z. Each
    different term of an item adds its weight times its saturation in the document, in whole numbers.
    Documents without any term of the item have no score and aren't listed; equal scores go by ascending key.

    A document's impacts fold into a sketch, the largest at each of ``width`` coordinates; a term's
    coordinate is a hash. What a sketch has at the coordinates of an item's terms bounds the score
    from above. Each task takes the documents with the highest bounds first and scores them exactly, until
    no bound reaches the last of its best; what tasks keep is ranked once more. Only terms that
    some item asks for are folded in, as others only loosen bounds.

    Items are taken in blocks whose terms are sent to every task: at most ``block_items`` of them, and at most
    ``block_terms`` terms unless one item alone has more. For each block the texts are read once
    and what was found is written. Keys are whole numbers; null keys come first among equals. Null and
    empty texts have no terms; repeated documents are ranked each; rows of one item key are one item with
    the terms of all its texts, null included; either table may be empty. Other columns don't matter.
    """
    spark = docs.sparkSession
    ranked = []
    for lookup in blocks(materialize(item_terms(items, item_key, item_text), "items"), block_items, block_terms):
        found = materialize(hits(docs, lookup, key, text), "hits")
        corpus = corpus_of(found, len(lookup.numbers))
        ranked.append(materialize(best_of_tasks(found, lookup, corpus, limit, width), "best"))
    schema = f"`{item_key}` long, rank int, `{key}` long, score long"
    if not ranked:
        return spark.createDataFrame([], schema)
    best = ranked[0]
    for more in ranked[1:]:
        best = best.unionAll(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("key"))
    placed = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return placed.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")
