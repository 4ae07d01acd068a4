"""Document fingerprints as invertible Bloom lookup tables of paragraph digests."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, map_batches

#: cells of a fingerprint, and by how much a table grows after a failure to peel
CELLS, GROWTH = 12, 4
#: cells that a digest goes to, one in each part of the table
_PARTS = 3
#: a line's pieces: up to a sentence's end, and no more than so many characters
_PARAGRAPH = re.compile(r"[^.!?\n]{1,48}[.!?\n]*|[.!?\n]+")
#: digests that are sketched together
_BATCH = 200_000
_LOW = -(1 << 63)


def _mix(x: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def paragraph_digests(text: str) -> np.ndarray:
    """A 64-bit digest of each paragraph, different for each time that it comes.

    The paragraphs are the lines, cut at sentence ends and after 48 characters, so that
    texts of one line have some too.
    """
    found = _PARAGRAPH.findall(text)
    digests = np.sort(np.fromiter((xxhash.xxh64_intdigest(p) for p in found), np.uint64, len(found)))
    places = np.arange(len(digests))
    first = np.r_[True, digests[1:] != digests[:-1]][: len(digests)]
    copy = places - np.maximum.accumulate(np.where(first, places, 0)) if len(digests) else places
    return _mix(digests + copy.astype(np.uint64) * np.uint64(0xA24BAED4963EE407), 1)


class Tables:
    """Several tables side by side: counts, sums of digests, and sums of their checks.

    ``sizes`` has the cells of each, multiples of three.
    """

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.counts = np.zeros(self.starts[-1], np.int64)
        self.keys = np.zeros(self.starts[-1], np.uint64)
        self.checks = np.zeros(self.starts[-1], np.uint64)

    def cells(self, of: np.ndarray, keys: np.ndarray) -> np.ndarray:
        part = self.sizes[of] // _PARTS
        return np.stack(
            [
                self.starts[of] + i * part + (_mix(keys, 100 + i) % part.astype(np.uint64)).astype(np.int64)
                for i in range(_PARTS)
            ]
        )

    def add(self, of: np.ndarray, keys: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """Put keys into table ``of``, or with sign -1 take them out; returns their cells."""
        at = self.cells(of, keys)
        wrapped = signs.astype(np.uint64)  # -1 wraps around, and so do the sums
        signed, checked = keys * wrapped, _mix(keys, 2) * wrapped
        for row in at:
            np.add.at(self.counts, row, signs)
            np.add.at(self.keys, row, signed)
            np.add.at(self.checks, row, checked)
        return at

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which tables come out empty, and how many keys of sign 1 and of sign -1 they had."""
        more, less = np.zeros(len(self.sizes), np.int64), np.zeros(len(self.sizes), np.int64)
        table = np.repeat(np.arange(len(self.sizes)), self.sizes)
        look = np.arange(len(self.counts))
        while len(look):
            look = look[np.abs(self.counts[look]) == 1]
            signs = self.counts[look]
            wrapped = signs.astype(np.uint64)
            keys = self.keys[look] * wrapped
            pure = _mix(keys, 2) == self.checks[look] * wrapped
            look, signs, keys = look[pure], signs[pure], keys[pure]
            # a key may be alone in more than one of its cells
            _, one = np.unique(_mix(keys, 3) + table[look].astype(np.uint64), return_index=True)
            of, signs, keys = table[look[one]], signs[one], keys[one]
            more += np.bincount(of, signs > 0, len(self.sizes)).astype(np.int64)
            less += np.bincount(of, signs < 0, len(self.sizes)).astype(np.int64)
            look = np.unique(self.add(of, keys, -signs)) if len(of) else of
        left = np.bincount(table, (self.counts != 0) | (self.keys != 0), len(self.sizes))
        return left == 0, more, less


def _concatenated(digests: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    of = np.repeat(np.arange(len(digests)), [len(d) for d in digests])
    return of, np.concatenate([np.empty(0, np.uint64), *digests])


def fingerprints(digests: Sequence[np.ndarray]) -> list[str]:
    """The smallest table of each, with the number of paragraphs before it."""
    tables = Tables(np.full(len(digests), CELLS))
    of, keys = _concatenated(digests)
    tables.add(of, keys, np.ones(len(keys), np.int64))
    shape = (len(digests), CELLS)
    cells = np.concatenate(
        [
            tables.counts.astype("<u4").reshape(shape).view("u1"),
            tables.keys.astype("<u8").reshape(shape).view("u1"),
            tables.checks.astype("<u8").reshape(shape).view("u1").reshape(*shape, 8)[:, :, :4].reshape(len(digests), -1),
        ],
        axis=1,
    )
    return [f"{len(d)}:{base64.b64encode(row.tobytes()).decode()}" for d, row in zip(digests, cells)]


def differences(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair, how many digests only the first and only the second has.

    Tables of the pairs are subtracted and peeled; those that keep something are made
    anew ``GROWTH`` times as large, until all came out.
    """
    only_a, only_b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    left, size = np.arange(len(a)), CELLS
    while len(left):
        tables = Tables(np.full(len(left), size))
        for side, sign in ((a, 1), (b, -1)):
            of, keys = _concatenated([side[i] for i in left])
            tables.add(of, keys, np.full(len(keys), sign))
        empty, more, less = tables.peel()
        only_a[left[empty]], only_b[left[empty]] = more[empty], less[empty]
        left, size = left[~empty], size * GROWTH
    return only_a, only_b


def likeness(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> np.ndarray:
    """Shared paragraphs among all of both, from what peeling the difference recovers."""
    only_a, only_b = differences(a, b)
    n = np.array([len(x) for x in a], np.int64)
    union = n + only_b
    return np.where(union > 0, (n - only_a) / np.maximum(union, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the start of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


# --- on tables -------------------------------------------------------------------------


def with_next(docs: DataFrame, key: str, text: str, block_rows: int = 4096, most_blocks: int = 10_000) -> DataFrame:
    """Rows dealt into blocks of consecutive keys: ``block``, ``extra``, ``key``, ``body``.

    The first rows of a block come once more, as ``extra``, at the end of the block before it (of the
    first, after the last one), so that every row has its next one beside it and texts are shuffled
    once. What the driver sees are the blocks' first keys, of which there are at most ``most_blocks``.
    """
    rows = docs.select(
        col(key),
        F.coalesce(col(key).cast("long"), F.lit(_LOW)).alias("place"),
        F.coalesce(col(text), F.lit("")).alias("body"),
    )
    n, low = rows.agg(F.count("*").alias("n"), F.min("place").alias("low")).first()
    blocks = min(most_blocks, max(1, n // block_rows))
    shares = F.array(*(F.lit(i / blocks) for i in range(1, blocks))) if blocks > 1 else None
    inner = rows.agg(F.percentile_approx("place", shares, 100_000).alias("at")).first().at if shares is not None else []
    first = np.array(sorted({low if low is not None else _LOW, *inner}), np.int64)

    @F.pandas_udf("int")
    def block_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(first, place.to_numpy(), side="right") - 1)

    @F.pandas_udf("boolean")
    def begins(place: pd.Series) -> pd.Series:
        return pd.Series(np.isin(place.to_numpy(), first))

    before = F.pmod(F.col("block") - 1, F.lit(len(first)))
    places = F.when(
        F.col("begins"), F.array(F.struct("block", F.lit(False)), F.struct(before.alias("block"), F.lit(True)))
    ).otherwise(F.array(F.struct("block", F.lit(False))))
    dealt = (
        rows.withColumns({"block": block_of("place"), "begins": begins("place")})
        .select(col(key).cast("long").alias("key"), "place", "body", F.explode(places).alias("p"))
        .select("p.block", F.col("p.col2").alias("extra"), "key", "place", "body")
    )
    return dealt.repartition("block").sortWithinPartitions("block", "extra", "place", "body").drop("place")


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint beside those of an edited version and of the next row.

    Columns: ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. The next row is that of the next integer ``key``, after the last
    the first; nulls come first, rows of equal keys in the order of their texts; a lone row is next
    to itself. Null texts count as empty, and empty ones are all alike (1.0).
    """
    schema = docs.select(col(key).cast("long").alias(key)).schema
    for name in ("edited_sha256", "fingerprint", "edited_fingerprint"):
        schema = schema.add(name, "string")
    schema = schema.add("n_chars", "long").add("near_edited", "double").add("near_next", "double")
    columns = schema.names

    def sketched(rows: list[tuple]) -> pa.RecordBatch:
        keys, lengths, hashes, own, changed, following = zip(*rows)
        values = [
            pa.array(keys, pa.int64()), pa.array(hashes), pa.array(fingerprints(own)),
            pa.array(fingerprints(changed)), pa.array(lengths, pa.int64()), pa.array(likeness(own, changed)),
            pa.array(likeness(own, following)),
        ]
        return pa.RecordBatch.from_arrays(values, names=columns)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Neighbours within a block, each row with its digests."""
        last = None
        for batch in batches:
            for block, extra, k, body in zip(*(c.to_pylist() for c in batch.columns)):
                row = (block, extra, k, body, None)
                if last is not None and last[0] == block and not last[1]:
                    row = (*row[:4], paragraph_digests(body))
                    yield last, row
                elif not extra:
                    row = (*row[:4], paragraph_digests(body))
                last = row

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for (_, _, k, body, own), (_, _, _, next_body, following) in pairs(batches):
            changed = edited(body, next_body)
            digests = paragraph_digests(changed)
            rows.append((k, len(body), hashlib.sha256(changed.encode()).hexdigest(), own, digests, following))
            size += len(own) + len(digests) + len(following)
            if size >= _BATCH:
                yield sketched(rows)
                rows, size = [], 0
        if rows:
            yield sketched(rows)

    return map_batches(with_next(docs, key, text), sketch, schema)

