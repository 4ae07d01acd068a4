"""Packing token sequences: large items matched, small ones best-fit into the gaps."""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import col, map_batches, number_within, slices

#: distinct words whose ids a Python worker remembers, and as many it has not used since
_REMEMBERED = 500_000
#: characters of text a Python worker holds at a time, beside one whole text
_SLICE = 4_000_000
_SPECIAL = "<|"


# --- tokens ----------------------------------------------------------------------


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids of stretches of text from one space up to the next, as little-endian bytes.

    A space before anything but a space always begins a token of its own, so a text's
    ids are those of its stretches one after another. Two generations are kept: what is
    used moves to the younger one, and when that is full the elder one goes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.elder: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.space = self.letters[ord(" ")]

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, stretch: str) -> bytes:
        head, line, tail = stretch.partition("\n")
        if head and tail and not head[-1].isspace() and not tail[0].isspace():
            # a line end between two words is a token of its own; such stretches hardly recur
            return self[head] + self[line] + self[tail]
        if len(self) >= _REMEMBERED:
            self.elder = dict(self)
            self.clear()
        found = self.elder.get(stretch)
        if found is None:
            found = self._found(stretch)
        self[stretch] = found
        return found

    def _found(self, stretch: str) -> bytes:
        spaced = stretch[:1] == " "
        word = stretch[1:] if spaced else stretch
        if word.isalpha() and len(word) < 100:
            # one stretch of letters is one token before merging
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.tokenize(self.space + spelled if spaced else spelled)]).tobytes()
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            return self[stretch[:-1]] + self[stretch[-1]]
        return self.encode(stretch)

    def ids(self, text: str) -> bytes:
        if "  " in text or _SPECIAL in text:
            return self.encode(text)
        first, *rest = text.split(" ")
        return b"".join([self[first] if first else b"", *map(self.__getitem__, [" " + w for w in rest])])


_words: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]


def pieces(
    docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per piece of each document: key, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its tokens and the id ``end``. Only those longer than ``capacity`` are
    cut, into full pieces and a first one that may be shorter. Null texts count as empty.
    """
    schema = docs.select(col(key)).schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)
    tail = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        for batch in slices(batches, 1, _SLICE):
            of, rows = [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                ids = words.ids(body or "") + tail
                n = len(ids) // 4
                bounds = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    of.append(i)
                    rows.append((piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            table = np.array(rows, np.int64).reshape(-1, 4)
            columns = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(table[:, 0].astype(np.int32))]
            columns += [pa.array(table[:, j]) for j in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(docs.select(col(key), col(text)), cut, schema)


# --- bins --------------------------------------------------------------------------


def plan_bins(lengths: Mapping[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for so many items of each length: ``(bins, [(length, items in each), ...])``.

    Items above a third of the capacity come first: from the longest down, each is matched
    with the longest other that fits, and no bin takes a third. The rest, from the
    longest down, goes to the bins with the smallest gap that holds it, and to new
    bins if there is none. Equal items are placed together, so the work depends on
    the number of lengths, not of items.
    """
    left = {n: c for n, c in sorted(lengths.items(), reverse=True) if c > 0}
    open_bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []

    def put(gap: int, count: int, items: list[tuple[int, int]]) -> None:
        if gap not in open_bins:
            open_bins[gap] = []
            bisect.insort(gaps, gap)
        open_bins[gap].append((count, items))

    large = [n for n in left if 3 * n > capacity]
    waiting = sorted(large)
    for n in large:
        while left[n]:
            while waiting and not left[waiting[-1]]:
                waiting.pop()
            at = bisect.bisect_right(waiting, capacity - n) - 1
            while at >= 0 and not left[waiting[at]]:
                waiting.pop(at)
                at -= 1
            other = waiting[at] if at >= 0 else None
            if other is None or other == n and left[n] == 1:
                put(capacity - n, left[n], [(n, 1)])
                left[n] = 0
            elif other == n:
                pairs = left[n] // 2
                put(capacity - 2 * n, pairs, [(n, 2)])
                left[n] -= 2 * pairs
            else:
                pairs = min(left[n], left[other])
                put(capacity - n - other, pairs, [(n, 1), (other, 1)])
                left[n] -= pairs
                left[other] -= pairs

    for n in (n for n in left if 3 * n <= capacity):
        count = left[n]
        while count:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                each = capacity // n
                if count >= each:
                    put(capacity - each * n, count // each, [(n, each)])
                if count % each:
                    put(capacity - count % each * n, 1, [(n, count % each)])
                break
            gap = gaps[at]
            bins, items = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap], gaps[at]
            each = gap // n
            filled = min(bins, count // each)
            if filled:
                put(gap - each * n, filled, [*items, (n, each)])
                count -= filled * each
            if bins > filled and count < each and count:
                put(gap - count * n, 1, [*items, (n, count)])
                filled, count = filled + 1, 0
            if bins > filled:
                put(gap, bins - filled, items)
    return [group for gap in gaps for group in open_bins[gap]]


def _places(plan: list[tuple[int, list[tuple[int, int]]]]) -> pd.DataFrame:
    """For each run of items of a length, by number: first bin, items in each, offset."""
    rows, used, sequence = [], {}, 0
    for bins, items in plan:
        offset = 0
        for length, each in items:
            low = used.get(length, 0)
            rows.append((length, low, sequence, each, offset))
            used[length] = low + bins * each
            offset += length * each
        sequence += bins
    return pd.DataFrame(rows, columns=["length", "low", "sequence", "each", "offset"], dtype="int64").sort_values(
        ["length", "low"]
    )


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``, their place in it.

    The driver sees the number of pieces of each length, at most ``capacity`` numbers,
    and packs those; what it sends out are runs of equal pieces, bounded by the capacity alone.
    Pieces are numbered within their length and find their place by their number.
    Empty texts are one token long; repeated rows are packed as often as they
    come; an empty table gives no rows.
    """
    found = materialize(pieces(docs, path, capacity, end, key, text), "pieces")
    counts = found.groupBy("length").agg(F.count("*").alias("n")).collect()
    places = _places(plan_bins({r.length: r.n for r in counts}, capacity))
    length, low, sequence, each, offset = (places[c].to_numpy() for c in places.columns)
    starts = (length << 48) + low

    numbered = number_within(found, ["length"], "number", label="numbered")
    schema = found.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(starts, (of << 48) + number, side="right") - 1
            rank = number - low[at]
            columns = [*batch.columns[:-1], pa.array(sequence[at] + rank // each[at]), pa.array(offset[at] + rank % each[at] * of)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(numbered, place, schema)
