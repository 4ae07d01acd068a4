"""Scores of texts by a hierarchical Pitman-Yor model of their words.

A token is predicted in two steps. Its symbol is either one of the ``symbols`` most frequent
words, the end of the text, "another frequent word" or "a rare word"; it depends on the symbol before it: each symbol
has a restaurant for what follows, and these restaurants share a parent. Another frequent word
comes from a restaurant over all words of the corpus, whose parent spells them: byte
by byte, from restaurants for the bytes before it, which share shorter contexts as
parents. A rare word comes from a restaurant of the very word before it, whatever that is; the restaurants of all
words share the one over all words as their parent. Tables are sampled by Gibbs sweeps and predictive probabilities
are averaged over sweeps. Words that the corpus lacks are one outcome, which gets what the restaurant over words leaves for
those it has not seen, so that all outcomes add up to one.

Restaurants of symbols for symbols and of bytes are as many as parameters allow, whatever the corpus. The
restaurant over words, and those of every word with every pair they have seen, grow with it and are Spark
tables. Parents are fitted to all tokens, not to the tables that their children send them.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import col, fresh, map_batches, slices
from .sketch import _mix

#: bytes, and the end of a word, which also stands before its first byte
_EDGE, _BYTES = 256, 257
#: classes of the second and third byte back in the longest spelling context
_CLASSES = 32
#: words counted by a task before it hands them on
_FLUSH = 150_000
#: bytes of text whose words are told apart at a time
_SLICE = 2 << 20
#: words after others that a task hands on at a time, and bytes of text whose pairs of words meet in a bucket
_HANDED, _BUCKET_BYTES = 300_000, 8 << 20
#: words, or pairs of words, that are seated at a time; texts whose scores are summed up in one group
_SEATED, _SEATED_PAIRS, _SUMMED = 50_000, 200_000, 1 << 13
#: words that one task of a sweep seats
_TASK_WORDS = 200_000
_LONGEST = 64


def _kept(sweeps: int) -> slice:
    """Which of the sweeps are averaged."""
    return slice(1, sweeps - 1) if sweeps > 2 else slice(0, 1)


@dataclass(frozen=True)
class Parameters:
    """``symbols``: words with restaurants for whatever follows. ``frequent``: words sent to every task
    to be looked up there, at most; all others are rare words, and joined. ``sweeps``: Gibbs sweeps, of which the first and
    the last are not kept. ``strength``: of every restaurant; discounts are estimated from counts of one and two.
    """

    symbols: int = 1022
    frequent: int = 100_000
    sweeps: int = 5
    strength: float = 1.0
    seed: int = 11


# --- restaurants ----------------------------------------------------------------------


def discount(counts: np.ndarray, weights: np.ndarray | None = None) -> float:
    """From how many counts are one and two."""
    weights = np.ones(len(counts)) if weights is None else weights
    one, two = weights[counts == 1].sum(), weights[counts == 2].sum()
    return float(np.clip(one / (one + 2 * two), 0.1, 0.95)) if one else 0.5


def seat(customers: np.ndarray, opening: np.ndarray, d: float, hashes: np.ndarray, salt: int) -> np.ndarray:
    """Tables that the customers of a dish sit at, after seating them one after another.

    After ``i`` customers at ``t`` tables the next opens one with probability
    ``opening / (opening + i - d t)``. Later customers come in groups of a sixty-fourth of
    those seated, over which that probability hardly moves. Draws come from
    ``hashes`` and ``salt``, so a dish is seated alike wherever it is.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    active, seated, step = np.flatnonzero(customers > 1), 1, 0
    while len(active):
        group = np.minimum(max(1, seated // 64), customers[active] - seated)
        p = opening[active] / (opening[active] + seated - d * tables[active])
        draw = (_mix(hashes[active], salt * 1_000_003 + step) >> np.uint64(11)) * 2.0**-53
        tables[active] += np.minimum(group, np.floor(group * p + draw).astype(np.int64))
        seated += max(1, seated // 64)
        step += 1
        active = active[customers[active] > seated]
    return tables


def pooled(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches, about ``most`` rows at a time: seating takes as many steps for few rows as for many."""
    found: list[pa.RecordBatch] = []
    for batch in batches:
        found.append(batch)
        if sum(map(len, found)) >= most:
            yield pa.concat_batches(found)
            found.clear()
    if found:
        yield pa.concat_batches(found)


@dataclass
class Restaurants:
    """A level of restaurants, dense: a row for each context, a column for each dish."""

    customers: np.ndarray
    parents: np.ndarray
    d: float
    strength: float
    tables: np.ndarray = field(init=False)

    def __post_init__(self):
        self.tables = np.minimum(self.customers, 1)

    def sample(self, above: np.ndarray, salt: int) -> None:
        """Seat all customers again; ``above`` are the dishes' probabilities in the parents."""
        row, dish = np.nonzero(self.customers)
        open_rows = self.strength + self.d * self.tables.sum(axis=1)
        names = _mix((row * self.customers.shape[1] + dish).astype(np.uint64), 5)
        found = seat(self.customers[row, dish], open_rows[row] * above[self.parents[row], dish], self.d, names, salt)
        self.tables[row, dish] = found

    def upward(self, contexts: int) -> np.ndarray:
        """Customers of the parents: a table sends one."""
        sent = np.zeros((contexts, self.customers.shape[1]), np.int64)
        np.add.at(sent, self.parents, self.tables)
        return sent

    def predict(self, above: np.ndarray) -> np.ndarray:
        total = self.customers.sum(axis=1, keepdims=True) + self.strength
        rest = self.strength + self.d * self.tables.sum(axis=1, keepdims=True)
        return (np.maximum(self.customers - self.d * self.tables, 0) + rest * above[self.parents]) / total


def sweep(levels: list[Restaurants], salt: int) -> np.ndarray:
    """One Gibbs sweep over levels, the most specific first; the predictions of that one.

    Each level is seated given what its parents predict, then sends its tables to them.
    """
    above = np.full((1, levels[0].customers.shape[1]), 1 / levels[0].customers.shape[1])
    predicted = [above]
    for level in reversed(levels):
        predicted.append(level.predict(predicted[-1]))
    for i, level in enumerate(levels):
        level.sample(predicted[len(levels) - 1 - i], salt * 16 + i)
        if i + 1 < len(levels):
            levels[i + 1].customers = level.upward(len(levels[i + 1].parents))
            levels[i + 1].tables = np.minimum(levels[i + 1].tables, levels[i + 1].customers)
    for level in reversed(levels):
        above = level.predict(above)
    return above


def symbol_model(counts: np.ndarray, p: Parameters) -> np.ndarray:
    """Log10 probability of each symbol after each, from counts of both."""
    n = len(counts)
    d = discount(counts[counts > 0])
    levels = [Restaurants(counts, np.zeros(n, int), d, p.strength)]
    levels.append(Restaurants(levels[0].upward(1), np.zeros(1, int), d, p.strength))
    kept = [sweep(levels, p.seed + s) for s in range(p.sweeps)][_kept(p.sweeps)]
    return np.log10(np.mean(kept, axis=0))


# --- spelling --------------------------------------------------------------------------


def spelled(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For the bytes and the end of each word: its place in the table of contexts and bytes.

    Second, where each word starts.
    """
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    ends = np.cumsum(lengths)
    symbols = np.full(ends[-1] if len(ends) else 0, _EDGE, np.int64)
    inner = np.ones(len(symbols), bool)
    inner[ends - 1] = False
    symbols[inner] = np.frombuffer(b"".join(words), np.uint8)
    one = np.concatenate([[_EDGE], symbols[:-1]])[: len(symbols)]
    two = np.where(one == _EDGE, _EDGE, np.concatenate([[_EDGE], one[:-1]])[: len(symbols)])
    three = np.where(two == _EDGE, _EDGE, np.concatenate([[_EDGE], two[:-1]])[: len(symbols)])
    classes = (two * 31 + three * 7919) % 1009 % _CLASSES
    return (one * _CLASSES + classes) * _BYTES + symbols, ends - lengths


@dataclass
class Spelling:
    """Log probabilities of bytes, a row for each different one; contexts without customers share theirs."""

    rows: np.ndarray
    row_of: np.ndarray

    @classmethod
    def of(cls, table: np.ndarray) -> Spelling:
        rows, row_of = np.unique(table.astype(np.float32), axis=0, return_inverse=True)
        return cls(rows, row_of.ravel())

    def logs(self, words: Sequence[bytes], places: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Natural log of each word's probability; ``places`` are how they are :func:`spelled`, where known."""
        if not len(words):
            return np.empty(0)
        places, starts = spelled(words) if places is None else places
        found = self.rows[self.row_of[places // _BYTES], places % _BYTES]
        return np.add.reduceat(found.astype(np.float64), starts)


@dataclass
class Sample:
    """The state after one sweep: tables of the word restaurant in all, how words are spelled,

    and, known after the next sweep only, the probability of spelling a word of the corpus.
    """

    tables: float
    spelling: Spelling
    spelled: float = 1.0


@dataclass
class WordModel:
    """The restaurant over words; ``samples[0]`` is the state before the first sweep."""

    d: float
    strength: float
    total: int
    seed: int
    samples: list[Sample]

    def seated(self, words: Sequence[bytes], counts: np.ndarray, base: np.ndarray, s: int) -> np.ndarray:
        """Tables of the words in sweep ``s``, given how they were spelled before it."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
        return seat(counts, (self.strength + self.d * self.samples[s - 1].tables) * base, self.d, hashes, self.seed + s)

    def kept(self) -> list[int]:
        return list(range(len(self.samples)))[1:][_kept(len(self.samples) - 1)]

    def rest(self, s: int) -> float:
        """What sweep ``s`` leaves for what the parent spells."""
        return (self.strength + self.d * self.samples[s].tables) / (self.total + self.strength)

    def log10(self, words: Sequence[bytes], counts: np.ndarray) -> np.ndarray:
        """Log10 of the averaged predictive probability of words of the corpus."""
        found, places = np.zeros(len(words)), spelled(words)
        before: tuple[int, np.ndarray] | None = None
        for s in self.kept():
            base = before[1] if before and before[0] == s - 1 else np.exp(self.samples[s - 1].spelling.logs(words, places))
            seated = self.seated(words, counts, base, s)
            after = np.exp(self.samples[s].spelling.logs(words, places))
            found += (counts - self.d * seated) / (self.total + self.strength) + self.rest(s) * after
            before = s, after
        return np.log10(found / len(self.kept()))

    def unseen(self) -> float:
        """Log10 of the averaged probability of a word that the corpus lacks."""
        return float(np.log10(np.mean([self.rest(s) * max(1 - self.samples[s].spelled, 1e-12) for s in self.kept()])))


def fit_words(rare: DataFrame, p: Parameters) -> WordModel:
    """Gibbs sweeps over the table of other words (``word``, ``c``) and how they are spelled.

    A sweep seats the customers of every word where the table lies, and brings together how many
    tables there are and how the words on them are spelled: a count for each context and byte.
    """
    sizes = rare.agg(
        F.count("*").alias("words"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") == 1).alias("one"), F.count_if(F.col("c") == 2).alias("two")
    ).first()
    d = discount(np.array([1, 2]), np.array([sizes.one, sizes.two]))
    contexts = _BYTES * _CLASSES
    # a task brings as much for few words as for many
    tasks = max(rare.sparkSession.sparkContext.defaultParallelism, -(-sizes.words // _TASK_WORDS))
    rare = rare.select("word", "c").coalesce(tasks)
    flat = Spelling.of(np.full((contexts, _BYTES), -np.log(_BYTES)))
    model = WordModel(d, p.strength, sizes.n, p.seed, [Sample(1.0, flat)])
    levels: list[Restaurants] = []
    for s in range(1, p.sweeps + 1):
        # what a sweep needs, not all states so far
        now = WordModel(d, p.strength, sizes.n, p.seed, [Sample(0.0, flat)] * (s - 1) + model.samples[-1:])

        def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, seated, known = np.zeros(contexts * _BYTES, np.int64), 0, 0.0
            for batch in pooled(batches, _SEATED):
                words, customers = batch.column(0).to_numpy(zero_copy_only=False).tolist(), batch.column(1).to_numpy()
                if words:
                    places, starts = spelled(words)
                    base = np.exp(now.samples[-1].spelling.logs(words, (places, starts)))
                    t = now.seated(words, customers, base, s)
                    np.add.at(counts, places, np.repeat(t, np.diff([*starts, len(places)])))
                    seated += int(t.sum())
                    known += base.sum()
            places = np.flatnonzero(counts)
            columns = [pa.array(np.append(places, -1)), pa.array([*counts[places].tolist(), seated], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([-2]), pa.array([known])], names=["place", "n"])

        rows = map_batches(rare, tables, "place long, n double")
        found = rows.groupBy("place").agg(F.sum("n").alias("n")).toPandas()
        customers = np.zeros((contexts, _BYTES), np.int64)
        sums = dict(zip(found.place[found.place < 0], found.n[found.place < 0]))
        found = found[found.place >= 0]
        customers.flat[found.place.to_numpy()] = found.n.to_numpy().astype(np.int64)
        model.samples[-1].spelled = min(1.0, sums.get(-2, 0.0))
        if not levels:
            ds = discount(customers[customers > 0])
            levels.append(Restaurants(customers, np.arange(contexts) // _CLASSES, ds, p.strength))
            levels.append(Restaurants(levels[0].upward(_BYTES), np.zeros(_BYTES, int), ds, p.strength))
            levels.append(Restaurants(levels[1].upward(1), np.zeros(1, int), ds, p.strength))
        levels[0].customers = customers
        levels[0].tables = np.minimum(np.maximum(levels[0].tables, np.minimum(customers, 1)), customers)
        spelling = Spelling.of(np.log(sweep(levels, p.seed + s)))
        model.samples.append(Sample(sums.get(-1, 0.0), spelling))
    return model


# --- counting --------------------------------------------------------------------------


@dataclass
class Words:
    """The words of some texts, text after text; ``rows`` tells whose they are, of ``texts`` in all."""

    words: pa.Array
    rows: np.ndarray
    texts: int

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words, rows = split.flatten(), np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())
        # white space around a text leaves empty ones
        kept = pc.not_equal(words, "")
        return cls(words.filter(kept).cast(pa.binary()), rows[kept.to_numpy(zero_copy_only=False)], len(texts))


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``word``, ``c``: how often the texts have each word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Table] = []

        def together() -> pa.Table:
            summed = pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("c", "sum")])
            return pa.table({"word": summed["word"], "c": summed["c_sum"]})

        for batch in slices(batches, 0, _SLICE):
            found.append(pa.table(pc.value_counts(Words.of(batch.column(0)).words).flatten(), ["word", "c"]))
            if sum(map(len, found)) >= _FLUSH:
                yield from together().to_batches()
                found.clear()
        if found:
            yield from together().to_batches()

    rows = map_batches(docs.select(col(text)), count, "word binary, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(words: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent words, at most ``most``, and the others.

    The cut is where counts by sixteenths of a power of two, which is all that is
    gathered, add up to ``most``. Words of more than 64 bytes count as others.
    """
    bin_of = F.when(
        F.octet_length("word") <= _LONGEST, F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    ).otherwise(F.lit(-1))
    sizes = words.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n")).filter("bin >= 0").collect()
    total, cut = 0, 1 << 30
    for row in sorted(sizes, reverse=True):
        total += row.n
        if total > most:
            break
        cut = row.bin
    return words.filter(bin_of >= cut), words.filter(bin_of < cut)


class Vocabulary:
    """Frequent words, the symbols among them, and what each adds to the scores."""

    def __init__(self, words: list[bytes], counts: np.ndarray, symbols: int):
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = counts[order]
        self.index = {w: i for i, w in enumerate(self.words)}
        self.listed = pa.array(self.words, pa.binary())
        self.symbols = min(symbols, len(words))
        self.other, self.end, self.rare = self.symbols, self.symbols + 1, self.symbols + 2
        self.width = self.symbols + 3
        #: by word; one more entry for words that are not frequent
        self.symbol_of = np.full(len(words) + 1, self.other)
        self.symbol_of[: self.symbols] = np.arange(self.symbols)
        self.symbol_of[-1] = self.rare

    def places(self, here: Words) -> np.ndarray:
        """The numbers of the words of texts."""
        return pc.fill_null(pc.index_in(here.words, value_set=self.listed), len(self.words)).to_numpy().astype(np.int64)

    def pairs(self, here: Words, places: np.ndarray) -> np.ndarray:
        """Numbers of the pairs of symbols, from the start to the end of each text: one more than it has words."""
        # the end of a text is the start of the next
        sequence = np.full(len(places) + here.texts + 1, self.end)
        sequence[np.arange(len(places)) + here.rows + 1] = self.symbol_of[places]
        return sequence[:-1] * self.width + sequence[1:]

    def frequent_words(self, here: Words, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Frequent words unless they and what is before them are symbols: the text, the number of the word before, the word's.

        Numbers are those of :meth:`rare_words`.
        """
        start, first = len(self.words), np.diff(here.rows, prepend=-1) != 0
        before = np.append(start, places[:-1])[: len(places)]
        before[first] = start
        after_symbol = (before < self.symbols) | first
        found = np.flatnonzero((places < start) & ~((places < self.symbols) & after_symbol))
        numbers = before[found]
        far = np.flatnonzero((numbers == start) & ~first[found])
        coded = here.words.take(pa.array(found[far] - 1)).dictionary_encode()
        hashes = [hashed(word) for word in coded.dictionary.to_numpy(zero_copy_only=False)]
        numbers[far] = np.array(hashes, np.int64)[coded.indices.to_numpy()]
        return here.rows[found], numbers, places[found]

    def rare_words(self, here: Words, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """How often each rare word comes in a text after each word: the text, the number of the word before, the rare one, how often.

        Numbers are those of frequent words, then the start of the text; the others are hashes.
        """
        start, rare = len(self.words), np.flatnonzero(places == len(self.words))
        coded = here.words.take(pa.array(rare)).dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        first = np.diff(here.rows, prepend=-1)[rare] != 0
        before = np.where(first, start, places[rare - 1])
        # a rare word before a rare one is the one before it here too
        far = np.flatnonzero((before == start) & ~first)
        before[far] = start + 1 + codes[far - 1]
        keys, n = np.unique((here.rows[rare] * (start + 1 + distinct) + before) * distinct + codes, return_counts=True)
        rest, codes = np.divmod(keys, max(distinct, 1))
        rows, before = np.divmod(rest, start + 1 + distinct)
        numbers, needed = np.arange(start + 1 + distinct), np.unique(before[before > start])
        words = coded.dictionary.take(pa.array(needed - start - 1)).to_numpy(zero_copy_only=False)
        numbers[needed] = [hashed(word) for word in words]
        return rows, numbers[before], coded.dictionary.take(pa.array(codes)), n


def hashed(word: bytes) -> int:
    """The number of a word that is not frequent, beyond all numbers of frequent ones."""
    return xxhash.xxh64_intdigest(word) >> 2 | 1 << 62


def symbol_counts(docs: DataFrame, text: str, vocabulary: Vocabulary) -> np.ndarray:
    n = vocabulary.width

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(n * n, np.int64)
        for batch in slices(batches, 0, _SLICE):
            here = Words.of(batch.column(0))
            pairs, times = np.unique(vocabulary.pairs(here, vocabulary.places(here)), return_counts=True)
            found[pairs] += times
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(found[places])], names=["pair", "n"])

    rows = map_batches(docs.select(col(text)), count, "pair long, n long")
    total = rows.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(n * n, np.int64)
    counts[total.pair.to_numpy(np.int64)] = total.n.to_numpy(np.int64)
    return counts.reshape(n, n)


# --- rare words after other words --------------------------------------------------------


@dataclass
class Contexts:
    """The restaurants for rare words after each word, as far as they are few: those of frequent words.

    ``customers`` and ``tables`` (averaged over sweeps) go by the numbers of the words; the last entry is the start of a text.
    ``before`` has the tables before each sweep that is kept. Restaurants of other words are rows of a table; they have
    so few customers that sweeps take them to have one table when they seat them.
    """

    d: float
    strength: float
    seed: int
    customers: np.ndarray
    before: dict[int, np.ndarray]
    tables: np.ndarray

    def seated(self, s: int, pairs: Pairs) -> np.ndarray:
        """Tables of the pairs in sweep ``s``."""
        size = np.append(self.before[s], 1.0)[np.minimum(pairs.context, len(self.customers))]
        return seat(pairs.c, (self.strength + self.d * size) * 10.0**pairs.parent, self.d, pairs.names, self.seed + s)

    def seats(self, pairs: Pairs) -> np.ndarray:
        """Tables of the pairs, averaged over sweeps; a single customer has one."""
        found = np.minimum(pairs.c, 1).astype(float)
        many = np.flatnonzero(pairs.c > 1)
        if len(many):
            found[many] = np.mean([self.seated(s, pairs.at(many)) for s in self.before], axis=0)
        return found

    def log10(self, pairs: Pairs, customers: np.ndarray, tables: np.ndarray, seats: np.ndarray | None = None) -> np.ndarray:
        """Log10 probability of each pair's word; ``customers`` and ``tables`` are of contexts that have no entry here.

        ``seats`` are the pairs', where known.
        """
        seats = self.seats(pairs) if seats is None else seats
        near = pairs.context < len(self.customers)
        place = np.where(near, pairs.context, 0)
        customers = np.where(near, self.customers[place], customers)
        tables = np.where(near, self.tables[place], tables)
        rest = (self.strength + self.d * tables) * 10.0**pairs.parent
        return np.log10((pairs.c - self.d * seats + rest) / (customers + self.strength))


@dataclass
class Pairs:
    """Rare words after others: what is before, how often, log10 probability in the parent, a hash for draws."""

    context: np.ndarray
    c: np.ndarray
    parent: np.ndarray
    names: np.ndarray

    COLUMNS = ("context", "c", "parent", "name")

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Pairs:
        context, c, parent, names = (pc.fill_null(batch.column(name), 0).to_numpy(zero_copy_only=False) for name in cls.COLUMNS)
        return cls(context, c, parent, names.view(np.uint64))

    def at(self, places: np.ndarray) -> Pairs:
        return Pairs(self.context[places], self.c[places], self.parent[places], self.names[places])


def paired(tokens: DataFrame, table: DataFrame, unseen: float, share: float) -> DataFrame:
    """Rare words (``of`` a row, ``learned`` or not, ``context``, ``word``, ``n`` times) with their pair's count ``c`` in learned rows.

    ``table`` has ``dish``, ``count``, ``log`` of the words learned. A pair is counted where its word is looked up. ``first``
    marks one row of each pair; only pairs met more than once need a ``name``. Rare words are ``share`` of the restaurant over words.
    """
    same = Window.partitionBy("word", "context")
    counted = tokens.join(table, F.col("word") == F.col("dish"), "left").select(
        "of", "context", "n", F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("log", F.lit(unseen)) - F.lit(float(np.log10(share)))).alias("parent"),
        F.coalesce(F.sum(F.when(F.col("learned"), F.col("n"))).over(same), F.lit(0)).alias("c"),
        (F.col("of") == F.min("of").over(same)).alias("first"),
        "word",
    )
    return counted.withColumn("name", F.when(F.col("c") > 1, F.xxhash64("word", "context"))).drop("word")


def fit_contexts(rare: DataFrame, frequent: int, p: Parameters) -> Contexts:
    """Gibbs sweeps over the pairs with several customers; pairs with one are counted.

    A sweep seats each pair where it lies, given the tables that its context had before, and brings together how
    many tables contexts have: one number for each frequent word.
    """
    pairs = rare.filter(F.col("first") & (F.col("c") > 0))
    place = F.least(F.col("context"), F.lit(frequent + 1)).alias("context")
    found = pairs.groupBy(place).agg(
        F.count("*").alias("dishes"), F.sum("c").alias("customers"), F.count_if(F.col("c") == 1).alias("one"), F.count_if(F.col("c") == 2).alias("two")
    ).toPandas()
    totals = np.zeros((3, frequent + 2))
    for i, name in enumerate(("dishes", "customers", "one")):
        totals[i, found.context.to_numpy(np.int64)] = found[name].to_numpy(float)
    d = discount(np.array([1, 2]), np.array([found.one.sum(), found.two.sum()]))
    dishes, customers, one = totals[:, :-1]
    several = materialize(pairs.filter("c > 1").select(*Pairs.COLUMNS), "pairs")
    return settled(d, p, dishes, customers, one, tables_of(several, frequent))


def settled(
    d: float, p: Parameters, dishes: np.ndarray, customers: np.ndarray, one: np.ndarray, several: Callable[[Contexts, int], np.ndarray]
) -> Contexts:
    """Gibbs sweeps over restaurants by context, of which ``one`` counts the dishes with one customer.

    ``several`` seats the pairs with several customers in a sweep; the tables of each context.
    """
    states = [dishes]
    for s in range(1, p.sweeps + 1):
        states.append(one + several(Contexts(d, p.strength, p.seed, customers, {s: states[-1]}, dishes), s))
    kept = list(range(1, p.sweeps + 1))[_kept(p.sweeps)]
    return Contexts(d, p.strength, p.seed, customers, {s: states[s - 1] for s in kept}, np.mean([states[s] for s in kept], axis=0))


def tables_of(several: DataFrame, frequent: int) -> Callable[[Contexts, int], np.ndarray]:
    """Seats a table of pairs, see :func:`settled`; contexts beyond ``frequent`` are left out of the sums."""

    def seated(now: Contexts, s: int) -> np.ndarray:
        def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seated = np.zeros(frequent + 2)
            for batch in pooled(batches, _SEATED_PAIRS):
                own = Pairs.of(batch)
                seated += np.bincount(np.minimum(own.context, frequent + 1), now.seated(s, own), frequent + 2)
            places = np.flatnonzero(seated)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(seated[places])], names=["context", "n"])

        rows = map_batches(several, tables, "context long, n double").groupBy("context").agg(F.sum("n").alias("n")).toPandas()
        found = np.zeros(frequent + 2)
        found[rows.context.to_numpy(np.int64)] = rows.n.to_numpy(float)
        return found[:-1]

    return seated


def context_logs(rare: DataFrame, contexts: Contexts) -> DataFrame:
    """The rows of ``rare``: ``of``, ``n``, ``count`` of the word, and ``log``, log10 of its probability.

    Only rows after words that are not frequent are joined with the restaurants of those.
    """
    far = F.col("context") >= len(contexts.customers)

    def seats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Pairs.of(batch)
            columns = [pa.array(own.context), pa.array(own.c), pa.array(contexts.seats(own))]
            yield pa.RecordBatch.from_arrays(columns, names=["after", "c", "t"])

    pairs = rare.filter(far & F.col("first") & (F.col("c") > 0)).select(*Pairs.COLUMNS)
    restaurants = (
        map_batches(pairs, seats, "after long, c long, t double")
        .groupBy("after")
        .agg(F.sum("c").alias("customers"), F.sum("t").alias("tables"))
    )
    columns = ["of", "n", "count", *Pairs.COLUMNS]
    after_rare = rare.filter(far).select(*columns).join(restaurants, F.col("context") == F.col("after"), "left").drop("after")
    rows = rare.filter(~far).select(*columns).unionByName(after_rare, allowMissingColumns=True)

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            customers, tables = (pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False) for c in ("customers", "tables"))
            found = contexts.log10(Pairs.of(batch), customers, tables)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns[:3]), pa.array(found)], names=[*columns[:3], "log"])

    return map_batches(rows, logs, "of long, n long, count long, log double")


# --- frequent words after other words ----------------------------------------------------


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes: the least, how many bytes each takes beyond it, then first bytes first, so that those that are alike lie together."""
    least = int(values.min()) if len(values) else 0
    beyond = values - least
    beyond = beyond.astype(np.min_scalar_type(beyond.max() if len(values) else 0))
    data = beyond.view(np.uint8).reshape(-1, beyond.itemsize).T.tobytes()
    return struct.pack("<qB", least, beyond.itemsize) + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def opened(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    least, size = struct.unpack_from("<qB", data)
    found = pa.Codec("zstd").decompress(memoryview(data)[9:], decompressed_size=n * size, asbytes=True)
    return np.frombuffer(found, np.uint8).reshape(size, n).T.copy().view(f"u{size}").ravel().astype(np.int64) + least


def coded(context: np.ndarray, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as small numbers in their order, and what those from ``frequent`` + 1 on stand for."""
    far = np.flatnonzero(context > frequent)
    names, places = np.unique(context[far], return_inverse=True)
    code = context.copy()
    code[far] = frequent + 1 + places
    return code, names


def decoded(code: np.ndarray, names: np.ndarray, frequent: int) -> np.ndarray:
    far = np.flatnonzero(code > frequent)
    context = code.copy()
    context[far] = names[code[far] - frequent - 1]
    return context


def blocks(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of blocks, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Met:
    """Pairs of words and the texts they are in. ``context``, ``word``, ``c`` (in learned texts) and ``times`` (entries) go by
    pair, ordered by context and word; ``text`` and ``n`` (how often) by entry, pair after pair.
    """

    context: np.ndarray
    word: np.ndarray
    c: np.ndarray
    times: np.ndarray
    text: np.ndarray
    n: np.ndarray

    NAMES = ("context", "word", "c", "times", "text", "n")
    SCHEMA = "bucket int, pairs int, entries int, context binary, word binary, c binary, times binary, text binary, n binary"
    TYPE = pa.struct([(x.split()[0], pa.int32() if x.endswith("int") else pa.binary()) for x in SCHEMA.split(", ")])

    @classmethod
    def of(cls, row: dict) -> Met:
        """From a row of ``SCHEMA``, whose columns by entry may be left out."""
        sizes = [row["pairs"]] * 4 + [row["entries"]] * 2
        found = {name: opened(row[name], n) if name in row else np.empty(0, np.int64) for name, n in zip(cls.NAMES, sizes)}
        found["context"] = np.cumsum(found["context"])
        return cls(**found)

    def row(self, bucket: int) -> tuple:
        columns = (np.diff(self.context, prepend=0), self.word, self.c, self.times, self.text, self.n)
        return bucket, len(self.word), len(self.n), *map(squeezed, columns)

    @classmethod
    def batch(cls, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, of.type) for x, of in zip(zip(*rows), cls.TYPE)], schema=pa.schema(cls.TYPE))

    def dense(self, vocabulary: Vocabulary) -> np.ndarray:
        """Which pairs are after a symbol or the start of a text."""
        return (self.context < vocabulary.symbols) | (self.context == len(vocabulary.words))


def pair_buckets(context: np.ndarray, word: np.ndarray, dense: np.ndarray, buckets: int) -> np.ndarray:
    """Where pairs meet: all pairs of a context, but of symbols and the start of texts, which have very many, each pair by itself."""
    return (_mix(context.astype(np.uint64) + np.where(dense, word, 0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 9) % np.uint64(buckets)).astype(np.int64)


class Gathered:
    """Frequent words after other words in the texts a task has seen, until they are handed on.

    Each pair goes out once, with the texts it is in, in columns of numbers by bucket: a row for each word of each text would be several times as large.
    """

    def __init__(self, vocabulary: Vocabulary, buckets: int):
        self.vocabulary, self.buckets = vocabulary, buckets
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.texts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.numbered = 0, 0

    def add(self, here: Words, places: np.ndarray, numbers: np.ndarray, learned: np.ndarray) -> None:
        """``numbers`` of the texts, and which are learned from."""
        text, context, word = self.vocabulary.frequent_words(here, places)
        self.parts.append(((text + self.numbered).astype(np.int32), context, word.astype(np.int32)))
        self.texts.append((numbers, learned))
        self.size, self.numbered = self.size + len(text), self.numbered + len(numbers)

    def handed_on(self) -> pa.RecordBatch | None:
        if not self.size:
            return None
        text, context, word = (np.concatenate(x) for x in zip(*self.parts))
        numbers, learned = (np.concatenate(x) for x in zip(*self.texts))
        self.parts, self.texts, self.size, self.numbered = [], [], 0, 0
        frequent = len(self.vocabulary.words)
        code, names = coded(context, frequent)
        of_word, of_text = frequent.bit_length(), len(numbers).bit_length()
        entries = (code << of_word | word) << of_text | text
        entries.sort()
        first = np.flatnonzero(np.diff(entries, prepend=-1))
        n = np.diff(np.append(first, len(entries)))
        entries = entries[first]
        pair, text = entries >> of_text, entries & (1 << of_text) - 1
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        times, c = np.diff(np.append(starts, len(pair))), np.add.reduceat(n * learned[text], starts)
        pair = pair[starts]
        code, word = pair >> of_word, pair & (1 << of_word) - 1
        met = Met(decoded(code, names, frequent), word, c, times, numbers[text], n)
        bucket = pair_buckets(met.context, word, met.dense(self.vocabulary), self.buckets).astype(np.min_scalar_type(self.buckets))
        order = np.argsort(bucket, kind="stable")
        found, end = [], 0
        for b, size in enumerate(np.bincount(bucket, minlength=self.buckets).tolist()):
            of, end = order[end : end + size], end + size
            if size:
                entry = blocks(starts[of], times[of])
                found.append(Met(met.context[of], word[of], c[of], times[of], met.text[entry], n[entry]).row(b))
        return Met.batch(found)


def met_words(gathered: DataFrame, frequent: int) -> DataFrame:
    """A row of ``Met.SCHEMA`` for each bucket, of the rows that tasks handed on."""

    def together(table: pa.Table) -> pa.Table:
        parts = [Met.of(row) for row in table.to_pylist()]
        context, word, c, times, text, n = (np.concatenate([getattr(x, name) for x in parts]) for name in Met.NAMES)
        code, names = coded(context, frequent)
        of_word = frequent.bit_length()
        pair = code << of_word | word
        # each part is in order
        order = np.argsort(pair, kind="stable")
        entry = blocks((np.cumsum(times) - times)[order], times[order])
        pair = pair[order]
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        pair = pair[first]
        code, word = pair >> of_word, pair & (1 << of_word) - 1
        c, times = (np.add.reduceat(x[order], first) for x in (c, times))
        met = Met(decoded(code, names, frequent), word, c, times, text[entry], n[entry])
        return pa.Table.from_batches([Met.batch([met.row(table["bucket"][0].as_py())])])

    return materialize(gathered.groupBy("bucket").applyInArrow(together, Met.SCHEMA), "met")


def met_logs(met: DataFrame, vocabulary: Vocabulary, symbols: np.ndarray, own: np.ndarray, p: Parameters) -> DataFrame:
    """``met`` a text, ``met_score``: log10 probability of the frequent words after other words in it, given that such a word follows.

    ``symbols`` are log10 probabilities of symbols after symbols, ``own`` of other frequent words by themselves. Restaurants of words that are no symbols
    lie in one bucket each and are swept there; those of symbols are a bounded number, whose tables are brought together.
    """
    few, start = vocabulary.symbols, len(vocabulary.words)
    word_logs = own[:start]
    # after a word that is no symbol, by what it counts as
    classes = {}
    for kind in (vocabulary.other, vocabulary.rare):
        logs = np.where(np.arange(start) < few, symbols[kind][vocabulary.symbol_of[:start]], symbols[kind, vocabulary.other] + word_logs)
        classes[kind] = logs - following(symbols, kind, vocabulary)

    def pairs_of(own: Met, some: np.ndarray, context: np.ndarray) -> Pairs:
        """``context``: a number for the context of each of ``some`` pairs."""
        before, word = own.context[some], own.word[some]
        parent = np.where(before < start, classes[vocabulary.other][word], classes[vocabulary.rare][word])
        parent = np.where((before < few) | (before == start), word_logs[word], parent)
        return Pairs(context, own.c[some], parent, _mix(before.astype(np.uint64) * np.uint64(start + 1) + word.astype(np.uint64), 6))

    def after_symbols(own: Met) -> Pairs:
        some = np.flatnonzero(own.dense(vocabulary))
        return pairs_of(own, some, np.minimum(own.context[some], few))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By symbol, then the start of texts, then all other words: dishes, customers, dishes with one and two."""
        found = np.zeros((4, few + 2))
        for batch in batches:
            for row in batch.to_pylist():
                own = Met.of(row)
                place = np.where(own.dense(vocabulary), np.minimum(own.context, few), few + 1)
                for i, n in enumerate((own.c > 0, own.c, own.c == 1, own.c == 2)):
                    found[i] += np.bincount(place, n, few + 2)
        columns = [pa.array(x) for x in (np.arange(few + 2), *found)]
        yield pa.RecordBatch.from_arrays(columns, names=["context", "dishes", "customers", "one", "two"])

    by_pair = met.select("pairs", "entries", "context", "word", "c", "times")
    found = map_batches(by_pair, sizes, "context long, dishes double, customers double, one double, two double")
    found = found.groupBy("context").agg(*(F.sum(x).alias(x) for x in ("dishes", "customers", "one", "two"))).toPandas()
    dishes, customers, one, two = np.zeros((4, few + 2))
    for name, totals in (("dishes", dishes), ("customers", customers), ("one", one), ("two", two)):
        totals[found.context.to_numpy(np.int64)] = found[name].to_numpy(float)
    near, far = (discount(np.array([1, 2]), np.array([one[x].sum(), two[x].sum()])) for x in (slice(0, -1), slice(-1, None)))

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = after_symbols(Met.of(row))
                own = own.at(np.flatnonzero(own.c > 1))
                columns = (own.context, own.c, own.parent, own.names.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=Pairs.COLUMNS)

    seated = materialize(map_batches(by_pair, several, "context long, c long, parent double, name long"), "pairs")
    contexts = settled(near, p, dishes[:-1], customers[:-1], one[:-1], tables_of(seated, few))

    def after_others(own: Met) -> np.ndarray:
        some = np.flatnonzero(~own.dense(vocabulary))
        # in order
        code = np.cumsum(np.diff(own.context[some], prepend=-1) != 0) - 1
        pairs, size = pairs_of(own, some, code), code[-1] + 1 if len(code) else 0
        several = np.flatnonzero(pairs.c > 1)
        many, tables = pairs.at(several), {}

        def seat_many(now: Contexts, s: int) -> np.ndarray:
            tables[s] = now.seated(s, many)
            return np.bincount(many.context, tables[s], size)

        dishes, customers, one = (np.bincount(code, n, size) for n in (pairs.c > 0, pairs.c, pairs.c == 1))
        swept = settled(far, p, dishes, customers, one, seat_many)
        seats = np.minimum(pairs.c, 1).astype(float)
        seats[several] = np.mean([tables[s] for s in swept.before], axis=0)
        return swept.log10(pairs, 0, 0, seats)

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, found = Met.of(row), np.zeros(row["pairs"])
                dense = own.dense(vocabulary)
                found[dense] = contexts.log10(after_symbols(own), 0, 0)
                found[~dense] = after_others(own)
                text = pa.array(own.text).dictionary_encode()
                score = np.bincount(text.indices.to_numpy(), np.repeat(found, own.times) * own.n, len(text.dictionary))
                texts = text.dictionary.to_numpy()
                order = np.argsort(texts, kind="stable")
                texts, score = texts[order], score[order]
                groups, starts = np.unique(texts // _SUMMED, return_index=True)
                at = pa.array(np.append(starts, len(texts)), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in ((texts % _SUMMED).astype(np.int16), score)]
                yield pa.RecordBatch.from_arrays([pa.array(groups), *lists], names=["texts", "of", "score"])

    def summed(table: pa.Table) -> pa.Table:
        of = pc.list_flatten(table["of"]).to_numpy()
        score, times = np.bincount(of, pc.list_flatten(table["score"]).to_numpy(), _SUMMED), np.bincount(of, minlength=_SUMMED)
        found = np.flatnonzero(times)
        return pa.table({"met": table["texts"][0].as_py() * _SUMMED + found, "met_score": score[found]})

    # a row for each bucket and thousands of texts, not for each bucket and text
    lists = map_batches(met, logs, "texts long, of array<smallint>, score array<double>")
    return lists.groupBy("texts").applyInArrow(summed, "met long, met_score double")


def following(symbols: np.ndarray, kind: int, vocabulary: Vocabulary) -> float:
    """Log10 probability that a frequent word follows a symbol."""
    return float(np.log10((10.0 ** symbols[kind, : vocabulary.other + 1].astype(np.float64)).sum()))


# --- scoring ---------------------------------------------------------------------------


def score_texts(
    docs: DataFrame, learn: str, key: str = "doc_id", text: str = "text", parameters: Parameters = Parameters()
) -> DataFrame:
    """Log10 probabilities of all texts under a model learned from the rows with ``learn``.

    Columns: ``key``, ``learn``, ``n_tokens`` (words and an end), ``n_known`` (those in the learned
    texts), ``train_tokens``, ``base_score`` (words for themselves, a tenth added to each count),
    ``score`` (this model), ``perplexity`` (of ``score``, per token).

    A word the learned texts lack is one outcome, for both scores. Frequent words, a number bounded by a parameter, are scored
    where the text is; the others meet by word, with the table of words and with all that is before them
    elsewhere. Null texts count as empty, a null ``learn`` as false. Repeated
    rows stay repeated; with nothing to learn from, every word is unseen.
    """
    p = parameters
    row, tail, handed = fresh(docs, "row", "tail", "handed")
    rows = docs.select(
        F.monotonically_increasing_id().alias(row), col(key), F.coalesce(col(learn), F.lit(False)).alias(learn), col(text)
    )
    learned = rows.filter(col(learn))
    words = materialize(word_counts(learned, text), "words")
    ends, length = rows.agg(F.count_if(col(learn)), F.coalesce(F.sum(F.octet_length(col(text))), F.lit(0))).first()
    buckets = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-length // _BUCKET_BYTES))
    sizes = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = sizes.n + ends, sizes.v + (ends > 0)

    top, rest = frequent_words(words, p.frequent)
    top = top.toPandas()
    vocabulary = Vocabulary([bytes(w) for w in top.word], top.c.to_numpy(np.int64), p.symbols)
    symbols = symbol_model(symbol_counts(learned, text, vocabulary), p).astype(np.float32)
    names = vocabulary.words[: vocabulary.symbols]
    others = words.join(
        docs.sparkSession.createDataFrame([(w,) for w in names], "name binary"), F.col("word") == F.col("name"), "left_anti"
    )
    model = fit_words(others, p)

    # of a frequent word; nothing for the others
    base = np.append(np.log10(vocabulary.counts + 0.1), 0.0)
    own = np.zeros(len(base))
    own[vocabulary.symbols : -1] = model.log10(vocabulary.words[vocabulary.symbols :], vocabulary.counts[vocabulary.symbols :])
    # what the restaurant over words has for frequent words goes to these, the rest to rare ones
    ours = slice(vocabulary.symbols, len(vocabulary.words))
    unseen = model.unseen()
    share = float((10.0 ** own[ours]).sum())
    if share:
        own[ours] -= np.log10(share)
    share = max(1 - share, 10.0**unseen)
    # what a token adds where it is: after words that are no symbols, that a frequent word follows; which one is looked up, see met_logs
    steps = symbols.copy()
    for kind in (vocabulary.other, vocabulary.rare):
        steps[kind, : vocabulary.other + 1] = following(symbols, kind, vocabulary)
    steps = steps.ravel()
    end_base = np.log10(ends + 0.1)
    types = {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}
    schema = rows.drop(text).schema
    for name, kind in types.items():
        schema = schema.add(name, kind)
    columns_of = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    columns_of += [f"`{tail}` array<struct<context:bigint,word:binary,n:bigint>>", f"`{handed}` struct<{Met.SCHEMA.replace(' ', ':').replace(',:', ',')}>"]
    fields = ", ".join(columns_of)
    frequent = len(vocabulary.words)
    known = np.append(np.ones(frequent, np.int64), 0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, and rows of pairs in the last column only."""
        gathered, kinds = Gathered(vocabulary, buckets), []

        def hand_on() -> Iterator[pa.RecordBatch]:
            found = gathered.handed_on()
            if found is not None:
                columns = [*(pa.nulls(len(found), kind) for kind in kinds), found.to_struct_array()]
                yield pa.RecordBatch.from_arrays(columns, names=[*schema.names, tail, handed])

        for batch in slices(batches, 3, _SLICE):
            here = Words.of(batch.column(3))
            places = vocabulary.places(here)
            lengths = np.bincount(here.rows, minlength=here.texts)
            # a text has a place for each word, and one more for its end
            starts = np.cumsum(lengths + 1) - lengths - 1
            at = np.arange(len(places)) + here.rows

            def summed(of_words: np.ndarray, values: np.ndarray) -> np.ndarray:
                values[at] += of_words[places]
                return np.add.reduceat(values, starts)

            empty = len(places) + here.texts
            columns = [
                pa.array(lengths + 1),
                pa.array(summed(known, np.zeros(empty, np.int64)) + (ends > 0)),
                pa.array(summed(base, np.zeros(empty)) + end_base),
                pa.array(np.add.reduceat(steps[vocabulary.pairs(here, places)].astype(np.float64), starts)),
            ]
            of, before, words, n = vocabulary.rare_words(here, places)
            lists = pa.StructArray.from_arrays([pa.array(before), words, pa.array(n)], names=["context", "word", "n"])
            ends_at = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=here.texts))])
            lists = pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), lists)
            columns = [*batch.columns[:3], *columns, lists]
            kinds = [x.type for x in columns]
            columns.append(pa.nulls(len(batch), Met.TYPE))
            yield pa.RecordBatch.from_arrays(columns, names=[*schema.names, tail, handed])
            gathered.add(here, places, batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False))
            if gathered.size >= _HANDED:
                yield from hand_on()
        yield from hand_on()

    scored = materialize(map_batches(rows, score, fields), "scored")

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pooled(batches, _SEATED):
            logs = model.log10(batch.column(0).to_numpy(zero_copy_only=False).tolist(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs)], names=["dish", "count", "log"])

    table = map_batches(rest, looked_up, "dish binary, count long, log double")
    found = scored.select(F.col(row).alias("of"), col(learn).alias("learned"), F.explode(tail).alias("t")).select("of", "learned", "t.*")
    rare = materialize(paired(found, table, unseen, share), "rare")
    n = F.col("n")
    more = (
        context_logs(rare, fit_contexts(rare, frequent, p))
        .groupBy("of")
        .agg(
            F.sum(F.when(F.col("count") > 0, n).otherwise(F.lit(0))).alias("more_known"),
            F.sum(n * F.log10(F.col("count") + 0.1)).alias("more_base"),
            F.sum(n * F.col("log")).alias("more_score"),
        )
    )
    met = met_words(scored.filter(col(handed).isNotNull()).select(f"`{handed}`.*"), frequent)
    joined = scored.filter(col(row).isNotNull()).drop(tail, handed).join(more, col(row) == F.col("of"), "left")
    joined = joined.join(met_logs(met, vocabulary, symbols, own, p), col(row) == F.col("met"), "left")

    def plus(name: str, *extra: str):
        return reduce(Column.__add__, (F.coalesce(F.col(x), F.lit(0)) for x in extra), F.col(name))

    scale = float(np.log10(total + 0.1 * (distinct + 1)))
    return joined.select(
        col(key), col(learn), "n_tokens",
        plus("n_known", "more_known").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (plus("base_score", "more_base") - F.col("n_tokens") * scale).alias("base_score"),
        plus("score", "more_score", "met_score").alias("score"),
        F.pow(F.lit(10.0), -plus("score", "more_score", "met_score") / F.col("n_tokens")).alias("perplexity"),
    )
