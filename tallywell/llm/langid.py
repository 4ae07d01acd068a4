"""Language identification by multinomial logistic regression on character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, map_batches, uniform

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
#: characters whose n-grams are counted at a time
_BLOCK = 1 << 20


@dataclass(frozen=True)
class Training:
    """Parameters of a model.

    ``per_language`` bounds the sample: about so many labelled rows of each language are drawn,
    by a hash of their id. Document frequencies are counted over all labelled rows. ``rate``,
    ``beta``, ``l1`` and ``l2`` are those of follow-the-regularised-leader; ``calibrate`` is the
    share of the sample held back for the temperature.
    """

    bits: int = 15
    orders: tuple[int, ...] = (1, 2, 3)
    per_language: int = 2000
    shards: int = 8
    epochs: int = 3
    rate: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3
    calibrate: float = 0.2
    seed: int = 7


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0
    training: Training = field(default_factory=Training)


# --- features ----------------------------------------------------------------------


def ngram_counts(text: str | None, training: Training) -> np.ndarray | None:
    """Counts of hashed n-grams of the lower-case words; ``None`` without a letter."""
    words = _LETTERS.findall((text or "").lower())
    if not any(w.isalpha() for w in words) and not any(c.isalpha() for w in words for c in w):
        return None
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32)
    counts = np.zeros(1 << training.bits, np.int64)
    shift = np.uint32(32 - training.bits)
    for order in training.orders:
        for start in range(0, max(1, len(points) - order + 1), _BLOCK):
            block = points[start : start + _BLOCK + order - 1]
            mixed = np.full(len(block) - order + 1, order, np.uint32)
            for i in range(order):
                mixed = (mixed ^ block[i : i + len(mixed)]) * np.uint32(2654435761)
                mixed ^= mixed >> np.uint32(15)
            counts += np.bincount((mixed * np.uint32(2246822519)) >> shift, minlength=len(counts))
    return counts


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the non-zero features, of length one together."""
    places = np.flatnonzero(counts)
    values = (1 + np.log(counts[places])) * idf[places]
    return places, values / max(np.sqrt(values @ values), 1e-12)


# --- training -----------------------------------------------------------------------


def document_frequencies(docs: DataFrame, text: str, training: Training) -> tuple[int, np.ndarray]:
    """How many documents have letters, and how many of them each feature.

    Each split sums its own; the driver gets one number for each of the hashed features.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(1 << training.bits, np.int64), 0
        for batch in batches:
            for body in batch.column(0).to_pylist():
                counts = ngram_counts(body, training)
                if counts is not None:
                    found += counts > 0
                    n += 1
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(places, -1)), pa.array(np.append(found[places], n))], names=["feature", "n"]
        )

    rows = map_batches(docs.select(col(text)), count, "feature long, n long")
    total, frequencies = 0, np.zeros(1 << training.bits, np.int64)
    for row in rows.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        if row.feature < 0:
            total = row.n
        else:
            frequencies[row.feature] = row.n
    return total, frequencies


def _active(z: np.ndarray, n: np.ndarray, t: Training) -> np.ndarray:
    """Weights of follow-the-regularised-leader under the elastic net."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - t.l1, 0)
    return -shrunk / ((t.beta + np.sqrt(n)) / t.rate + t.l2)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_shard(rows: pd.DataFrame, classes: int, t: Training) -> np.ndarray:
    """Weights learned from the rows (``label``, ``places``, ``values``) of one shard."""
    z, n = np.zeros((1 << t.bits, classes)), np.zeros((1 << t.bits, classes))
    order = np.random.default_rng(t.seed)
    for _ in range(t.epochs):
        for i in order.permutation(len(rows)):
            label, places, values = rows.iloc[i]
            w = _active(z[places], n[places], t)
            error = softmax(values @ w)
            error[label] -= 1
            gradient = np.outer(values, error)
            square = n[places] + gradient**2
            z[places] += gradient - (np.sqrt(square) - np.sqrt(n[places])) / t.rate * w
            n[places] = square
    return _active(z, n, t)


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss, by golden section on its logarithm.

    Labels are smoothed: ``n`` rows that are all right leave a chance of ``1 / (n + 2)`` that the next one is wrong, so a
    label counts for all but that, and the rest goes to the other languages evenly. Without it the loss of rows that
    are all right falls with the temperature without end, and every score is one.
    """
    rows, classes = logits.shape if len(labels) else (0, 0)
    if not rows or classes < 2:
        return 1.0
    target = np.full((rows, classes), 1 / (rows + 2) / (classes - 1))
    target[np.arange(rows), labels] = 1 - 1 / (rows + 2)

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        return (target * (np.log(np.exp(scaled).sum(axis=1, keepdims=True)) - scaled)).sum(axis=1).mean()

    low, high, ratio = np.log(1e-3), np.log(1e3), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", training: Training = Training()
) -> LanguageModel:
    """A model of the non-null ``lang`` of ``docs``.

    Document frequencies come from all rows. Weights come from a bounded sample, in
    shards that each learn for themselves and are averaged; the temperature is fitted
    on the part of the sample they did not see. ``key`` only draws the sample.
    """
    t = training
    labelled = docs.filter(col(lang).isNotNull())
    sizes = labelled.groupBy(col(lang).alias("language")).agg(F.count("*").alias("n"))
    found = {r.language: r.n for r in sizes.collect()}
    languages = sorted(found)
    total, frequencies = document_frequencies(labelled, text, t)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    model = LanguageModel(languages, idf, np.zeros((1 << t.bits, len(languages))), 1.0, t)
    if not languages:
        return model

    draw = uniform(col(key), F.lit(t.seed))
    chance: Column = F.lit(0.0)
    number: Column = F.lit(-1)
    for i, name in enumerate(languages):
        chance = F.when(col(lang) == name, F.lit(t.per_language / found[name])).otherwise(chance)
        number = F.when(col(lang) == name, F.lit(i)).otherwise(number)
    sample = labelled.filter(draw < chance).select(
        number.alias("label"),
        # numbered from -1, where rows are for calibration
        F.when(uniform(col(key), F.lit(t.seed + 1)) < t.calibrate, F.lit(-1))
        .otherwise(F.pmod(F.xxhash64(col(key), F.lit(t.seed + 2)), F.lit(t.shards)).cast("int"))
        .alias("shard"),
        col(text).alias("text"),
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, shard, body in zip(*(c.to_pylist() for c in batch.columns)):
                counts = ngram_counts(body, t)
                if counts is not None:
                    places, values = tf_idf(counts, idf)
                    rows.append({"label": label, "shard": shard, "places": places.tolist(), "values": values.tolist()})
            yield pa.RecordBatch.from_pylist(rows, schema=vector_schema)

    vector_schema = pa.schema(
        [("label", pa.int32()), ("shard", pa.int32()), ("places", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]
    )
    features = map_batches(sample, vectors, "label int, shard int, places array<int>, values array<double>")

    def learn(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        weights = train_shard(rows[["label", "places", "values"]], len(languages), t)
        place, label = np.nonzero(weights)
        return pd.DataFrame({"place": place, "label": label, "weight": weights[place, label]})

    training_rows = features.filter("shard >= 0")
    learned = training_rows.groupBy("shard").applyInPandas(learn, "place long, label long, weight double")
    # a shard without any row has learned nothing and counts for nothing
    used = max(1, sample.filter("shard >= 0").select("shard").distinct().count())
    total_weights = learned.groupBy("place", "label").agg(F.sum("weight").alias("weight")).toPandas()
    model.weights[total_weights.place, total_weights.label] = total_weights.weight / used

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("label", "places", "values")))
            found = [{"label": label, "logits": (np.array(v) @ model.weights[p]).tolist()} for label, p, v in rows]
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema([("label", pa.int32()), ("logits", pa.list_(pa.float64()))]))

    held = map_batches(features.filter("shard < 0"), logits, "label int, logits array<double>").collect()
    if held:
        model.temperature = best_temperature(np.array([r.logits for r in held]), np.array([r.label for r in held]))
    return model


# --- prediction -----------------------------------------------------------------------


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All rows and columns with ``lang_pred`` and its calibrated probability ``score``.

    Whole texts count. Null texts and texts without a letter are ``und`` with score 0, as is
    everything under a model that saw no label. Of languages with equal scores the first in order counts; repeated
    rows are predicted alike; an empty table stays empty. Columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    position = docs.columns.index(text)
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    weights, idf, t = model.weights.astype(np.float32), model.idf, model.training

    def label(body: str | None) -> tuple[str, float]:
        counts = ngram_counts(body, t) if model.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        places, values = tf_idf(counts, idf)
        p = softmax(values @ weights[places] / model.temperature)
        best = int(p.argmax())
        return model.languages[best], float(p[best])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [label(body) for body in batch.column(position).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return map_batches(docs, add, schema)
