"""Documents to packed training sequences, in stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm.common import documents
from tallywell.llm.line_dedup import drop_site_lines
from tallywell.llm.mixing import mix_sources
from tallywell.llm.packing import pack
from tallywell.llm.quality import quality
from tallywell.llm.queries import tokenizer_path
from tallywell.llm.simhash import drop_near_duplicates
from tallywell.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(rows: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """The columns of documents, with another text and its length."""
    made = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return rows.select(*(made[c].alias(c) if c in made else F.col(f"`{c}`") for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bad lines go, and documents that are poor or lose too much of their text."""
    kept = quality(docs).filter("kept")
    return _with_text(kept, F.col("clean_text"), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats on many of its documents go."""
    cut = drop_site_lines(docs)
    return _with_text(cut, F.col("text"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that SimHash links: three-word shingles, at most three bits."""
    return drop_near_duplicates(docs, radius=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in copies that bring their sources to target weights, shuffled."""
    return mix_sources(docs).select(*(F.col(f"`{c}`") for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: SQL cannot express fingerprints and tokens; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each but the last written and read again."""
    docs = documents(spark, sf_dir)
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return last(spark, docs, sf_dir)
