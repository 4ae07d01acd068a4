"""Counts and data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TARGETS
from ..sources.codec import checked_messages, decode_messages
from .clean import ENTITIES, is_valid
from .conform import fit


def stage_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Messages read and rows left after cleaning, per topic.

    Cleaning leaves one row per valid id, so both counts come from one pass over
    the messages and only ids are shuffled.
    """
    counts = []
    for topic, messages in raw.items():
        entity = ENTITIES[topic]
        kept = F.when(is_valid(topic), F.col(entity.key))
        counts.append(
            decode_messages(messages, entity.schema)
            .agg(F.count("*").alias("raw_rows"), F.count_distinct(kept).alias("clean_rows"))
            .select(F.lit(topic).alias("entity"), "raw_rows", "clean_rows")
        )
    return reduce(DataFrame.unionByName, counts)


def reject_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per topic: messages read, kept and rejected as a whole, and fields rejected for their type.

    ``entity``, ``field`` (null but for fields), ``reason`` and ``row_count``. Reasons are ``read``, ``kept``, and those of
    :func:`~tallywell.sources.codec.checked_messages`; kept and rejected messages together are those read. One
    pass over the messages, summed where they are read.
    """
    counts = []
    for topic, messages in raw.items():
        checked = checked_messages(messages, ENTITIES[topic].schema)
        none = F.lit(None).cast("string")
        notes = F.array(
            F.struct(none.alias("field"), F.lit("read").alias("reason")),
            F.when(F.col("row").isNotNull(), F.struct(none.alias("field"), F.lit("kept").alias("reason"))),
        )
        wrong = F.transform("rejects", lambda r: F.struct(r["field"].alias("field"), r["reason"].alias("reason")))
        noted = checked.select(F.inline(F.concat(F.array_compact(notes), wrong)))
        counts.append(
            noted.groupBy("field", "reason")
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(topic).alias("entity"), "field", "reason", "row_count")
        )
    return reduce(DataFrame.unionByName, counts)


def target_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows that break each rule of a target table; rules nobody breaks are left out.

    ``null`` a required value is missing; ``type`` a value does not fit the column's
    type; ``length`` a text is too long; ``duplicate_key`` rows beyond the first of
    their primary key (named by its columns).
    """
    target = TARGETS[table]
    rules = []
    for field in target.written:
        value = F.col(field.name)
        if field.required:
            rules.append((field.name, "null", value.isNull()))
        if field.type != "string":
            unfit = value.isNotNull() & fit(field.name, field.type).isNull()
            rules.append((field.name, "type", unfit))
        if field.max_chars:
            rules.append((field.name, "length", F.char_length(value) > field.max_chars))

    # rows of a key first, so that rules and repeated keys come from one look at the rows
    names = [f"rule {i}" for i in range(len(rules))]
    per_key = df.groupBy(*target.key).agg(
        *(F.count_if(test).alias(n) for n, (_, _, test) in zip(names, rules)), F.count("*").alias("rows")
    )
    keyed = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in target.key))
    sums = per_key.agg(
        *(F.sum(n).alias(n) for n in names), F.sum(F.when(keyed, F.col("rows") - 1)).alias("repeats")
    )
    labels = [*((c, r, n) for n, (c, r, _) in zip(names, rules)), (",".join(target.key), "duplicate_key", "repeats")]
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(n).alias("row_count"))
        for c, r, n in labels
    ]
    return (
        sums.select(F.inline(F.array(*entries)))
        .filter(F.col("row_count") > 0)
        .select(F.lit(table).alias("table_name"), "column", "rule", "row_count")
    )


def orphan_keys(transactions: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys that transactions use and the dimension lacks, with their number of rows.

    Counted per key before the join, so a key used by many rows joins only once.
    """
    used = transactions.groupBy(key).agg(F.count("*").alias("row_count"))
    return used.join(dimension.select(key), key, "left_anti")
