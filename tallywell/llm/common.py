"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialize

#: fixed value: what counts as white space between words, as ASCII characters
SPACES = "\t\n\x0b\x0c\r "


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names ``df`` does not have yet, one like each of ``names``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col(f"`{name}`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once.

    A column used inside a lambda is otherwise computed again for each element, since
    the optimizer merges projections into the lambda.
    """
    return F.transform(F.array(value), body)[0]


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """``mapInArrow``, with this package on the workers' path where it is not installed."""
    root = str(Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    path = environment.get("PYTHONPATH", "").split(":")
    if root not in path:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, path)])
    return df.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], text: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the bytes of column ``text`` pass ``size``; a row stays whole.

    What Python makes of a slice is then small, and gone before the next one.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def uniform(*columns: Column) -> Column:
    """A number strictly between 0 and 1 from a 64-bit hash of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11) + F.lit(0.5)) * F.lit(2.0**-53)


def held_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def number_within(
    df: DataFrame, groups: Sequence[str], name: str, block_rows: int = 20_000, label: str = "rows"
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in no particular order.

    Rows are first written. A group is dealt into blocks by a hash of the whole row and
    of the split it is read from, so that neither a large group nor very many equal
    rows meet in one task; blocks are counted, and rows numbered within theirs.
    """
    stored = materialize(df, label)
    block, base, count = fresh(stored, "block", "base", "count")
    blocks = max(16, -(-stored.count() // block_rows))
    spread = F.xxhash64(*(col(c) for c in stored.columns), F.spark_partition_id())
    dealt = stored.withColumn(block, F.pmod(spread, F.lit(blocks)))
    keys = [*groups, block]
    of = fresh(dealt, *(f"of_{k}" for k in keys))
    before = Window.partitionBy(*of[:-1]).orderBy(of[-1]).rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy(*(col(k).alias(o) for k, o in zip(keys, of)))
        .agg(F.count("*").alias(count))
        .withColumn(base, F.coalesce(F.sum(count).over(before), F.lit(0)))
        .drop(count)
    )
    within = Window.partitionBy(*keys).orderBy(*(col(c) for c in stored.columns))
    same = [col(k).eqNullSafe(col(o)) for k, o in zip(keys, of)]
    joined = dealt.join(bases, same)
    return joined.withColumn(name, F.row_number().over(within) - 1 + F.col(base)).select(
        *stored.columns, name
    )
