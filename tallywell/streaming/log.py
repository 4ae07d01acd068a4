"""What micro-batches wrote: a folder for each, merged into larger ones as they add up.

A batch that is run again after a failure overwrites its own folder, which makes
``foreachBatch``'s at-least-once delivery exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_latest
from ..schemas import TARGETS
from ..sinks.lake import write_parquet

BATCH = "batch_id"
BUCKET = "bucket"
#: buckets of a part at most
_BUCKETS = 1024
_PLACE = T.StructType([T.StructField(c, T.LongType()) for c in ("level", "first", BATCH)])


def kpi_schema(kpi: str) -> T.StructType:
    """The KPI's columns as computed: decimals are doubles, integers are wide."""
    kinds = {"string": T.StringType(), "timestamp": T.TimestampType(), "int": T.LongType()}
    return T.StructType(
        [T.StructField(f.name, kinds.get(f.type, T.DoubleType())) for f in TARGETS[kpi].written]
    )


def _folder(path: str, level: int, first: int, last: int) -> str:
    return f"{path}/level={level}/first={first}/{BATCH}={last}"


def write_batch(
    rows: DataFrame, path: str, batch_id: int, partition_by: str | None = None
) -> DataFrame:
    """Write a batch's rows; returns the stored copy, without the batch number."""
    folder = _folder(path, 0, batch_id, batch_id)
    write_parquet(rows, folder, partition_by=partition_by)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, *_PLACE.fields])).parquet(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches' rows with their batch number, that of the last for merged batches.

    Rows may come twice: what was merged stays until the next merge, for readers that
    have begun with it.
    """
    return _read(spark, path, schema).drop("level", "first")


# --- lookup by key ---------------------------------------------------------------


def _buckets(level: int, every: int) -> int:
    return min(_BUCKETS, every**level)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucketed(rows: DataFrame, key: str, level: int, every: int) -> DataFrame:
    """Rows with the bucket they go to in a part of a level: as many buckets as the part has batches."""
    return rows.withColumn(BUCKET, _bucket(key, _buckets(level, every)))


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame, key: str, last: int, every: int
) -> DataFrame:
    """The distinct rows with one of ``keys``, in a log of parts that are bucketed by ``key``.

    Parts of a single batch are read as a whole, of merged parts the buckets that keys fall in. ``last`` is the
    number of the last batch. The driver sees the numbers of buckets, which are bounded.
    """
    rows = in_buckets(spark, path, schema, keys, key, last, every)
    return rows.join(keys, key, "left_semi").select(*schema.names).distinct()


def in_buckets(
    spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame, key: str, last: int, every: int
) -> DataFrame:
    """All rows of the buckets that ``keys`` fall in, and of no other files."""
    levels = [level for level in range(64) if every**level <= max(last, 1)]
    places = F.array(
        *(F.struct(F.lit(n).alias("level"), _bucket(key, _buckets(n, every)).alias("bucket")) for n in levels)
    )
    wanted: dict[int, list[int]] = {}
    for row in keys.select(F.explode(places).alias("place")).select("place.*").distinct().collect():
        wanted.setdefault(row["level"], []).append(row["bucket"])
    found = F.lit(False)
    for level, buckets in wanted.items():
        found |= (F.col("level") == level) & F.col(BUCKET).isin(buckets)
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return _read(spark, path, whole).filter(found)


# --- merging ------------------------------------------------------------------


def due_merges(batch_id: int, every: int) -> Iterator[tuple[int, int, int]]:
    """``level, first, last`` of the parts to merge before a batch: ``every`` of a level at a time.

    A row is so rewritten once for each level, and a log of n batches has about
    ``every`` folders for each of its levels, which are log n.
    """
    if every < 2:
        raise ValueError("a merge takes two batches at least")
    level, width = 0, every
    while batch_id and batch_id % width == 0:
        yield level, batch_id - width, batch_id - 1
        level, width = level + 1, width * every


def parts_of(
    spark: SparkSession, path: str, schema: T.StructType, merge: tuple[int, int, int]
) -> DataFrame:
    """The rows of the parts a merge takes in, and of no others, with their batch number."""
    level, first, last = merge
    parts = _read(spark, path, schema)
    return parts.filter((F.col("level") == level) & F.col("first").between(first, last)).drop("level", "first")


def write_merged(
    rows: DataFrame, path: str, merge: tuple[int, int, int], partition_by: str | None = None
) -> None:
    """Write what becomes of a merge's parts as one part of the next level."""
    level, first, last = merge
    write_parquet(rows, _folder(path, level + 1, first, last), partition_by=partition_by)


def drop_merged(spark: SparkSession, path: str, merge: tuple[int, int, int], every: int) -> None:
    """Delete the parts that the merge before this one took in, if it is there in full."""
    level, first, last = merge
    width = last - first + 1
    merged = _path(spark, f"{_folder(path, level + 1, first - width, first - 1)}/_SUCCESS")
    files = merged.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if first < width or not files.exists(merged):
        return
    step = width // every
    for start in range(first - width, first, step):
        files.delete(_path(spark, _folder(path, level, start, start + step - 1)), True)


def last_complete(spark: SparkSession, path: str) -> int | None:
    """The number of the last batch that was written in full, of a log that is not merged."""
    found = _complete(spark, path)
    return max(found) if found else None


def _complete(spark: SparkSession, path: str) -> list[int]:
    pattern = _path(spark, f"{path}/level=0/first=*/{BATCH}=*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [int(f.getPath().getParent().getName().split("=")[1]) for f in files.globStatus(pattern) or []]


def drop_before(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete the batches before one, of a log that is not merged."""
    root = _path(spark, path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for old in _complete(spark, path):
        if old < batch_id:
            files.delete(_path(spark, f"{path}/level=0/first={old}"), True)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


# --- result tables of queries in update mode ------------------------------------


def write_updates(path: str):
    """A ``foreachBatch`` function that logs the rows of a query in update mode."""

    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, path, batch_id)

    return write


def latest_updates(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """The last update of each key: the result table of the logged query."""
    return dedup_latest(read_batches(spark, path, schema), keys, [BATCH]).drop(BATCH)
