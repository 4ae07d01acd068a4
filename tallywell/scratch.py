"""Intermediate tables in the folder all executors share.

A written table cuts the lineage like a cache would, but survives lost executors
and is read back with column pruning.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder under ``spark.checkpoint.dir``.

    Only a local master may go without that setting; its one machine has one
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallywell-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def store_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a folder, in place of what it held, and go on from that copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_bucketed(
    df: DataFrame, path: str, key: str, buckets: int, counted: Observation | None = None
) -> DataFrame:
    """Write ``df`` to a folder in ``buckets`` files by ``key``, in place of what it held, and go on from that copy.

    Copies with one number of buckets are joined and grouped on the key without a shuffle. All rows of a key
    share a file: this is for tables of one row, or few, for each key. The session knows the copy
    by a name of its own; to others the files are plain Parquet. ``counted`` gets the number of ``rows`` as they are written.
    """
    rows = df.repartition(buckets, key)
    if counted is not None:
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a scratch folder and go on from that copy."""
    return store_at(df, scratch_dir(df.sparkSession, label))
