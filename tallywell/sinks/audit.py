from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


def sink_audit(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files, bytes and rows per folder below ``path``, at any depth.

    Files are listed without their content. Row counts come from the footers: a
    schema with no column of the files leaves nothing else to read, and lets folders
    of different schemas be counted together.
    """
    # the same hidden column on both sides, so that paths are spelled alike
    file = F.col("_metadata.file_path").alias("path")
    files = _below(spark.read.format("binaryFile"), path).select(
        file, F.col("_metadata.file_size").alias("length")
    )
    rows = (
        _below(spark.read.format("parquet").schema("no_such_column string"), path)
        .groupBy(file)
        .agg(F.count("*").alias("rows"))
    )
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return (
        files.join(rows, "path", "left")
        .groupBy(folder.alias("folder"))
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        )
    )


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the Parquet files below a folder, which are listed and not read."""
    files = _below(spark.read.format("binaryFile"), path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first().bytes


def _below(reader: DataFrameReader, path: str) -> DataFrame:
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}
    return reader.options(**options).load(path)
