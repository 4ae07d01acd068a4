"""Lines that a site repeats on many of its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import SPACES, col, fresh, let

#: entries of the list of repeated lines that are sent to every task at most
BROADCAST_LINES = 200_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _digest(line: Column) -> Column:
    return F.xxhash64(line)


def _wordy(line: Column) -> Column:
    return F.trim(F.translate(line, SPACES, " " * len(SPACES))) != ""


def site_lines(docs: DataFrame, ratio: float, min_pages: int, host: str, text: str) -> DataFrame:
    """``host``, ``lines``: digests of the lines on more than ``ratio`` of the host's pages.

    Copies of a page are one page: they meet by a digest, dropped where they are read
    first. Pages are counted once for each line, before the shuffle where they are. A host
    has at most its mean number of lines a page, divided by ``ratio``, of them.
    """
    distinct = F.array_distinct(F.transform(F.filter(_lines(col(text)), _wordy), _digest))
    copies = docs.select(
        col(host).alias("host"),
        F.xxhash64(col(text)).alias("page"),
        F.octet_length(col(text)).alias("size"),
        F.coalesce(distinct, F.array()).alias("lines"),
    )
    pages = copies.groupBy("host", "page", "size").agg(F.first("lines").alias("lines"))
    # the null entry counts the page itself
    per_page = pages.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "lines")).alias("line"))
    counts = materialize(
        per_page.groupBy("host", "line").agg(F.count("*").alias("pages")).filter(
            F.col("line").isNull() | (F.col("pages") >= min_pages)
        ),
        "site-lines",
    )
    totals = counts.filter(F.col("line").isNull()).select(F.col("host").alias("of"), F.col("pages").alias("total"))
    lines = counts.filter(F.col("line").isNotNull())
    return (
        lines.join(totals, F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("pages") > F.lit(ratio) * F.col("total"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_set("line")).alias("lines"))
    )


def drop_site_lines(
    docs: DataFrame,
    ratio: float = 0.02,
    min_pages: int = 5,
    host: str = "source",
    text: str = "text",
    broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """The columns of ``docs``, boilerplate lines cut from ``text``, and ``lines_dropped``.

    A line goes if it is on at least ``min_pages`` pages of its host and on more than
    ``ratio`` of them. A page counts once for a line however often it has it, and so do
    all copies of a page on its host: copies are no boilerplate, or a page with many would be
    emptied rather than kept once. Lines are compared by a 64-bit digest, exactly as they
    stand; blank lines stay. Null texts stay null, null is a host like any other, and a page
    may end up empty. A column ``lines_dropped`` is replaced.

    The list of lines is sent to every task if its size, which is looked up, is within
    ``broadcast_lines`` digests; otherwise it is joined by host, where a large host is
    split by adaptive execution.
    """
    docs = docs.drop("lines_dropped")
    found = materialize(site_lines(docs, ratio, min_pages, host, text), "boilerplate")
    of, bad, kept = fresh(docs, "of", "bad", "kept")
    found = found.select(F.col("host").alias(of), F.col("lines").alias(bad))
    size = found.agg(F.coalesce(F.sum(F.size(bad) + 1), F.lit(0)).alias("entries")).first().entries
    if size <= broadcast_lines:
        found = F.broadcast(found)
    joined = docs.join(found, col(host).eqNullSafe(col(of)), "left")

    stays = let(
        _lines(col(text)),
        lambda lines: F.filter(lines, lambda x: ~F.array_contains(col(bad), _digest(x)) | ~_wordy(x)),
    )
    lines = F.when(col(bad).isNotNull() & col(text).isNotNull(), stays)
    cut = joined.withColumn(kept, lines)
    columns = [
        F.coalesce(F.array_join(col(kept), "\n"), col(text)).alias(text) if c == text else col(c)
        for c in docs.columns
    ]
    dropped = F.coalesce(F.size(_lines(col(text))) - F.size(col(kept)), F.lit(0))
    return cut.select(*columns, F.when(col(kept).isNull(), F.lit(0)).otherwise(dropped).alias("lines_dropped"))
