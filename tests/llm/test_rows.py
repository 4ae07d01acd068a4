"""Operators that keep rows where they are or deal them out: sharding, quality, lines, mixing."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tallywell.llm import oracle, queries
from tallywell.llm.common import uniform
from tallywell.llm.line_dedup import drop_site_lines
from tallywell.llm.mixing import mix_sources
from tallywell.llm.quality import quality
from tallywell.llm.sharding import assign_shards, shard_slots

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shards(spark, plain, texts, docs, data, empty):
    got = queries.op1_sharding(spark, plain).collect()
    assert {r.doc_id for r in got} == set(texts)
    slots = defaultdict(list)
    for r in got:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 8, zlib.crc32(body), "key")
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = shard_slots(docs, [1.0] * 3).collect()
    assert len(again) == len(data)
    for shard in range(3):
        own = sorted(r.slot for r in again if r.shard == shard)
        assert own == list(range(len(own)))
    assert shard_slots(empty, [1.0]).count() == 0
    with pytest.raises(ValueError):
        assign_shards(docs, [1.0, 0.0])


def test_shards_follow_weights(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = Counter(r.shard for r in assign_shards(ids, [1.0, 1.0, 2.0]).collect())
    assert abs(n[2] / 20_000 - 0.5) < 0.02 and abs(n[0] / n[1] - 1) < 0.1


def quality_by_hand(text):
    w = WORD.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if windows[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_measures(docs, data, empty):
    got = quality(docs).collect()
    assert len(got) == len(data) and "row" in quality(docs).columns
    for r in got:
        want = quality_by_hand(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
        assert r.text is not None or r.clean_text is None
        if r.doc_id is not None and r.doc_id < 24:
            assert r.kept and r.clean_text == r.text
    assert quality(empty).count() == 0


@pytest.mark.parametrize(
    "line, bad",
    [
        ("A plain line of words.", False), ("", False), ("No end to this one", True), ("Ends here. Goes on", False),
        ("home | news | sport | mail.", True), ("All rights reserved.", True), ("Wor%%% of### it*** an$$$.", True),
        ("WHAT IS ALL THIS SHOUTING ABOUT.", True), ("You!! there!! stop!! now!!", True), ("In the U.S.A. it is so.", False),
        ("The new catalog in the hall is open.", False), ("She had to design in haste.", False), ("I assign in class.", False),
        ("He would read more books that year.", False), ("Click here to read more.", True), ("Copyright © 2019 by us.", True),
        ("Licensed under the Apache License.", True), ("We had to sign in before the long and weary meeting began.", False),
        ("Log in.", True), ("DAS WAR EIN GROSSER TAG FÜR ÄLTERE.", True), ("das war ein grosser tag für ältere.", False), ("a | b.", False),
    ],
)
def test_line_rules(spark, line, bad):
    got = quality(spark.createDataFrame([(f"{line}\nAnother line.",)], "text string")).first()
    assert (got.lines_removed == 1) == bad
    assert got.clean_text == ("Another line." if bad else f"{line}\nAnother line.")


def by_query(spark, plain, name):
    """A query's rows and those of its SQL, as counts of tuples, columns in order of name."""
    got = queries.QUERIES[name](spark, plain)
    columns = sorted(got.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{plain}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle.SQL[name]})").fetchall()
    return Counter(tuple(r[c] for c in columns) for r in got.collect()), Counter(want)


@pytest.mark.parametrize("name", ["op5_quality", "op7_line_dedup", "op11_manifest"])
def test_queries_are_their_sql(spark, plain, name):
    got, want = by_query(spark, plain, name)
    assert got == want


def test_documents_that_lose_too_much(spark):
    good, bad = " ".join(f"word{i}" for i in range(60)) + ".", " | ".join(f"menu{i}" for i in range(90))
    rows = [(1, f"{good}\nhome | news | sport | x."), (2, f"{good}\n{bad}")]
    got = {r.doc_id: r.kept for r in quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: True, 2: False}


def test_site_lines(spark, docs, data, empty):
    rows = [(i, f"Menu\nbody {i}\nMenu\n\ncommon", "a" if i < 40 else None) for i in range(60)]
    rows += [(100 + i, f"rare\nown {i}" if i < 4 else f"own {i}", "a") for i in range(60)] + [(200, None, "a"), (201, "Menu", "lone")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for limit in (200_000, 0):
        got = {r.doc_id: (r.text, r.lines_dropped) for r in drop_site_lines(table, 0.2, 5, broadcast_lines=limit).collect()}
        assert got[3] == ("body 3\n", 3) and got[50] == ("body 50\n", 3)
        assert got[101] == ("rare\nown 1", 0) and got[200] == (None, 0) and got[201] == ("Menu", 0)
    # brute force on the mixed table
    different = {(r[3], r[1]) for r in data}
    pages, total = Counter(), Counter(host for host, _ in different)
    for host, body in different:
        pages.update((host, x) for x in set((body or "").split("\n")) if WORD.search(x))
    got = drop_site_lines(docs, 0.2, 2).collect()
    assert len(got) == len(data)
    want = Counter()
    for r in data:
        keep = [x for x in (r[1] or "").split("\n") if pages[r[3], x] < 2 or pages[r[3], x] <= 0.2 * total[r[3]]]
        want[r[0], None if r[1] is None else "\n".join(keep)] += 1
    assert Counter((r.doc_id, r.text) for r in got) == want
    assert drop_site_lines(empty).count() == 0


def test_copies_of_a_page_are_no_boilerplate(spark):
    rows = [(i, "copied\nlines", "a") for i in range(50)] + [(100 + i, f"menu\nown {i}", "a") for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = {r.doc_id: r.text for r in drop_site_lines(table).collect()}
    assert got == {i: "copied\nlines" if i < 100 else f"own {i - 100}" for i in [*range(50), *range(100, 150)]}


def test_mixing_query_is_a_poisson_count_per_document(spark, plain, texts):
    """Rates from the bytes, and each document's count where its uniform number falls."""
    docs = spark.read.parquet(f"{plain}/documents.parquet").withColumn("u", uniform(F.col("doc_id"), F.lit(20), F.lit(0)))
    rows = docs.collect()
    size = Counter()
    for r in rows:
        size[r.source] += len((r.text or "").encode())
    total, weight = sum(size.values()), sum(n**0.7 for n in size.values())
    got = Counter(r.doc_id for r in queries.op6_mixing(spark, plain).collect())
    for r in rows:
        rate = size[r.source] ** 0.7 / weight * total / size[r.source]
        p = below = math.exp(-rate)
        count = 0
        while below <= r.u:
            count += 1
            p *= rate / count
            below += p
        assert got[r.doc_id] == count


def test_rows_without_a_key_are_drawn_by_their_text(spark):
    rows = spark.range(3000).selectExpr("CAST(NULL AS long) AS doc_id", "CONCAT('text ', id) AS text", "'a' AS source")
    copies = Counter(r.text for r in mix_sources(rows).collect())
    assert abs(sum(copies.values()) / 3000 - 1) < 0.1 and abs(len(copies) / 3000 - (1 - math.exp(-1))) < 0.05


def test_mixing(spark, docs, data, empty):
    ids = spark.range(30_000).selectExpr(
        "id AS doc_id", "'0123456789' AS text", "CASE WHEN id < 20000 THEN 'big' WHEN id < 29000 THEN 'mid' END AS source"
    )
    got = mix_sources(ids, {"big": 1, "mid": 1, None: 2}).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in got}
    assert abs(n["big"] / 7500 - 1) < 0.05 and abs(n["mid"] / 7500 - 1) < 0.05 and abs(n[None] / 15000 - 1) < 0.05
    counts = Counter(r["count"] for r in mix_sources(ids, {None: 1}).groupBy("doc_id").count().collect())
    assert 25 < sum(k * v for k, v in counts.items()) / 1000 < 35 and max(counts) > 35
    one = Counter(
        r["count"] for r in mix_sources(ids.filter("doc_id < 20000"), {"big": 1}).groupBy("doc_id").count().collect()
    )
    for k in (1, 2, 3):
        assert abs(one[k] / 20_000 - math.exp(-1) / math.factorial(k)) < 0.015
    mixed = mix_sources(docs)
    assert mixed.columns[: len(docs.columns) - 2] == [c for c in docs.columns if c not in ("copy", "rate")]
    first, second = (sorted((str(r.doc_id), r.copy) for r in mix_sources(d).collect()) for d in (docs, docs.repartition(7)))
    assert first == second
    assert mix_sources(empty).count() == 0
    order = [r.doc_id for r in mix_sources(ids).select("doc_id").limit(1000).collect()]
    assert order != sorted(order)
