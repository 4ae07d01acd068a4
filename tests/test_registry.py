"""Queries of the checks that share what several results are made of, on rows of their own."""

import pytest
from pyspark.sql import functions as F

from checks import registry
from tallywell.operators import compute_all
from tallywell.schemas import TOPICS
from tallywell.scratch import materialize
from tallywell.streaming import stream_dedup

from .conftest import message, optimized, plan, raw


def _topics(spark, monkeypatch):
    """Topics of a few rows of this test, in place of those made of tables."""
    told = {
        "transactions": [message("transactions", transaction_id=f"T{i % 4}", product_id=f"P{i % 3}", client_id=f"C{i % 3}", quantity=i) for i in range(1, 9)],
        "clients": [message("clients", client_id=f"C{i}", segment=None if i else "vip") for i in range(2)],
        "products": [message("products", product_id=f"P{i}", category=None if i else "toys") for i in range(2)],
    }
    monkeypatch.setattr(registry, "feed", lambda spark, sf_dir, topic: raw(spark, *told[topic]))
    return {t: registry.CLEANERS[t](raw(spark, *told[t])) for t in TOPICS}


@pytest.mark.parametrize("what", ["drop", "label"])
def test_kpis_of_one_query_share_stored_rows(spark, monkeypatch, what):
    # each KPI parsed and deduplicated, or at least ranked, all transactions again
    clean = _topics(spark, monkeypatch)
    got = registry.QUERIES[f"kpi_orphans_{what}"](spark, "")
    assert "from_json" not in optimized(got) and "Window" not in optimized(got)
    want = registry._plain(registry._flat(compute_all(*(clean[t] for t in TOPICS), registry.RUN_TS, orphans=what)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stored_kpis_come_from_the_columns_they_read(spark, monkeypatch):
    clean, stored = _topics(spark, monkeypatch), {}

    def noted(df, label):
        stored[label] = df.columns
        return materialize(df, label)

    monkeypatch.setattr(registry, "materialize", noted)
    got = registry.QUERIES["store_kpis"](spark, "")
    want = registry._plain(registry._flat(compute_all(*(clean[t] for t in TOPICS), registry.RUN_TS)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert set(stored["transactions"]) == {"transaction_id", "client_id", "product_id", "quantity", "total_amount"}


def test_rows_as_sent_meet_without_a_join(spark):
    schema = "id string, n int, x double"
    sent = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("a", 2, 0.5), ("b", None, float("nan")), ("c", 1, 1.0)], schema)
    first = spark.createDataFrame([("a", 1, None), ("a", 2, 0.6), ("b", None, float("nan")), ("d", 1, 1.0), ("d", 1, 1.0)], schema)
    got = registry._as_sent(first, sent, "id")
    assert "Join" not in optimized(got) and plan(got).count("Exchange hashpartitioning") == 2
    assert sorted(map(tuple, got.collect())) == [("a", 2, 1), ("b", 1, 1), ("d", 2, 0)]


def test_a_slice_reads_its_own_folder(spark):
    rows = [(f"k{i}", f"v{i}", i % 3 if i % 10 else None) for i in range(300)]
    messages = spark.createDataFrame(rows, "key string, value string, n int").repartition(4)
    staged = registry._staged(messages, F.col("n"), 3, False)
    assert staged.columns == ["key", "value", "n", "slice"]
    for number in range(3):
        part = staged.filter(F.col("slice") == number)
        assert all(f"/slice={number}/" in f.file for f in part.select(F.input_file_name().alias("file")).distinct().collect())
        assert sorted(r.key for r in part.collect()) == sorted(k for k, _, n in rows if n == number)
    source = registry._paced(messages, F.col("n"), 3)
    files = [r.n for r in spark.read.parquet(source.location).groupBy(F.input_file_name()).agg(F.min(F.substring("key", 2, 9).cast("int") % 3).alias("n")).collect()]
    assert len(files) == 3 * int(source.options["maxFilesPerTrigger"]) and len({files.count(n) for n in range(3)}) == 1


def test_a_month_of_ids_is_held_on_disk(spark, tmp_path):
    rows = [(f"T{i % 5}", f"2024-01-0{1 + i % 3}T00:00:00Z") for i in range(15)]
    spark.createDataFrame(rows, "id string, time string").selectExpr("id", "cast(time AS timestamp) AS time").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, time timestamp").parquet(str(tmp_path / "in"))
    folders = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    got = registry._drain(stream_dedup(stream, "id", "time", "30 days"), spark, folders, on_disk=True)
    assert sorted(r.id for r in got.collect()) == [f"T{i}" for i in range(5)]
    state = {f.suffix for f in (tmp_path / "checkpoint/state").rglob("*") if not f.name.startswith(".")}
    assert ".delta" not in state and {".zip", ".changelog"} & state
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
