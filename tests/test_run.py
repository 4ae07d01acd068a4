import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallywell.__main__ import main
from tallywell.operators import clean_transactions
from tallywell.plans import intake, run, start_stream
from tallywell.schemas import KPI_NAMES, TARGETS, TOPICS
from tallywell.session import recommended_conf
from tallywell.settings import Settings, Source
from tallywell.sinks.lake import rows_of, write_parquet
from tallywell.sources import (
    encode_messages,
    read_messages,
    synth_clients,
    synth_products,
    synth_transactions,
    write_messages,
)
from tallywell.streaming import current_kpi

from .conftest import TARGET, message

BASE = "2024-06-01 12:00:00"


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("topics")
    rows = {
        "transactions": (synth_transactions(spark, 400, 60, 40, BASE), "transaction_id"),
        "clients": (synth_clients(spark, 50, BASE), "client_id"),
        "products": (synth_products(spark, 30), "product_id"),
    }
    found = {t: Source("text", str(root / t)) for t in TOPICS}
    for topic, (df, key) in rows.items():
        write_messages(encode_messages(df, key), found[topic])
    write_messages(
        spark.createDataFrame([(None, "broken")], "key string, value string"),
        found["transactions"],
    )
    return found


def test_batch_run(spark, sources, tmp_path):
    lake = str(tmp_path)
    result = run(spark, Settings(sources, lake, top=7), "2024-06-02T00:00:00Z", run_id="first")
    assert {t: df.count() for t, df in result.clean.items()} == {
        "transactions": 400, "clients": 50, "products": 30,
    }
    assert set(result.kpis) == set(KPI_NAMES)
    assert result.kpis["kpi_top_products"].count() == 7
    stored = sum(df.count() for df in [*result.clean.values(), *result.kpis.values()])
    row = result.summary.first()
    assert (row.run_id, row.status, row.errors) == ("first", "SUCCESS", 0)
    assert (row.records_ingested, row.records_processed, row.records_stored) == (481, 480, stored)
    assert row.start_time <= row.end_time
    assert len(list((tmp_path / "transactions").glob("transaction_date=*"))) >= 7
    samples = result.samples(3)
    assert samples["kpi_top_products"].count() == 3
    assert {name: df.columns for name, df in samples.items()} == {
        "kpi_revenue_by_category": ["category", "total_revenue", "order_count", "avg_order_value"],
        "kpi_top_products": ["product_name", "units_sold", "total_revenue"],
        "kpi_customer_segments": ["segment", "total_revenue", "order_count", "unique_clients", "avg_spend"],
    }

    # few bytes make few folders; dimensions and totals in buckets change no row
    small = Settings(sources, f"{lake}/small", top=7, date_unit=None, cluster_by=("client_id",), buckets=3)
    again = run(spark, small, "2024-06-02T00:00:00Z")
    assert list((tmp_path / "small" / "transactions").glob("transaction_year=*"))
    assert {n: sorted(df.collect(), key=str) for n, df in again.kpis.items()} == {n: sorted(df.collect(), key=str) for n, df in result.kpis.items()}

    # a second run replaces the tables and adds to the log
    run(spark, Settings(sources, lake, by_date=False), run_id="second")
    assert spark.read.parquet(f"{lake}/transactions").count() == 400
    log = spark.read.parquet(f"{lake}/pipeline_runs")
    assert {r.run_id for r in log.collect()} == {"first", "second"}


def test_rows_are_counted_as_they_are_written(spark, sources, tmp_path, monkeypatch):
    def second_look(self):
        raise AssertionError("a table is read again to be counted")

    monkeypatch.setattr(type(spark.range(1)), "count", second_look)
    result = run(spark, Settings(sources, str(tmp_path), by_date=False))
    monkeypatch.undo()
    row = result.summary.first()
    stored = sum(df.count() for df in [*result.clean.values(), *result.kpis.values()])
    assert (row.records_ingested, row.records_processed, row.records_stored) == (481, 480, stored)


@pytest.mark.parametrize("partition_by", [None, "part"])
def test_rows_of_tables_with_few_rows(spark, tmp_path, partition_by):
    for n in (0, 3):
        counted = Observation()
        rows = spark.range(10).filter(F.col("id") < n).withColumn("part", F.col("id") % 2)
        write_parquet(rows, str(tmp_path / str(n)), partition_by=partition_by, counted=counted)
        assert rows_of(counted) == n
    counted = Observation()
    write_parquet(spark.createDataFrame([], "id long, part long"), str(tmp_path / "none"), partition_by=partition_by, counted=counted)
    assert rows_of(counted) == 0


RETRIED = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import Observation
from checks.session import local_session
from tallywell.sinks.lake import rows_of, write_parquet

spark = local_session("2,3", 2)

def fails_at_first(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(0, 1000, 1, 4).mapInArrow(fails_at_first, "id long")
for name, by in (("flat", None), ("dealt", "part")):
    counted = Observation()
    table = rows.withColumn("part", rows.id % 3)
    write_parquet(table, f"{sys.argv[2]}/{name}", partition_by=by, counted=counted)
    print("COUNTED", rows_of(counted), spark.read.parquet(f"{sys.argv[2]}/{name}").count())
"""


def test_tasks_that_are_tried_again_count_once(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", RETRIED, root, str(tmp_path)], capture_output=True, text=True, timeout=240)
    assert done.stdout.count("COUNTED 1000 1000") == 2, done.stderr[-2000:]


def test_runs_over_a_growing_topic_equal_one_run(spark, tmp_path, monkeypatch):
    sources = {t: Source("text", str(tmp_path / t)) for t in TOPICS}
    settings = Settings(sources, str(tmp_path / "lake"), top=5, incremental=True, by_date=False)
    for t in TOPICS:
        (tmp_path / t).mkdir()

    def publish(number, **messages):
        for t, values in messages.items():
            (tmp_path / "staged").write_text("".join(v + "\n" for v in values))
            (tmp_path / "staged").rename(tmp_path / t / f"{number}.txt")

    def same(result):
        whole = run(spark, Settings(sources, str(tmp_path / "whole"), top=5, by_date=False), "2024-06-02T00:00:00Z")
        for name in TOPICS:
            assert sorted(result.clean[name].collect(), key=str) == sorted(whole.clean[name].collect(), key=str)
        for name in KPI_NAMES:
            assert sorted(result.kpis[name].collect(), key=str) == sorted(whole.kpis[name].collect(), key=str)

    def again():
        result = run(spark, settings, "2024-06-02T00:00:00Z")
        row = result.summary.first()
        return result, (row.records_ingested, row.records_processed)

    sale = lambda id, **changes: message("transactions", transaction_id=id, **changes)
    publish(1, transactions=[sale("a"), sale("b"), "broken"], clients=[message("clients")], products=[message("products")])
    result, counts = again()
    assert counts == (5, 4)
    # later copies, an older one, a dimension that changes
    publish(2, transactions=[sale("a", quantity=9, transaction_time="2024-02-01T00:00:00Z"), sale("b", quantity=8, transaction_time="2023-02-01T00:00:00Z"), sale("c", product_id="new")])
    publish(3, products=[message("products", product_id="new"), message("products", name="Zebra")])
    result, counts = again()
    assert counts == (5, 6)
    same(result)
    # nothing new
    result, counts = again()
    assert counts == (0, 6)
    same(result)
    # a run that fails before its version is there takes the messages in again
    publish(4, transactions=[sale("d")])
    with monkeypatch.context() as broken:
        broken.setattr(intake, "write_batch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            again()
    result, counts = again()
    assert counts == (1, 7)
    same(result)
    versions = tmp_path / "lake" / "_versions" / "transactions" / "level=0"
    assert len(list(versions.iterdir())) == 2


def test_all_target_tables_are_filled(spark, sources, tmp_path, writes):
    run(spark, Settings(sources, str(tmp_path), jdbc=TARGET, by_date=False))
    modes = {w["table"]: "overwrite" if ("overwrite",) in w["told"] else "append" for w in writes}
    assert modes == {t: "append" if t == "pipeline_runs" else "overwrite" for t in TARGETS}
    for written in writes:
        assert list(written["types"]) == [f.name for f in TARGETS[written["table"]].written]
    (category,) = (w for w in writes if w["table"] == "kpi_revenue_by_category")
    assert "Unknown" in {r.category for r in category["rows"]}


def test_failed_run_is_logged(spark, sources, tmp_path):
    missing = {**sources, "products": Source("text", str(tmp_path / "nowhere"))}
    with pytest.raises(Exception, match="nowhere"):
        run(spark, Settings(missing, str(tmp_path)), run_id="bad")
    (row,) = spark.read.parquet(f"{tmp_path}/pipeline_runs").collect()
    assert (row.run_id, row.status, row.errors) == ("bad", "FAILED", 1)
    assert row.notes


def test_streaming_run_equals_batch(spark, sources, tmp_path, writes, statements):
    settings = Settings(sources, str(tmp_path / "stream"), jdbc=TARGET, window="1 day")
    start_stream(spark, settings, until_empty=True).awaitTermination()
    txn = clean_transactions(read_messages(spark, sources["transactions"]))
    want = txn.groupBy(F.to_date("transaction_time").alias("day")).count()
    got = current_kpi(spark, settings.lake, "kpi_revenue_by_country")
    got = got.groupBy(F.to_date("window_start").alias("day")).agg(F.sum("order_count"))
    assert dict(map(tuple, got.collect())) == dict(map(tuple, want.collect()))
    assert (tmp_path / "stream" / "products").is_dir()
    assert {t for t in TARGETS if t in {w["table"] for w in writes}} == {"clients", "products"}
    assert {s[1].split()[2] for s in statements} == {"transactions", *KPI_NAMES}


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.delenv("POSTGRES_PASSWORD", raising=False)
    places = ["--topics", str(tmp_path / "topics"), "--lake", str(tmp_path / "lake")]
    main(["--mode", "demo", "--transactions", "80", "--clients", "9", "--products", "7", *places])
    assert "SUCCESS" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "lake" / "transactions")).count() == 80
    main(["--mode", "stream", "--until-empty", *places])
    sold = current_kpi(spark, str(tmp_path / "lake"), "kpi_revenue_by_category")
    assert sold.agg(F.sum("order_count")).first()[0] == 80


def test_partitions_grow_with_the_input():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert recommended_conf(10**6)[key] == "200"
    assert int(recommended_conf(100 * 10**12)[key]) > 300_000


def test_rows_are_stored_before_their_dates_are_looked_at(spark, tmp_path):
    from importlib import import_module

    from tallywell.schemas import TOPICS

    sources = {t: Source("parquet", str(tmp_path / t)) for t in TOPICS}
    rows = spark.range(4).selectExpr("id", "timestamp_seconds(id * 86400) AS transaction_time")
    rows.write.parquet(sources["transactions"].location)
    lake = tmp_path / "lake"
    settings = Settings(sources, str(lake), date_unit=None)
    unit, kept = import_module("tallywell.plans.run")._unit(spark, settings, rows)
    assert unit == "year" and sorted(r.id for r in kept.collect()) == [0, 1, 2, 3]
    assert all(str(lake / "_clean") in f for f in kept.inputFiles())
