from datetime import date
from urllib.parse import unquote

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallywell.plans import store_clean, store_kpis
from tallywell.scratch import materialize, scratch_dir
from tallywell.sinks import between_dates, by_date, date_unit, folder_bytes, sink_audit, write_jdbc, write_parquet

from .conftest import TARGET, plan


def sales(spark):
    return spark.sql("""
        SELECT concat('T', id) AS transaction_id, concat('C', id % 3) AS client_id,
          'P' AS product_id, int(id + 1) AS quantity, 1.5D AS unit_price,
          round((id + 1) * 1.5D, 2) AS total_amount, 'USD' AS currency,
          'paypal' AS payment_method, 'completed' AS status,
          timestampadd(DAY, id % 4, timestamp'2024-01-01 05:00:00') AS transaction_time
        FROM range(40)""")


def test_overwrite_is_the_default(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(5), path)
    write_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    write_parquet(spark.range(2), path, mode="append")
    assert spark.read.parquet(path).count() == 5


def test_partitions_prune_and_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = by_date(sales(spark))
    write_parquet(rows, path, partition_by="transaction_date")
    one_day = spark.read.parquet(path).filter("transaction_date = date'2024-01-02'")
    assert "PartitionFilters: [isnotnull(transaction_date" in plan(one_day)
    assert one_day.count() == 10

    again = rows.filter("transaction_date = date'2024-01-02'").limit(4)
    write_parquet(again, path, partition_by="transaction_date", touched_only=True)
    counts = dict(
        spark.read.parquet(path).groupBy("transaction_date").count().collect()
    )
    assert counts == {date(2024, 1, d): 4 if d == 2 else 10 for d in range(1, 5)}
    write_parquet(again, path, partition_by="transaction_date")
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        write_parquet(again, path, touched_only=True)


def test_a_large_partition_value_is_spread_over_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.lit(1).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("noise")
        )
        write_parquet(rows, path, partition_by="day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "day=1").glob("*.parquet"))) > 1


def test_files_are_clustered_and_row_groups_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 120_000, 1, 6).select(
        F.lit(1).alias("day"), F.format_string("C%06d", F.col("id") * 7919 % 120_000).alias("client_id"), F.sha1(F.col("id").cast("string")).alias("noise")
    )
    write_parquet(rows, path, partition_by="day", cluster_by=["client_id"], row_group=256 * 1024)
    for file in (tmp_path / "t" / "day=1").glob("*.parquet"):
        groups = pq.ParquetFile(file).metadata
        found = [groups.row_group(i).column(0).statistics for i in range(groups.num_row_groups)]
        assert len(found) > 4
        # sorted: a value is in one of them, or at the border of two
        assert all(a.max <= b.min for a, b in zip(found, found[1:]))
    one = spark.read.parquet(path).filter("client_id = 'C000042'")
    assert "PushedFilters: [IsNotNull(client_id), EqualTo(client_id,C000042)]" in plan(one) and one.count() == 1
    flat = str(tmp_path / "flat")
    write_parquet(rows, flat, cluster_by=["client_id"])
    assert spark.read.parquet(flat).count() == 120_000


@pytest.mark.parametrize("unit, folders", [("day", 70), ("month", 3), ("year", 1)])
def test_date_units_and_their_readers(spark, tmp_path, unit, folders):
    rows = spark.range(140).selectExpr(
        "id", "timestampadd(HOUR, int(id * 12), timestamp'2024-01-01 00:00:00') AS transaction_time"
    )
    assert date_unit(rows, {"day": 70, "month": 69, "year": 2}[unit] * 1000, 1000) == unit
    path = str(tmp_path / "t")
    (column,) = set(by_date(rows, unit).columns) - set(rows.columns)
    write_parquet(by_date(rows, unit), path, partition_by=column)
    assert len(list((tmp_path / "t").glob(f"{column}=*"))) == folders
    assert folder_bytes(spark, path) > folders * 100
    found = between_dates(spark.read.parquet(path), "2024-01-31", date(2024, 2, 1))
    assert sorted(r.id for r in found.collect()) == [60, 61, 62, 63]
    assert "PartitionFilters: [isnotnull(" in plan(found) and "GreaterThanOrEqual(transaction_time" in plan(found)
    # a table without dated folders is filtered all the same
    assert between_dates(rows, "2024-01-31", "2024-01-31").count() == 2


def test_date_unit_of_large_and_of_empty_tables(spark):
    rows = spark.range(3).selectExpr("raise_error('read') AS transaction_time")
    assert date_unit(rows, 3653, 1) == "day"
    assert date_unit(spark.sql("SELECT timestamp'2024-01-01' AS transaction_time").limit(0), 0) == "day"


def test_jdbc_append(spark, writes):
    write_jdbc(spark.range(2), "things", TARGET)
    (made,) = writes
    assert (made["url"], made["table"]) == (TARGET.url, "things")
    assert made["told"][("append",)] == "append"
    assert "truncate" not in made["told"]
    assert (made["told"]["batchsize"], made["told"]["numPartitions"]) == ("500", "4")
    assert made["properties"] == {
        "user": "me", "password": "secret", "driver": "org.postgresql.Driver",
        "stringtype": "unspecified",
    }


def test_jdbc_overwrite_keeps_the_table(spark, writes):
    write_jdbc(spark.range(2), "things", TARGET, mode="overwrite")
    assert writes[0]["told"]["truncate"] == "true"
    assert ("overwrite",) in writes[0]["told"]


def test_store_clean_fills_both_sinks_alike(spark, tmp_path, writes):
    stored = store_clean({"transactions": sales(spark)}, str(tmp_path), TARGET, dated_lake=True)
    assert (tmp_path / "transactions" / "transaction_date=2024-01-03").is_dir()
    (made,) = writes
    assert made["table"] == "transactions"
    assert made["types"]["total_amount"] == "decimal(12,2)"
    assert "transaction_date" not in made["types"] and "ingested_at" not in made["types"]
    assert {r.transaction_id for r in made["rows"]} == {
        r.transaction_id for r in stored["transactions"].collect()
    }


def test_stored_kpis_label_null_groups_for_the_database_only(spark, tmp_path, writes):
    kpi = spark.sql("""
        SELECT timestamp'2024-01-01' AS window_start, timestamp'2024-01-01' AS window_end,
          country, revenue AS total_revenue, 1L AS order_count, 1L AS unique_clients
        FROM VALUES ('France', 1.005D), (NULL, 2.5D) AS t(country, revenue)""")
    stored = store_kpis({"kpi_revenue_by_country": kpi}, str(tmp_path), TARGET)
    assert {r.country for r in stored["kpi_revenue_by_country"].collect()} == {"France", None}
    got = {r.country: str(r.total_revenue) for r in writes[0]["rows"]}
    assert got == {"France": "1.01", "Unknown": "2.50"}


def test_each_kpi_is_evaluated_once(spark, tmp_path, writes):
    runs = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    kpi = spark.range(1).mapInArrow(noted, "id long").selectExpr(
        "timestamp'2024-01-01' AS window_start", "timestamp'2024-01-01' AS window_end",
        "string(id) AS category", "1D AS total_revenue", "1L AS order_count",
        "1D AS avg_order_value",
    )
    stored = store_kpis({"kpi_revenue_by_category": kpi}, str(tmp_path), TARGET)
    stored["kpi_revenue_by_category"].collect()
    assert runs.value == 1


def test_audit(spark, tmp_path):
    write_parquet(spark.range(10).repartition(3), str(tmp_path / "lake" / "a"))
    write_parquet(spark.range(7).selectExpr("string(id) AS s"), str(tmp_path / "lake" / "b b" / "c=1"))
    write_parquet(spark.range(0), str(tmp_path / "lake" / "none"))
    rows = sink_audit(spark, str(tmp_path / "lake")).collect()
    got = {unquote(r.folder.split("/lake/")[1]): r for r in rows}
    assert {k: r.rows for k, r in got.items()} == {"a": 10, "b b/c=1": 7, "none": 0}
    assert got["a"].files == 3
    assert got["a"].bytes == sum(f.stat().st_size for f in (tmp_path / "lake/a").glob("*.parquet"))


def test_scratch_is_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    copy = materialize(spark.range(4), "numbers")
    assert copy.count() == 4 and "Range" not in plan(copy)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(RuntimeError):
        scratch_dir(Session, "x")
    Session.conf["spark.master"] = "local[4]"
    first = scratch_dir(Session, "x")
    assert first.startswith(Session.conf["spark.checkpoint.dir"])
