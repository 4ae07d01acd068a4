import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tallywell.operators import ENTITIES, clean_transactions, windowed_kpi
from tallywell.schemas import KPI_NAMES
from tallywell.settings import Source
from tallywell.sources import read_messages
from tallywell.streaming import log, sinks
from tallywell.streaming import (
    closed_top_products,
    current_kpi,
    current_transactions,
    latest_updates,
    read_batches,
    stream_clean,
    stream_dedup,
    stream_latest,
    stream_to_sinks,
    stream_top_products,
    stream_windowed_revenue,
    write_updates,
)

from .conftest import TARGET, message, plan


class Topic:
    """A text topic that files are published to one by one."""

    def __init__(self, root, **options):
        self.folder, self.staged, self.files = root / "topic", root / "staged", 0
        self.start = time.time() - 3600
        self.folder.mkdir()
        self.source = Source("text", str(self.folder), options=options)

    def publish(self, *values):
        self.staged.write_text("".join(v + "\n" for v in values))
        # files are taken by their times, and those of two written within a tick are equal
        os.utime(self.staged, (self.start + self.files,) * 2)
        self.staged.rename(self.folder / f"{self.files:04}.txt")
        self.files += 1


def sale(id, product, time, amount, client="C1", quantity=1):
    return message(
        "transactions", transaction_id=id, product_id=product, client_id=client,
        quantity=quantity, unit_price=amount, transaction_time=f"2024-01-01T{time}:00Z",
    )


@pytest.fixture(scope="module")
def dimensions(spark):
    products = spark.createDataFrame(
        [("P1", "Brick", "Toys"), ("P2", "Novel", "Books")], "product_id string, name string, category string"
    )
    clients = spark.createDataFrame(
        [("C1", "France", "Vip"), ("C2", "Spain", "Budget")],
        "client_id string, country string, segment string",
    )
    return clients, products


def test_late_rows_behind_the_watermark_are_dropped(spark, tmp_path, dimensions):
    topic = Topic(tmp_path)
    out, dropped = str(tmp_path / "out"), 0
    batches = [
        [sale("a", "P1", "00:10", 1.0), sale("a", "P1", "00:10", 1.0), sale("b", "ZZ", "05:00", 2.0)],
        [sale("c", "P1", "04:30", 4.0)],
        [sale("d", "P1", "00:20", 8.0), sale("e", "P1", "05:10", 16.0)],
        # closes all windows but its own
        [sale("f", "P1", "09:00", 32.0)],
    ]
    for values in batches:
        topic.publish(*values)
        rows = stream_clean(spark, topic.source, "transactions")
        rows = stream_dedup(rows, "transaction_id", "transaction_time", "1 hour")
        groups = stream_windowed_revenue("kpi_revenue_by_category", rows, dimensions[1], "1 hour")
        query = (
            groups.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        for progress in query.recentProgress:
            dropped += sum(o["numRowsDroppedByWatermark"] for o in progress["stateOperators"])
    final = spark.read.parquet(out).withColumn("hour", F.hour("window_start"))
    got = sorted((r.hour, str(r.category), r.total_revenue, r.order_count) for r in final.collect())
    assert got == [(0, "Toys", 1.0, 1), (4, "Toys", 4.0, 1), (5, "None", 2.0, 1), (5, "Toys", 16.0, 1)]
    assert dropped == 1


@pytest.mark.parametrize(
    ("kpi", "measures"),
    [
        ("kpi_revenue_by_country", {("France", 3.0, 2, 1), ("Spain", 4.0, 1, 1)}),
        ("kpi_customer_segments", {("Vip", 3.0, 2, 1, 1.5), ("Budget", 4.0, 1, 1, 4.0)}),
    ],
)
def test_client_kpis_in_state(spark, tmp_path, dimensions, kpi, measures):
    topic = Topic(tmp_path)
    topic.publish(
        sale("a", "P1", "00:10", 1.0), sale("b", "P1", "00:20", 2.0), sale("c", "P1", "00:30", 4.0, "C2"),
        sale("open", "P1", "05:00", 8.0),
    )
    rows = stream_clean(spark, topic.source, "transactions")
    groups = stream_windowed_revenue(kpi, rows, dimensions[0], "1 hour", delay="1 hour")
    (
        groups.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(tuple(r)[2:] for r in got.collect()) == sorted(measures)
    with pytest.raises(ValueError):
        stream_windowed_revenue("kpi_top_products", rows, dimensions[1])


def test_updates_are_read_by_their_last_batch(spark, tmp_path):
    topic, updates = Topic(tmp_path), str(tmp_path / "updates")
    for sales in ([sale("a", "P1", "00:10", 1.0), sale("b", "P2", "00:20", 2.0)], [sale("c", "P1", "00:30", 4.0)]):
        topic.publish(*sales)
        rows = stream_clean(spark, topic.source, "transactions")
        counts = rows.groupBy("product_id").count()
        (
            counts.writeStream.outputMode("update")
            .foreachBatch(write_updates(updates))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    final = latest_updates(spark, updates, counts.schema, ["product_id"])
    assert sorted(map(tuple, final.collect())) == [("P1", 2), ("P2", 1)]


def test_paced_stream_equals_batch(spark, tmp_path):
    topic = Topic(tmp_path, maxFilesPerTrigger="1")
    for i in range(4):
        topic.publish(sale(f"t{i}", "P1", f"0{i}:00", 1.0), "broken")
    query = (
        stream_clean(spark, topic.source, "transactions")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.transaction_id for r in got.collect()) == ["t0", "t1", "t2", "t3"]


def drain(spark, topic, dimensions, root, **options):
    rows = stream_clean(spark, topic.source, "transactions")
    stream_to_sinks(
        rows, *dimensions, str(root / "lake"), str(root / "checkpoint"), **{"width": "1 hour", **options}
    ).awaitTermination()
    return rows.schema


def assert_equals_batch(spark, topic, dimensions, root, schema):
    lake = str(root / "lake")
    clean = clean_transactions(read_messages(spark, topic.source))
    current = current_transactions(spark, lake, schema)
    assert sorted(current.collect(), key=str) == sorted(clean.collect(), key=str)
    for kpi in KPI_NAMES:
        dimension = dimensions[1] if kpi in ("kpi_revenue_by_category", "kpi_top_products") else dimensions[0]
        want = windowed_kpi(kpi, clean, dimension, "1 hour")
        got = current_kpi(spark, lake, kpi).select(*want.columns)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), kpi


@pytest.mark.parametrize("horizon", [None, "12 hours"])
def test_batches_to_sinks_equal_batch(spark, tmp_path, dimensions, horizon):
    topic = Topic(tmp_path)
    topic.publish(
        sale("a", "P1", "00:10", 1.0),
        sale("b", "P2", "00:20", 2.0, "C2", 3),
        sale("lone", "P1", "03:00", 5.0),
        "broken",
    )
    schema = drain(spark, topic, dimensions, tmp_path, horizon=horizon)
    assert_equals_batch(spark, topic, dimensions, tmp_path, schema)
    # later copies move one row out of a shared window, and empty another window
    topic.publish(
        sale("b", "P2", "07:00", 2.0, "C1"), sale("lone", "P1", "08:00", 5.0), sale("c", "ZZ", "07:30", 1.0, "C9")
    )
    drain(spark, topic, dimensions, tmp_path, horizon=horizon)
    assert_equals_batch(spark, topic, dimensions, tmp_path, schema)
    hours = current_kpi(spark, str(tmp_path / "lake"), "kpi_top_products").select(F.hour("window_start"))
    assert {r[0] for r in hours.collect()} == {0, 7, 8}
    # an older copy changes nothing
    topic.publish(sale("b", "P2", "00:25", 9.0))
    drain(spark, topic, dimensions, tmp_path, horizon=horizon)
    assert_equals_batch(spark, topic, dimensions, tmp_path, schema)


def test_a_horizon_below_the_window(spark, tmp_path, dimensions):
    """Rows of a touched window count wherever in the window they are."""
    topic = Topic(tmp_path)
    topic.publish(sale("a", "P1", "01:00", 1.0))
    drain(spark, topic, dimensions, tmp_path, horizon="1 hour", width="1 day")
    topic.publish(sale("b", "P1", "23:00", 2.0))
    drain(spark, topic, dimensions, tmp_path, horizon="1 hour", width="1 day")
    kpi = current_kpi(spark, str(tmp_path / "lake"), "kpi_revenue_by_category")
    assert [(r.total_revenue, r.order_count) for r in kpi.collect()] == [(3.0, 2)]


def test_windows_stay_while_a_batch_works(spark, tmp_path, dimensions, monkeypatch):
    topic = Topic(tmp_path)
    topic.publish(sale("a", "P1", "00:10", 1.0))
    drain(spark, topic, dimensions, tmp_path)
    seen, write = [], sinks.write_batch

    def watched(*args):
        stored = write(*args)
        seen.append(current_kpi(spark, str(tmp_path / "lake"), "kpi_revenue_by_category").count())
        return stored

    monkeypatch.setattr(sinks, "write_batch", watched)
    topic.publish(sale("b", "P1", "00:20", 2.0))
    drain(spark, topic, dimensions, tmp_path)
    assert len(seen) == 8 and set(seen) == {1}


def test_batches_are_merged(spark, tmp_path, dimensions):
    """Two by two, on two levels, rows that move between windows and a failed merge included."""
    topic, log = Topic(tmp_path), tmp_path / "lake" / "transactions_log"
    for i in range(7):
        topic.publish(sale("moves", "P1", f"{i:02}:10", 1.0), sale(f"t{i}", "P2", "00:20", 2.0, "C2"))
        schema = drain(spark, topic, dimensions, tmp_path, merge_every=2)
        if i == 4:
            # as if the batch that merged had failed after merging
            commits = tmp_path / "checkpoint" / "commits"
            for name in ("4", ".4.crc"):
                (commits / name).unlink()
    assert_equals_batch(spark, topic, dimensions, tmp_path, schema)
    parts = {tuple(int(x.split("=")[1]) for x in p.relative_to(log).parts) for p in log.glob("*/*/*")}
    # what the last merge took in is still there
    assert parts == {(0, 4, 4), (0, 5, 5), (0, 6, 6), (1, 0, 1), (1, 2, 3), (1, 4, 5), (2, 0, 3)}


def on(day, id, time="00:10", amount=1.0, product="P1"):
    return message(
        "transactions", transaction_id=id, product_id=product, client_id="C1",
        quantity=1, unit_price=amount, transaction_time=f"2024-{day}T{time}:00Z",
    )


def test_copies_far_apart_are_found_by_the_index(spark, tmp_path, dimensions, monkeypatch):
    """Any order of copies, merged two by two; a batch lists the dates of its own ids and windows only."""
    topic, listed, dates = Topic(tmp_path), [], sinks.on_dates

    def noted(log, found):
        listed.append({r[0].strftime("%m-%d") for r in found.select(sinks.DATE).distinct().collect()})
        return dates(log, found)

    monkeypatch.setattr(sinks, "on_dates", noted)
    batches = [
        [on("01-05", "a"), on("01-05", "b", "00:20"), on("03-01", "c")],
        # a leaves its first window
        [on("02-10", "a"), on("01-05", "d", "00:30")],
        # an older copy, on a date of its own
        [on("01-20", "a", amount=3.0)],
        # touches windows that a has left, and b in one of them
        [on("01-05", "b", "00:25"), on("01-20", "h")],
        [on("03-01", "c", "00:15"), on("03-01", "c", "00:15")],
    ]
    for number, values in enumerate(batches):
        topic.publish(*values)
        listed.clear()
        schema = drain(spark, topic, dimensions, tmp_path, merge_every=2)
        if number > 1:
            assert_equals_batch(spark, topic, dimensions, tmp_path, schema)
    # the dates of c, then a day more on both sides of its window
    assert listed == [{"03-01"}, {"02-29", "03-01", "03-02"}]


def test_only_rows_of_ids_on_several_dates_are_kept_twice(spark, tmp_path, dimensions, monkeypatch):
    topic, copies, stored = Topic(tmp_path), [], {}
    moved, store = sinks.moved_rows, sinks.store_at

    def noted(rows, dates):
        copies.append(sorted(r.transaction_id for r in rows.collect()))
        return moved(rows, dates)

    def stored_at(df, path):
        stored[path.rsplit("/", 1)[1]] = df.columns
        return store(df, path)

    monkeypatch.setattr(sinks, "moved_rows", noted)
    monkeypatch.setattr(sinks, "store_at", stored_at)
    for values in ([on("01-05", "a"), on("01-05", "b"), on("03-01", "c")], [on("02-10", "a"), on("01-05", "b", "00:20")]):
        topic.publish(*values)
        schema = drain(spark, topic, dimensions, tmp_path)
    assert_equals_batch(spark, topic, dimensions, tmp_path, schema)
    assert copies == [[], ["a", "a"]]
    assert {name for name, columns in stored.items() if "total_amount" in columns} == {"_windows"}


def test_few_files_of_a_long_index_are_read(spark, tmp_path):
    ids = spark.range(6400).select(F.format_string("id%d", "id").alias("transaction_id"), F.lit("2024-01-01").cast("date").alias("transaction_date"))
    path, schema, every = str(tmp_path / "index"), ids.schema, 8
    # 64 batches merged twice, eight merged once, and two batches
    log.write_merged(log.bucketed(ids, "transaction_id", 2, every), path, (1, 0, 63), log.BUCKET)
    log.write_merged(log.bucketed(ids, "transaction_id", 1, every), path, (0, 64, 71), log.BUCKET)
    for batch in (72, 73):
        log.write_batch(log.bucketed(ids.limit(10).coalesce(1), "transaction_id", 0, every), path, batch, log.BUCKET)
    files = spark.read.schema(schema).parquet(path).select(F.input_file_name()).distinct().count()
    some = ids.filter("transaction_id IN ('id7', 'id4000')").union(ids.limit(1).select(F.lit("none"), "transaction_date"))
    read = log.in_buckets(spark, path, schema, some, "transaction_id", 73, every)
    assert files >= 64 + 8 + 2 and read.select(F.input_file_name()).distinct().count() <= 3 + 3 + 2
    found = log.read_buckets(spark, path, schema, some, "transaction_id", 73, every)
    assert sorted(r.transaction_id for r in found.collect()) == ["id4000", "id7"]


def test_top_products_as_windows_close(spark, tmp_path, dimensions):
    topic, out, checkpoint = Topic(tmp_path, maxFilesPerTrigger="1"), str(tmp_path / "out"), tmp_path / "checkpoint"
    topic.publish(sale("late", "P2", "00:30", 1.0, quantity=9), sale("b", "P2", "03:00", 2.0))
    # late rows are judged by the watermark of the batch before, so the next batch's still count, and not the last one's
    topic.publish(*(sale(f"a{i}", f"Q{i}", "00:10", 1.0, quantity=i % 3) for i in range(9)), sale("n", "P1", "00:20", 5.0, quantity=2))
    topic.publish(sale("lost", "P1", "00:40", 1.0, quantity=9), sale("c", "P1", "07:00", 2.0))

    def run():
        rows = stream_clean(spark, topic.source, "transactions")
        stream_top_products(rows, dimensions[1], out, str(checkpoint), "1 hour", 4, delay="1 hour").awaitTermination()
        got = closed_top_products(spark, out).withColumn("hour", F.hour("window_start"))
        return sorted((r.hour, -r.units_sold, r.product_id, r.product_name, r.total_revenue) for r in got.collect())

    want = [(0, -9, "P2", "Novel", 9.0), (0, -2, "P1", "Brick", 10.0), (0, -2, "Q2", None, 2.0), (0, -2, "Q5", None, 2.0), (3, -1, "P2", "Novel", 2.0)]
    assert run() == want
    # a batch that failed at its end comes again
    last = max(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (checkpoint / "commits" / name).unlink()
    topic.publish(sale("d", "P1", "20:00", 2.0))
    assert run() == [*want, (7, -1, "P1", "Brick", 2.0)]


def test_the_latest_copy_wins_in_state(spark, tmp_path):
    topic = Topic(tmp_path, maxFilesPerTrigger="1")
    topic.publish(sale("a", "P1", "05:00", 1.0), sale("b", "P1", "05:00", 1.0), sale("b", "P2", "05:00", 1.0))
    topic.publish(sale("a", "P1", "03:00", 2.0), sale("b", "P1", "04:00", 9.0), sale("c", None, "01:00", 1.0), sale("c", "P1", "01:00", 1.0))
    topic.publish(sale("a", "P2", "07:00", 3.0), "broken")
    rows, entity = stream_clean(spark, topic.source, "transactions"), ENTITIES["transactions"]
    updates = str(tmp_path / "updates")
    query = (
        stream_latest(rows, entity.key, entity.order_by)
        .writeStream.outputMode("update")
        .foreachBatch(write_updates(updates))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    final = latest_updates(spark, updates, rows.schema, [entity.key])
    clean = clean_transactions(read_messages(spark, topic.source))
    assert sorted(final.collect(), key=str) == sorted(clean.collect(), key=str) and final.columns == clean.columns


def test_only_near_dates_are_read(spark, tmp_path):
    rows = spark.sql(
        "SELECT id, timestampadd(DAY, id, timestamp'2024-01-01') AS transaction_time, "
        "dateadd(DAY, id, date'2024-01-01') AS transaction_date FROM range(40) AS t(id)"
    )
    rows.write.partitionBy("transaction_date").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    read = sinks.near(log, rows.filter("id IN (5, 30)"), "6 hours", "1 day")
    partition_filters = plan(read).split("PartitionFilters: [")[1].split("]")[0]
    assert "transaction_date" in partition_filters
    found = {r.id for r in read.collect()}
    assert {3, 4, 5, 6, 7, 28, 29, 30, 31, 32} <= found and found.isdisjoint(range(12, 24))


def test_the_database_gets_what_a_batch_changed(spark, tmp_path, dimensions, writes, statements):
    topic = Topic(tmp_path)
    topic.publish(sale("a", "P1", "00:10", 1.0), sale("b", "P2", "05:20", 2.0))
    drain(spark, topic, dimensions, tmp_path, jdbc=TARGET)
    writes.clear(), statements.clear()
    # one id moves, the older copy of the other does not
    topic.publish(sale("a", "P1", "03:10", 4.0), sale("b", "P2", "05:10", 8.0))
    drain(spark, topic, dimensions, tmp_path, jdbc=TARGET)
    rows = {w["table"]: w["rows"] for w in writes}
    assert sorted((r.transaction_id, float(r.unit_price)) for r in rows["transactions_stage"]) == [("a", 4.0), ("b", 2.0)]
    for kpi in KPI_NAMES:
        assert sorted(r.window_start.hour for r in rows[f"{kpi}_stale"]) == [0, 3, 5]
        assert sorted(r.window_start.hour for r in rows[f"{kpi}_stage"]) == [3, 5]
    assert all(("overwrite",) in w["told"] and w["told"]["truncate"] == "true" for w in writes)
    assert {s[0].split()[2] for s in statements} == {"transactions", *KPI_NAMES} and len(statements) == 5
    delete, insert = statements[0]
    assert delete == (
        "DELETE FROM transactions WHERE EXISTS (SELECT 1 FROM transactions_stage "
        "WHERE transactions_stage.transaction_id = transactions.transaction_id)"
    )
    assert insert.startswith("INSERT INTO transactions (transaction_id, ") and insert.endswith(" FROM transactions_stage")


def test_a_triggered_query_starts_and_stops(spark, tmp_path, dimensions):
    topic = Topic(tmp_path)
    topic.publish(sale("a", "P1", "00:10", 1.0))
    rows = stream_clean(spark, topic.source, "transactions")
    query = stream_to_sinks(
        rows, *dimensions, str(tmp_path / "lake"), str(tmp_path / "checkpoint"), trigger="1 second"
    )
    query.processAllAvailable()
    topic.publish(sale("b", "P1", "00:20", 2.0))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
    kpi = current_kpi(spark, str(tmp_path / "lake"), "kpi_revenue_by_category")
    assert [(r.total_revenue, r.order_count) for r in kpi.collect()] == [(3.0, 2)]


def test_a_batch_run_again_changes_nothing(spark, tmp_path, dimensions):
    topic = Topic(tmp_path)
    topic.publish(sale("a", "P1", "00:10", 1.0))
    drain(spark, topic, dimensions, tmp_path)
    topic.publish(sale("b", "P1", "00:20", 2.0))
    schema = drain(spark, topic, dimensions, tmp_path)
    # forget that the last batch was finished, as after a failure at its end
    commits = tmp_path / "checkpoint" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink()
    drain(spark, topic, dimensions, tmp_path)
    assert_equals_batch(spark, topic, dimensions, tmp_path, schema)
    assert json.loads((tmp_path / "checkpoint" / "metadata").read_text())["id"]


@pytest.mark.parametrize("salts", [1, 3])
def test_copies_are_dropped_across_partitions_and_batches(spark, tmp_path, salts):
    topic = Topic(tmp_path, maxFilesPerTrigger="2")
    for i in range(4):
        topic.publish(*(sale("hot", "P1", f"00:{i}{j}", 1.0) for j in range(5)), sale(f"t{i}", "P1", "00:30", 1.0))
    rows = stream_clean(spark, topic.source, "transactions")
    (
        stream_dedup(rows, "transaction_id", "transaction_time", "2 hours", salts)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    got = spark.read.parquet(str(tmp_path / "out"))
    assert "salt" not in got.columns
    assert sorted(r.transaction_id for r in got.collect()) == ["hot", "t0", "t1", "t2", "t3"]
