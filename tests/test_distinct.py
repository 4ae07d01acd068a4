from pyspark.sql import functions as F

from tallywell.operators import client_sketches, distinct_clients, merged_sketches, relative_error


def test_merged_sketches_are_near_the_exact_count(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 97 != 0, F.format_string("c%d", F.pmod(F.xxhash64("id"), F.lit(30_000)))).alias("client_id"),
        F.timestamp_seconds(F.col("id") * 40).alias("transaction_time"),
    )
    days = client_sketches(rows)
    for unit in ("month", "year"):
        got = {r.period: r for r in distinct_clients(merged_sketches(days, unit)).collect()}
        exact = rows.groupBy(F.date_trunc(unit, "transaction_time").alias("period")).agg(
            F.count_distinct("client_id").alias("n"), F.count("*").alias("orders")
        )
        found = exact.collect()
        assert {r.period for r in found} == set(got)
        for r in found:
            assert abs(got[r.period].unique_clients - r.n) <= relative_error() * r.n and got[r.period].orders == r.orders


def test_parts_of_a_period_are_merged(spark):
    rows = spark.range(40).select(F.col("id").cast("string").alias("client_id"), F.lit("2024-01-05 10:00:00").cast("timestamp").alias("transaction_time"))
    parts = client_sketches(rows.filter("id < 30")).union(client_sketches(rows.filter("id >= 10")))
    (row,) = distinct_clients(merged_sketches(parts, "day")).collect()
    assert (row.unique_clients, row.orders) == (40, 60)
    assert client_sketches(rows.limit(0)).count() == 0
    (none,) = distinct_clients(client_sketches(rows.withColumn("client_id", F.lit(None).cast("string")))).collect()
    assert (none.unique_clients, none.orders) == (0, 40)
