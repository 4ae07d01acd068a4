import random

from pyspark.sql import functions as F

from tallywell.operators import dedup_latest

from .conftest import plan


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice(["a", "b", "c", None, "hot", "hot", "hot"]), rng.choice([None, 1, 2, 3]),
         rng.choice(["x", "y", None]), i % 7)
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "k string, t int, s string, n int").repartition(7)
    got = {tuple(r) for r in dedup_latest(df, "k", ["t"]).collect()}

    def rank(row):
        return [(v is not None, v if v is not None else 0) for v in row[1:2]] + [
            (row[2] is not None, row[2] or ""), (True, row[3]),
        ]

    want = {}
    for row in rows:
        if row[0] not in want or rank(row) > rank(want[row[0]]):
            want[row[0]] = row
    assert got == set(want.values())


def test_several_key_columns(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 1, 7)], "a int, b int, t int")
    assert sorted(map(tuple, dedup_latest(df, ["a", "b"], ["t"]).collect())) == [(1, 1, 7), (1, 2, 6)]


def test_a_hot_key_is_cut_down_before_the_shuffle(spark, tmp_path):
    # two thirds of all rows share one key
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"),
    )
    result = dedup_latest(df, "k", ["t"])
    text = plan(result)
    # executed bottom up: the limit below the exchange is the one in the map tasks
    assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning") :]
    result.write.format("noop").mode("overwrite").save()
    assert result.filter("k = 'hot'").collect()[0].t == 2999
    assert result.count() == 1001
