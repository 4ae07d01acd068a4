"""Every registered query beside its SQL, on the smallest tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from checks.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query(spark, tables, name):
    got = entry_points.queries()[name](spark, SF_DIR).toPandas()
    assert len(got)
    want = tables.execute(entry_points.oracle_sql()[name]).df()
    assert differences(got, want) is None


def test_every_query_has_its_sql():
    """The text operators, if they are there, have their own tests."""
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(entry_points.registry.QUERIES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).columns[2] == "category"


def test_slices_of_a_paced_topic_have_as_many_files_each(spark, tmp_path):
    from pyspark.sql import functions as F

    from checks import registry

    for parts in (1, 24):
        rows = spark.range(0, 2400, 1, parts).selectExpr("string(id) AS key", "string(id) AS value")
        rows.write.parquet(str(tmp_path / f"topic-{parts}"))
        stored = rows if parts > 1 else spark.read.parquet(str(tmp_path / "topic-1"))
        source = registry._paced(stored, F.expr("int(key % 3)"), 3, stored=True)
        files = [f for f in os.listdir(source.location) if f.startswith("part-")]
        each = int(source.options["maxFilesPerTrigger"])
        assert each == max(4, parts // 2) and len(files) == 3 * each
        assert spark.read.parquet(source.location).count() == 2400
