import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.operators import reject_counts
from tallywell.schemas import CLIENT, TRANSACTION
from tallywell.settings import Settings, Source
from tallywell.sources import (
    accepted,
    checked_messages,
    decode_messages,
    encode_messages,
    read_messages,
    rejected,
    write_messages,
)

from .conftest import message, plan, raw


@pytest.mark.parametrize("kind", ["json", "text", "parquet"])
def test_folders_hold_messages(spark, tmp_path, kind):
    rows = spark.range(20).select(
        F.col("id").cast("string").alias("key"),
        F.concat(F.lit('{"a":"\\u00e9 '), "id", F.lit('"}')).alias("value"),
    )
    source = Source(kind, str(tmp_path / "topic"))
    write_messages(rows, source)
    write_messages(rows, source)
    found = read_messages(spark, source)
    assert found.columns == ["key", "value"]
    want = rows.collect() * 2
    if kind == "text":
        want = [(None, r.value) for r in want]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want), key=str)


def test_broken_messages_are_rows_of_nulls(spark):
    rows = decode_messages(raw(spark, None, "", "nope", "[1]"), TRANSACTION).collect()
    assert len(rows) == 4
    assert all(v is None for row in rows for v in row)


def test_one_bad_field_spoils_only_itself(spark):
    (row,) = decode_messages(raw(spark, message("clients", age="old")), CLIENT).collect()
    assert row.age is None
    assert row.client_id == "C"


def test_encode_is_the_inverse_of_decode(spark):
    rows = decode_messages(
        raw(spark, message("clients"), message("clients", city=None, age=77)), CLIENT
    )
    sent = encode_messages(rows, "client_id")
    assert {r.key for r in sent.collect()} == {"C"}
    assert sorted(decode_messages(sent, CLIENT).collect(), key=str) == sorted(rows.collect(), key=str)


def test_encoded_times_keep_microseconds_and_offset(spark):
    rows = spark.sql("SELECT 'k' AS id, timestamp'2024-01-01 00:00:00.123456' AS t")
    (row,) = encode_messages(rows, "id").collect()
    assert '"t":"2024-01-01T00:00:00.123456Z"' in row.value


def test_sources_are_checked():
    with pytest.raises(ValueError):
        Source("carrier pigeon", "x")
    with pytest.raises(ValueError):
        Source("kafka", "host:9092")
    with pytest.raises(ValueError):
        Settings({"clients": Source("text", "x")}, "lake")


def test_settings_from_the_environment():
    settings = Settings.from_env(
        {"KAFKA_BOOTSTRAP": "broker:1", "POSTGRES_PASSWORD": "secret"}, "lake", top=5
    )
    assert settings.sources["clients"].location == "broker:1"
    assert settings.jdbc.url.startswith("jdbc:postgresql:")
    assert "secret" not in repr(settings)
    assert settings.top == 5
    assert Settings.from_env({}, "lake").jdbc is None


class _Recorder:
    """Stands in for a Spark reader or writer and notes what it is told."""

    def __init__(self, spark):
        self.spark, self.told, self.kind = spark, {}, None

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def load(self):
        return self.spark.createDataFrame([(b"k", b"v", 0)], "key binary, value binary, offset long")


def test_kafka_reader_options(spark):
    from tallywell.sources.messages import _load

    source = Source("kafka", "broker:9092", "clients", {"kafka.group.id": "g"})
    reader = _Recorder(spark)
    rows = _load(reader, source).collect()
    assert reader.kind == "kafka"
    assert reader.told == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "clients",
        "kafka.group.id": "g",
    }
    assert [tuple(r) for r in rows] == [("k", "v")]


SMALL = "id string, n int, x double"


@pytest.mark.parametrize(
    ("value", "row", "wrong"),
    [
        (None, None, [(None, "empty", None)]),
        ("", None, [(None, "empty", "")]),
        ("not json", None, [(None, "no object", "not json")]),
        ("[]", None, [(None, "no object", "[]")]),
        ("7", None, [(None, "no object", "7")]),
        ("null", None, [(None, "no object", "null")]),
        ('[{"id":"a"}]', None, [(None, "no object", '[{"id":"a"}]')]),
        ('{"id":"a","n":1', None, [(None, "no object", '{"id":"a","n":1')]),
        ("{}", (None, None, None), []),
        ('{"id":"a","n":1,"x":1.5,"more":[1]}', ("a", 1, 1.5), []),
        ('{"id":7,"n":null}', ("7", None, None), []),
        ('{"id":"a","n":"three","x":true}', ("a", None, None), [("n", "type", "three"), ("x", "type", "true")]),
        ('{"id":"a","n":2.0,"x":3}', ("a", None, 3.0), [("n", "type", "2.0")]),
        (' {"n":99999999999}', (None, None, None), [("n", "type", "99999999999")]),
    ],
)
def test_what_is_wrong_with_a_message(spark, value, row, wrong):
    schema = T.StructType.fromDDL(SMALL)
    messages = spark.createDataFrame([(value, "k")], "value string, reason string")
    checked = checked_messages(messages, schema)
    (got,) = checked.collect()
    assert (got.row and tuple(got.row), [tuple(r) for r in got.rejects]) == (row, wrong)
    (plain,) = decode_messages(messages, schema).collect()
    assert [tuple(plain)] == ([tuple(r) for r in accepted(checked).collect()] or [(None,) * 3])
    assert sorted(map(str, ((r.field, r.reason, r.text) for r in rejected(checked).collect()))) == sorted(map(str, wrong))


def test_rejects_are_counted_in_one_parse(spark):
    values = ["broken", None, message("transactions"), message("transactions", quantity="x"), message("transactions", quantity=True, status={})]
    raw_rows = raw(spark, *values)
    counted = reject_counts({"transactions": raw_rows})
    got = {(r.field, r.reason): r.row_count for r in counted.collect()}
    assert got == {(None, "read"): 5, (None, "kept"): 3, (None, "no object"): 1, (None, "empty"): 1, ("quantity", "type"): 2}
    assert plan(reject_counts({"transactions": raw_rows})).count("from_json") == 1
    assert reject_counts({"clients": raw_rows.limit(0)}).count() == 0


@pytest.mark.parametrize("kind, ending", [("json", ".gz"), ("text", ".gz"), ("parquet", ".zstd.parquet")])
def test_folders_are_compressed(spark, tmp_path, kind, ending):
    from tallywell.sources import write_messages

    rows = spark.createDataFrame([("k", "v"), (None, "w")], "key string, value string")
    source = Source(kind, str(tmp_path / kind))
    write_messages(rows, source)
    files = [f.name for f in (tmp_path / kind).iterdir() if f.name.startswith("part-")]
    assert files and all(name.endswith(ending) for name in files)
    assert sorted(r.value for r in read_messages(spark, source).collect()) == ["v", "w"]
