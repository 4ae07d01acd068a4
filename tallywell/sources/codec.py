"""JSON messages to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def decode_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """One typed row per message in column ``value``.

    A text that is no JSON object gives a row of nulls; a field of the wrong type
    gives a null in that field only; unknown fields are ignored.

    The generator is a barrier: Catalyst pushes filters through a projection by
    copying the expressions they use, which here would parse every message once
    more per tested column. Nothing is pushed through the generator's own output.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(parsed)))


def checked_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Every message with ``row``, typed as by :func:`decode_messages`, and ``rejects``, what is wrong with it.

    ``rejects`` is an array of ``field``, ``reason`` and ``text``. A message that holds no JSON object has one
    entry without a field, ``empty`` or ``no object``, and no row. Otherwise each field that is there but not of its type has
    one, ``type``, with what it holds; it is null in the row. Null and missing fields are no rejects.

    A message is parsed once. Only one that the parser marks is looked at again, for its fields.
    """
    mark = "_corrupt_record"
    while mark in schema.names:
        mark = f"_{mark}"
    marked = T.StructType([*schema.fields, T.StructField(mark, T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": mark})
    # a generator, for the same reason as above
    found = messages.select("*", F.inline(F.array(F.struct(parsed.alias("parsed")))))
    row = F.struct(*(F.col(f"parsed.{name}").alias(name) for name in schema.names))

    def entry(field: Column, reason: str, held: Column) -> Column:
        return F.struct(field.cast("string").alias("field"), F.lit(reason).alias("reason"), held.alias("text"))

    no_field = F.lit(None)
    wrong = [
        F.when(F.col(f"parsed.{name}").isNull() & held.isNotNull(), entry(F.lit(name), "type", held))
        for name, held in ((n, F.get_json_object(text, f"$.{n}")) for n in schema.names)
    ]
    is_object = F.coalesce(F.ltrim(F.get_json_object(text, "$")).startswith("{"), F.lit(False))
    rejects = (
        F.when(F.col("parsed").isNull(), F.array(entry(no_field, "empty", text)))
        .when(F.col(f"parsed.{mark}").isNull(), F.array().cast("array<struct<field:string,reason:string,text:string>>"))
        .when(~is_object, F.array(entry(no_field, "no object", text)))
        .otherwise(F.array_compact(F.array(*wrong)))
    )
    checked = found.select(*messages.columns, row.alias("row"), rejects.alias("rejects"))
    unusable = F.coalesce(F.get("rejects", F.lit(0))["field"].isNull() & (F.size("rejects") > 0), F.lit(False))
    return checked.withColumn("row", F.when(~unusable, F.col("row")))


def accepted(checked: DataFrame) -> DataFrame:
    """The typed rows of the messages that hold an object; fields that don't fit are null."""
    return checked.filter(F.col("row").isNotNull()).select("row.*")


def rejected(checked: DataFrame) -> DataFrame:
    """What is wrong, a row for each: the message's columns, ``field``, ``reason`` and ``text``."""
    rest = [c for c in checked.columns if c not in ("row", "rejects", "field", "reason", "text")]
    return checked.select(*rest, F.inline("rejects"))


def encode_messages(rows: DataFrame, key: str) -> DataFrame:
    """``(key, value)`` messages; timestamps become ISO-8601 text with an offset."""
    options = {"timestampFormat": MICROS_UTC, "ignoreNullFields": "false"}
    return rows.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("*"), options).alias("value"),
    )
