"""Taking in what is new in the topics, and merging it into the clean tables.

A stream's checkpoint is the ledger: it says up to which offset, or which files, of a topic earlier runs
took in. New messages are written down first, as numbered batches. A version of a clean table is
named after the last batch it holds, so a run that fails anywhere leaves either the old
version or the new one, and the next run goes on from there.
"""

from __future__ import annotations

from collections.abc import Mapping, MutableMapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import ENTITIES, clean_clients, clean_products, clean_transactions, valid_rows
from ..operators.dedup import dedup_latest
from ..schemas import TOPICS
from ..settings import Settings, Source
from ..sources.messages import ENVELOPE, stream_messages
from ..streaming.log import BATCH, drop_before, last_complete, read_batches, write_batch, write_updates

CLEANERS = {"transactions": clean_transactions, "clients": clean_clients, "products": clean_products}


def take_in(spark: SparkSession, source: Source, path: str, checkpoint: str) -> int | None:
    """Write the messages that came since the last time as batches; the number of the last batch there is.

    A batch that failed half-way is written again, with the same messages.
    """
    query = (
        stream_messages(spark, source)
        .writeStream.foreachBatch(write_updates(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return last_complete(spark, path)


def batches_after(spark: SparkSession, path: str, done: int | None, last: int) -> DataFrame:
    """The messages of the batches after ``done``, up to ``last``; others are not read."""
    after = -1 if done is None else done
    messages = read_batches(spark, path, T.StructType.fromDDL(ENVELOPE))
    return messages.filter((F.col(BATCH) > after) & (F.col(BATCH) <= last)).drop(BATCH)


def merged_clean(
    spark: SparkSession, settings: Settings, counts: MutableMapping[str, int] | None = None
) -> Mapping[str, DataFrame]:
    """The clean tables of all messages so far; ``counts`` gets the number of messages that are new in each topic.

    Only new messages are read and parsed. Their rows compete with the stored ones by the order of
    :func:`~tallywell.operators.dedup.dedup_latest`, which doesn't depend on when a row came, so the tables are those of one run over
    all messages. The two last versions are kept: readers may have begun with the older one.
    """
    tables = {}
    for topic in TOPICS:
        taken, versions = f"{settings.lake}/_intake/{topic}", f"{settings.lake}/_versions/{topic}"
        last = take_in(spark, settings.sources[topic], taken, f"{settings.lake}/_intake/{topic}_checkpoint")
        done = last_complete(spark, versions)
        entity = ENTITIES[topic]
        if last is None:
            # nothing has ever come
            tables[topic] = CLEANERS[topic](spark.createDataFrame([], ENVELOPE))
            new = 0
        elif done == last:
            tables[topic], new = _version(spark, versions, done, topic), 0
        else:
            messages = batches_after(spark, taken, done, last)
            new = messages.count()
            rows = valid_rows(messages, topic)
            if done is not None:
                rows = rows.unionByName(_version(spark, versions, done, topic))
            tables[topic] = write_batch(dedup_latest(rows, entity.key, entity.order_by), versions, last)
            if done is not None:
                drop_before(spark, versions, done)
        if counts is not None:
            counts[topic] = new
    return tables


def _version(spark: SparkSession, path: str, number: int, topic: str) -> DataFrame:
    schema = CLEANERS[topic](spark.createDataFrame([], ENVELOPE)).schema
    return read_batches(spark, path, schema).filter(F.col(BATCH) == number).drop(BATCH)
