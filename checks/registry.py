"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager, nullcontext
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.operators import (
    ENTITIES,
    KPI_COLUMNS,
    conform_to_target,
    orphan_keys,
    target_violations,
    clean_clients,
    clean_products,
    clean_transactions,
    client_sketches,
    compute_all,
    customer_segments,
    dedup_latest,
    distinct_clients,
    kpi_row_counts,
    merged_sketches,
    reject_counts,
    relative_error,
    revenue_by_category,
    revenue_by_country,
    stage_counts,
    top_products,
    valid_rows,
    windowed_kpi,
)
from tallywell.plans import RunResult, run, store_clean, store_kpis
from tallywell.schemas import KPI_NAMES, MESSAGE_SCHEMAS, TOPICS
from tallywell.scratch import materialize, scratch_dir
from tallywell.session import recommended_conf
from tallywell.settings import Settings, Source
from tallywell.sinks import between_dates, by_date, date_unit, folder_bytes, sink_audit, write_parquet
from tallywell.sinks.lake import PERIODS
from tallywell.sources import decode_messages, encode_messages, read_messages, write_messages
from tallywell.sources.messages import COMPRESSION, ZSTD_LEVEL
from tallywell.sources.synth import client_rows, product_rows, transaction_rows
from tallywell.streaming import (
    closed_top_products,
    current_kpi,
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

from .feeds import feed, table, timed_feed, topic

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = "2024-06-01T12:00:00Z"
QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, like those of the given tables."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        )
    )


def register(name: str, query: Query) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # times without an offset are read in the session's zone
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(query(spark, sf_dir))

    QUERIES[name] = run


def query(name: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        register(name, run)
        return run

    return add


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _state_per_core(spark: SparkSession):
    """Streaming state is never merged like batch partitions: one part for each core."""
    cores = spark.sparkContext.defaultParallelism
    return _setting(spark, "spark.sql.shuffle.partitions", str(cores))


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streaming state in RocksDB, with bounded memory for all of an executor's."""
    state = {k: v for k, v in recommended_conf(0).items() if k.startswith("spark.sql.streaming.stateStore.")}
    with ExitStack() as settings:
        for key, value in (state | {"spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}).items():
            settings.enter_context(_setting(spark, key, value))
        yield


CLEANERS = {
    "transactions": clean_transactions,
    "clients": clean_clients,
    "products": clean_products,
}


def cleaned(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return CLEANERS[topic](feed(spark, sf_dir, topic))



# --- messages -----------------------------------------------------------------


@query("src_messages")
def _src_messages(spark, sf_dir):
    kinds = {"transactions": "json", "clients": "text", "products": "parquet"}
    counts = []
    for name, kind in kinds.items():
        source = Source(kind, scratch_dir(spark, f"topic-{name}"))
        write_messages(feed(spark, sf_dir, name), source)
        counts.append(
            read_messages(spark, source).agg(
                F.lit(name).alias("entity"),
                F.lit(kind).alias("kind"),
                F.count("value").alias("messages"),
                F.count("key").alias("keyed"),
            )
        )
    return reduce(DataFrame.unionByName, counts)


def _decode(topic: str) -> Query:
    return lambda spark, sf_dir: decode_messages(feed(spark, sf_dir, topic), MESSAGE_SCHEMAS[topic])


def _cleaned(topic: str) -> Query:
    return lambda spark, sf_dir: cleaned(spark, sf_dir, topic)


for _topic in TOPICS:
    register(f"decode_{_topic}", _decode(_topic))
    register(f"clean_{_topic}", _cleaned(_topic))


@query("encode_roundtrip")
def _encode_roundtrip(spark, sf_dir):
    sent = encode_messages(cleaned(spark, sf_dir, "transactions"), "transaction_id")
    found = decode_messages(sent, MESSAGE_SCHEMAS["transactions"])
    return found.withColumn("transaction_time", F.try_to_timestamp("transaction_time"))


@query("dedup_latest")
def _dedup_latest_rows(spark, sf_dir):
    rows = valid_rows(feed(spark, sf_dir, "transactions"), "transactions")
    return dedup_latest(rows, "transaction_id", ENTITIES["transactions"].order_by)


@query("decode_rejects")
def _decode_rejects(spark, sf_dir):
    # more that is broken: messages cut short, fields of another type
    order = F.regexp_extract("key", r"TXN-(\d+)-", 1).try_cast("bigint")
    value = (
        F.when(order % 131 == 0, F.substring("value", 1, 20))
        .when(order % 127 == 0, F.regexp_replace("value", r'"quantity":\d+', '"quantity":"many"'))
        .when(order % 137 == 0, F.regexp_replace("value", r'"unit_price":[^,}]+', '"unit_price":true'))
        .otherwise(F.col("value"))
    )
    return reject_counts({"transactions": feed(spark, sf_dir, "transactions").withColumn("value", value)})


@query("run_counts")
def _run_counts(spark, sf_dir):
    return stage_counts({topic: feed(spark, sf_dir, topic) for topic in TOPICS})


# --- KPIs ---------------------------------------------------------------------


@query("kpi_revenue_by_category")
def _kpi_revenue_by_category(spark, sf_dir):
    txn, prd = (cleaned(spark, sf_dir, t) for t in ("transactions", "products"))
    return revenue_by_category(txn, prd, RUN_TS)


@query("kpi_revenue_by_country")
def _kpi_revenue_by_country(spark, sf_dir):
    txn, cli = (cleaned(spark, sf_dir, t) for t in ("transactions", "clients"))
    return revenue_by_country(txn, cli, RUN_TS)


@query("kpi_top_products")
def _kpi_top_products(spark, sf_dir):
    txn, prd = (cleaned(spark, sf_dir, t) for t in ("transactions", "products"))
    return top_products(txn, prd, run_ts=RUN_TS)


@query("kpi_customer_segments")
def _kpi_customer_segments(spark, sf_dir):
    txn, cli = (cleaned(spark, sf_dir, t) for t in ("transactions", "clients"))
    return customer_segments(txn, cli, RUN_TS)


def _kpis(spark, sf_dir, orphans="keep") -> dict[str, DataFrame]:
    """All KPIs. Clean rows are written first, in the columns read, so that rows are parsed and deduplicated once, not by each KPI."""
    stored = (materialize(cleaned(spark, sf_dir, t).select(*KPI_COLUMNS[t]), t) for t in TOPICS)
    return compute_all(*stored, RUN_TS, orphans=orphans, share=scratch_dir(spark, "totals"))


@query("kpi_row_counts")
def _kpi_counts(spark, sf_dir):
    return kpi_row_counts(_kpis(spark, sf_dir))


def _windowed(name: str) -> Query:
    by_product = name in ("kpi_revenue_by_category", "kpi_top_products")
    dimension = "products" if by_product else "clients"

    def run(spark, sf_dir):
        txn, dim = (cleaned(spark, sf_dir, t) for t in ("transactions", dimension))
        return windowed_kpi(name, txn, dim, "1 day")

    return run


for _name in KPI_NAMES:
    register(_name.replace("kpi_", "win_"), _windowed(_name))


# --- sinks --------------------------------------------------------------------


@query("parquet_roundtrip")
def _parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "lake")
    write_parquet(cleaned(spark, sf_dir, "transactions"), path)
    return spark.read.parquet(path)


@query("parquet_partition_pruned")
def _parquet_partition_pruned(spark, sf_dir):
    path = _dated(spark, sf_dir)
    return (
        between_dates(spark.read.parquet(path), "1998-01-01", "1998-12-31")
        .groupBy("status")
        .agg(F.count("*").alias("order_count"), F.sum("quantity").alias("units"))
    )


def _dated(spark, sf_dir, cluster_by=()) -> str:
    """A folder of the transactions by as long a date unit as their bytes ask for."""
    flat, path = scratch_dir(spark, "flat"), scratch_dir(spark, "lake")
    write_parquet(cleaned(spark, sf_dir, "transactions"), flat)
    rows = spark.read.parquet(flat)
    unit = date_unit(rows, folder_bytes(spark, flat))
    write_parquet(by_date(rows, unit), path, partition_by=PERIODS[unit], cluster_by=cluster_by)
    return path


@query("lake_clients_in_month")
def _lake_clients_in_month(spark, sf_dir):
    # the rows of clients in their thirties, in files sorted by client
    stored = between_dates(spark.read.parquet(_dated(spark, sf_dir, ["client_id"])), "1996-02-10", "1996-03-09")
    wanted = cleaned(spark, sf_dir, "clients").filter(F.col("age").between(30, 39)).select("client_id")
    return (
        stored.join(wanted, "client_id", "left_semi")
        .groupBy("client_id")
        .agg(F.count("*").alias("order_count"), F.sum("quantity").alias("units"))
    )


@query("kpi_bucketed")
def _kpi_bucketed(spark, sf_dir):
    lake, buckets = scratch_dir(spark, "lake"), 8
    stored = store_clean({t: cleaned(spark, sf_dir, t) for t in TOPICS}, lake, buckets=buckets)
    return _flat(compute_all(*(stored[t] for t in TOPICS), RUN_TS, share=f"{lake}/_totals", buckets=buckets))


@query("target_conform")
def _target_conform(spark, sf_dir):
    shaped = conform_to_target(cleaned(spark, sf_dir, "transactions"), "transactions")
    # as text, so that scale is compared too
    return shaped.withColumns({c: F.col(c).cast("string") for c in ("unit_price", "total_amount")})


@query("target_violations")
def _target_violations(spark, sf_dir):
    found = [
        target_violations(decode_messages(feed(spark, sf_dir, t), MESSAGE_SCHEMAS[t]), t)
        for t in TOPICS
    ]
    txn, prd = (cleaned(spark, sf_dir, t) for t in ("transactions", "products"))
    found.append(
        target_violations(revenue_by_category(txn, prd, RUN_TS), "kpi_revenue_by_category")
    )
    return reduce(DataFrame.unionByName, found)


@query("orphan_keys")
def _orphan_keys(spark, sf_dir):
    txn, prd = (cleaned(spark, sf_dir, t) for t in ("transactions", "products"))
    return orphan_keys(txn, prd, "product_id")


#: key, number of orders or units, mean, distinct clients, and name of each KPI; none where it has none
FLAT = {
    "kpi_revenue_by_category": ("category", "order_count", "avg_order_value", None, None),
    "kpi_revenue_by_country": ("country", "order_count", None, "unique_clients", None),
    "kpi_top_products": ("product_id", "units_sold", None, None, "product_name"),
    "kpi_customer_segments": ("segment", "order_count", "avg_spend", "unique_clients", None),
}


def _flat(kpis: dict[str, DataFrame]) -> DataFrame:
    """The KPI tables under one another, with all their columns."""
    names = {"key": "string", "number": "bigint", "mean": "double", "clients": "bigint", "name": "string"}
    parts = [
        kpis[kpi].select(
            F.lit(kpi).alias("kpi"),
            "window_start",
            "window_end",
            "total_revenue",
            *(
                (F.lit(None) if column is None else F.col(column)).cast(kind).alias(name)
                for column, (name, kind) in zip(columns, names.items())
            ),
        )
        for kpi, columns in FLAT.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _orphans(what: str) -> Query:
    return lambda spark, sf_dir: _flat(_kpis(spark, sf_dir, what))


for _what in ("drop", "label"):
    register(f"kpi_orphans_{_what}", _orphans(_what))


@query("store_clean")
def _store_clean(spark, sf_dir):
    stored = store_clean(
        {t: cleaned(spark, sf_dir, t) for t in TOPICS}, scratch_dir(spark, "lake")
    )
    # whole rows, as text
    rows = [
        df.select(
            F.lit(t).alias("entity"),
            F.concat_ws("|", *(F.coalesce(_text(df, c), F.lit("null")) for c in df.columns)).alias("row"),
        )
        for t, df in stored.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _text(df: DataFrame, column: str) -> Column:
    """A value as text: numbers in thousandths, since engines write doubles each their own way."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DoubleType):
        return F.round(F.col(column) * 1000).cast("bigint").cast("string")
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return F.col(column).cast("string")


@query("store_kpis")
def _store_kpis(spark, sf_dir):
    return _flat(store_kpis(_kpis(spark, sf_dir), scratch_dir(spark, "lake")))


def _run(spark, sf_dir, dated: bool) -> tuple[str, RunResult]:
    """A whole run over the topics; ``dated`` is a run's default, in folders as long as bytes ask for."""
    sources = {t: topic(spark, sf_dir, t) for t in TOPICS}
    lake = scratch_dir(spark, "lake")
    return lake, run(spark, Settings(sources, lake, by_date=dated, date_unit=None), RUN_TS)


@query("end_to_end")
def _end_to_end(spark, sf_dir):
    return _flat(_run(spark, sf_dir, True)[1].kpis)


@query("run_summary")
def _run_summary(spark, sf_dir):
    return _run(spark, sf_dir, False)[1].summary.select(
        "status", "records_ingested", "records_processed", "records_stored", "errors"
    )


@query("incremental_run")
def _incremental_run(spark, sf_dir):
    # the first run takes in half of the transactions' time, the second one the rest
    lake, slices, ingested = scratch_dir(spark, "lake"), 2, []
    messages, slice_of = timed_feed(spark, sf_dir, "transactions"), _time_slice(spark, sf_dir, slices)
    others = {t: topic(spark, sf_dir, t) for t in ("clients", "products")}
    for number, source in enumerate(_in_slices(messages, slice_of, slices, stored=True), 1):
        settings = Settings({"transactions": source, **others}, lake, by_date=False, incremental=True)
        with _state_per_core(spark):
            result = run(spark, settings, RUN_TS)
        ingested.append(result.summary.select(F.lit(f"run {number}").alias("kpi"), F.col("records_ingested").alias("number")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_flat(result.kpis), *ingested])


@query("distinct_clients_merged")
def _distinct_clients_merged(spark, sf_dir):
    txn = cleaned(spark, sf_dir, "transactions")
    # kept per day; quarters are made of the days, not of the transactions
    days = materialize(client_sketches(txn, "day"), "sketches")
    found = distinct_clients(merged_sketches(days, "quarter"))
    exact = txn.groupBy(F.date_trunc("quarter", "transaction_time").alias("period")).agg(
        F.count_distinct("client_id").alias("exact_clients")
    )
    bound = F.greatest(F.lit(1.0), F.col("exact_clients") * relative_error())
    within = (F.abs(F.col("unique_clients") - F.col("exact_clients")) <= bound).alias("within_bound")
    return found.join(exact, "period").select("period", "exact_clients", "orders", within)


@query("sink_audit")
def _sink_audit(spark, sf_dir):
    lake = _run(spark, sf_dir, False)[0]
    # the table's path below the lake; how many files it has is up to the cluster
    return sink_audit(spark, lake).select(
        F.split_part("folder", F.lit(f"{lake.split('/')[-1]}/"), F.lit(2)).alias("folder"),
        F.col("rows").alias("row_count"),
        (F.col("files") > 0).alias("has_files"),
    )


# --- synthetic rows, one for each row of a table ------------------------------

BASE_TS = "2024-06-01 12:00:00"


@query("synth_clients")
def _synth_clients(spark, sf_dir):
    return client_rows(table(spark, sf_dir, "customer").selectExpr("c_custkey AS n"), BASE_TS)


@query("synth_products")
def _synth_products(spark, sf_dir):
    return product_rows(table(spark, sf_dir, "part").selectExpr("p_partkey AS n"))


@query("synth_transactions")
def _synth_transactions(spark, sf_dir):
    numbers = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS n")
    clients, products = (table(spark, sf_dir, t).count() for t in ("customer", "part"))
    return transaction_rows(numbers, clients, products, BASE_TS)


# --- streams ------------------------------------------------------------------


def _drain(rows: DataFrame, spark: SparkSession, folders: tuple[str, str] | None = None, on_disk: bool = False) -> DataFrame:
    """Run an append-mode query over all its input and return what it wrote.

    ``folders`` are those of an earlier run that this one goes on from. ``on_disk``: its state is, not on the heap.
    """
    path, checkpoint = folders or (scratch_dir(spark, "stream"), scratch_dir(spark, "checkpoint"))
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with _state_per_core(spark), _state_on_disk(spark) if on_disk else nullcontext():
        writer.start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


#: files that each slice of a paced topic has at least
_FILES = 4


def _staged(messages: DataFrame, slice_of: Column, slices: int, stored: bool) -> DataFrame:
    """Messages with the slice each is in; those not ``stored`` are written first, in a folder for each slice, which then reads no other."""
    sliced, spark = messages.withColumn("slice", slice_of), messages.sparkSession
    if stored:
        return sliced
    path = scratch_dir(spark, "staged")
    # a task writes all slices at once, rows need no sort
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(slices)):
        sliced.write.options(**ZSTD_LEVEL).partitionBy("slice").parquet(path, compression=COMPRESSION["parquet"])
    return spark.read.schema(sliced.schema).parquet(path)


def _publish(sliced: DataFrame, slices: int, files: int | None) -> Iterator[Source]:
    source = Source("parquet", scratch_dir(sliced.sparkSession, "topic-slices"))
    for number in range(slices):
        part = sliced.filter(F.col("slice") == number)
        write_messages(part if files is None else _in_files(part, files), source)
        yield source


def _in_files(rows: DataFrame, files: int) -> DataFrame:
    """Rows for just so many files: splits of the input side by side, dealt out anew only if some file would get none."""
    near = rows.coalesce(files)
    filled = near.groupBy(F.spark_partition_id()).count().count()
    return near if filled == files else rows.repartition(files)


def _in_slices(messages: DataFrame, slice_of: Column, slices: int, stored: bool = False) -> Iterator[Source]:
    """Publish messages slice by slice into one topic, pausing after each one."""
    return _publish(_staged(messages, slice_of, slices, stored), slices, None)


def _paced(messages: DataFrame, slice_of: Column, slices: int, stored: bool = False) -> Source:
    """A topic of slices one after another, of which one run takes a slice a batch: as many files, more for a larger topic."""
    sliced = _staged(messages, slice_of, slices, stored)
    # the splits of a slice; messages not in folders have them in common
    splits = [sliced.filter(F.col("slice") == number).rdd.getNumPartitions() for number in range(1 if stored else slices)]
    files = max(_FILES, splits[0] // 2 if stored else min(splits))
    *_, source = _publish(sliced, slices, files)
    return replace(source, options={"maxFilesPerTrigger": str(files)})


def _time_slice(spark: SparkSession, sf_dir: str, slices: int) -> Column:
    """Which of ``slices`` equal parts of the tables' time span a message is from."""
    low, high = (
        table(spark, sf_dir, "lineitem")
        .selectExpr("min(l_shipdate) AS low", "max(l_shipdate) AS high")
        .first()
    )
    days = (high - low).days // slices + 1
    return F.floor(F.date_diff("event_ts", F.lit(low.date())) / days).cast("int")


@query("stream_clean_transactions")
def _stream_clean_transactions(spark, sf_dir):
    source = topic(spark, sf_dir, "transactions")
    return _drain(stream_clean(spark, source, "transactions"), spark)


@query("stream_dedup")
def _stream_dedup(spark, sf_dir):
    rows = stream_clean(spark, topic(spark, sf_dir, "transactions"), "transactions")
    # copies in these tables are up to seven years apart
    first = _drain(stream_dedup(rows, "transaction_id", "transaction_time", "2600 days"), spark)
    # which copy came first is chance, but it has to be one of those sent, as it was
    sent = valid_rows(feed(spark, sf_dir, "transactions"), "transactions")
    return _as_sent(first, sent, "transaction_id")


def _as_sent(first: DataFrame, sent: DataFrame, key: str) -> DataFrame:
    """Rows of ``first`` per ``key``, and how many of them are equal to some row of ``sent``.

    Both are grouped by the whole row in one shuffle: equal rows meet as one row per task, and none are sorted to be joined.
    """
    both = first.select("*", F.lit(1).alias("came")).unionByName(sent.select("*", F.lit(0).alias("came")))
    rows = both.groupBy(*first.columns).agg(F.sum("came").alias("came"), F.min("came").alias("least")).filter("came > 0")
    as_sent = F.when(F.col("least") == 0, F.col("came")).otherwise(F.lit(0))
    return rows.groupBy(key).agg(F.sum("came").alias("row_count"), F.sum(as_sent).alias("rows_as_sent"))


def _clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean transactions as messages again, with their time."""
    rows = cleaned(spark, sf_dir, "transactions")
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}
    return rows.select(
        F.col("transaction_id").alias("key"),
        F.to_json(F.struct("*"), options).alias("value"),
        F.col("transaction_time").alias("event_ts"),
    )


def _paced_transactions(spark, messages, slice_of, slices, delay) -> DataFrame:
    """The first arrival of each id, as one run takes them slice by slice."""
    rows = stream_clean(spark, _paced(messages, slice_of, slices), "transactions")
    return stream_dedup(rows, "transaction_id", "transaction_time", delay)


def _revenue_by_slices(spark, sf_dir, kpi, messages, slice_of, slices, delay) -> DataFrame:
    """A streaming KPI after all slices, one query run for each slice; windows still open are left out."""
    dimension = _dimension(spark, sf_dir, kpi)
    folders = scratch_dir(spark, "stream"), scratch_dir(spark, "checkpoint")
    for source in _in_slices(messages, slice_of, slices):
        rows = stream_clean(spark, source, "transactions")
        first = stream_dedup(rows, "transaction_id", "transaction_time", delay)
        # a month of ids is held
        closed = _drain(stream_windowed_revenue(kpi, first, dimension), spark, folders, on_disk=True)
    return closed


def _dimension(spark: SparkSession, sf_dir: str, kpi: str) -> DataFrame:
    name = "products" if kpi in ("kpi_revenue_by_category", "kpi_top_products") else "clients"
    return materialize(cleaned(spark, sf_dir, name), name)


def _stream_win(kpi: str) -> Query:
    def run(spark, sf_dir):
        slices = 3
        messages, slice_of = _clean_messages(spark, sf_dir), _time_slice(spark, sf_dir, slices)
        first = _paced_transactions(spark, messages, slice_of, slices, "1 day")
        return _drain(stream_windowed_revenue(kpi, first, _dimension(spark, sf_dir, kpi)), spark)

    return run


for _kpi in ("kpi_revenue_by_category", "kpi_revenue_by_country", "kpi_customer_segments"):
    register(_kpi.replace("kpi_", "stream_win_"), _stream_win(_kpi))


@query("stream_win_top_products")
def _stream_win_top_products(spark, sf_dir):
    slices = 3
    products = _dimension(spark, sf_dir, "kpi_top_products")
    messages, slice_of = _clean_messages(spark, sf_dir), _time_slice(spark, sf_dir, slices)
    first = _paced_transactions(spark, messages, slice_of, slices, "1 day")
    path, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "checkpoint")
    with _state_per_core(spark):
        stream_top_products(first, products, path, checkpoint).awaitTermination()
    return closed_top_products(spark, path)


def _logged(rows: DataFrame, mode: str) -> str:
    """Run a query over all its input; the log of what each batch put out."""
    spark = rows.sparkSession
    path, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "checkpoint")
    writer = rows.writeStream.outputMode(mode).foreachBatch(write_updates(path)).option("checkpointLocation", checkpoint)
    with _state_per_core(spark):
        writer.trigger(availableNow=True).start().awaitTermination()
    return path


@query("stream_paced")
def _stream_paced(spark, sf_dir):
    # five batches of one run, and one without rows that closes what the last one lets close
    slices = 5
    products = _dimension(spark, sf_dir, "kpi_revenue_by_category")
    source = _paced(_clean_messages(spark, sf_dir), _time_slice(spark, sf_dir, slices), slices)
    rows = stream_clean(spark, source, "transactions")
    closed = stream_windowed_revenue("kpi_revenue_by_category", rows, products, delay="1 day")
    taken = read_batches(spark, _logged(rows, "append"), rows.schema).groupBy("batch_id").agg(F.count("*").alias("rows_in"))
    windows = (
        read_batches(spark, _logged(closed, "append"), closed.schema)
        .groupBy("batch_id")
        .agg(F.count_distinct("window_start").alias("windows_closed"), F.sum("order_count").alias("rows_closed"))
    )
    return taken.join(windows, "batch_id", "full").na.fill(0)


@query("stream_dedup_latest")
def _stream_dedup_latest(spark, sf_dir):
    # copies of an id are in different batches, later ones before earlier ones too
    slices, entity = 3, ENTITIES["transactions"]
    slice_of = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(slices)).cast("int")
    source = _paced(timed_feed(spark, sf_dir, "transactions"), slice_of, slices, stored=True)
    rows = stream_clean(spark, source, "transactions")
    latest = stream_latest(rows, entity.key, entity.order_by)
    return latest_updates(spark, _logged(latest, "update"), rows.schema, [entity.key])


@query("stream_late_rows")
def _stream_late_rows(spark, sf_dir):
    # orders of seven, fourteen ... units come with the last slice, most of them late
    slices = 3
    late = F.get_json_object("value", "$.quantity").cast("int") % 7 == 0
    slice_of = F.when(late, slices - 1).otherwise(_time_slice(spark, sf_dir, slices))
    messages = _clean_messages(spark, sf_dir)
    kpi = "kpi_revenue_by_category"
    return _revenue_by_slices(spark, sf_dir, kpi, messages, slice_of, slices, "30 days")


@query("stream_foreach_batch")
def _stream_foreach_batch(spark, sf_dir):
    slices = 2
    clients, products = (
        materialize(cleaned(spark, sf_dir, t), t) for t in ("clients", "products")
    )
    lake, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    messages, slice_of = timed_feed(spark, sf_dir, "transactions"), _time_slice(spark, sf_dir, slices)
    for source in _in_slices(messages, slice_of, slices, stored=True):
        rows = stream_clean(spark, source, "transactions")
        # every batch has all dates of seven years, few rows each
        stream_to_sinks(
            rows, clients, products, lake, checkpoint, log_unit="year"
        ).awaitTermination()
    return _flat({kpi: current_kpi(spark, lake, kpi) for kpi in KPI_NAMES})


@query("stream_horizon")
def _stream_horizon(spark, sf_dir):
    # each id once, so copies lie no time apart, in two batches that share all their windows
    slices = 2
    clients, products = (
        materialize(cleaned(spark, sf_dir, t), t) for t in ("clients", "products")
    )
    lake, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    slice_of = F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(slices)).cast("int")
    for source in _in_slices(_clean_messages(spark, sf_dir), slice_of, slices):
        rows = stream_clean(spark, source, "transactions")
        stream_to_sinks(
            rows, clients, products, lake, checkpoint, width="28 days", horizon="1 hour", log_unit="year"
        ).awaitTermination()
    return _flat({kpi: current_kpi(spark, lake, kpi) for kpi in KPI_NAMES})
