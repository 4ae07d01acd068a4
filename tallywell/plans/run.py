"""A whole run: read, clean, store, compute, store, report."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, MutableMapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform_to_target
from ..operators.kpis import compute_all
from ..schemas import TARGETS, TOPICS
from ..scratch import store_at
from ..settings import Settings
from ..sinks.jdbc import write_jdbc
from ..sinks.audit import folder_bytes
from ..sinks.lake import FOLDER_BYTES, SURE_DAYS, date_unit, rows_of, write_parquet
from ..sources.messages import read_messages
from .intake import CLEANERS, merged_clean
from .store import store_clean, store_kpis

# fixed values: what a run shows of its KPIs
SHOWN = {
    "kpi_revenue_by_category": ("category", "total_revenue", "order_count", "avg_order_value"),
    "kpi_top_products": ("product_name", "units_sold", "total_revenue"),
    "kpi_customer_segments": ("segment", "total_revenue", "order_count", "unique_clients", "avg_spend"),
}


@dataclass(frozen=True)
class RunResult:
    """Stored tables of a run, and its one-row summary."""

    clean: Mapping[str, DataFrame]
    kpis: Mapping[str, DataFrame]
    summary: DataFrame

    def samples(self, rows: int = 10) -> dict[str, DataFrame]:
        """The first rows of the KPIs that a run shows, in the columns it shows."""
        return {name: self.kpis[name].select(*shown).limit(rows) for name, shown in SHOWN.items()}


def run_summary(
    spark: SparkSession,
    run_id: str,
    started: datetime,
    ended: datetime,
    status: str,
    ingested: int,
    processed: int,
    stored: int,
    errors: int = 0,
    notes: str | None = None,
) -> DataFrame:
    """One row of the run log, in the columns of its target table."""
    row = (run_id, started.isoformat(), ended.isoformat(), status,
           ingested, processed, stored, errors, notes)
    fields = TARGETS["pipeline_runs"].written
    # counts of a large run exceed INT
    wide = {"int": "bigint"}
    values = [
        F.lit(value).cast(wide.get(f.type, f.type)).alias(f.name) for f, value in zip(fields, row)
    ]
    return spark.range(1).select(*values)


def land(
    spark: SparkSession, settings: Settings, counts: MutableMapping[str, int] | None = None
) -> dict[str, DataFrame]:
    """The messages of all topics as one fixed snapshot; ``counts`` gets their numbers.

    A topic moves on between actions, so it is written down once, in place of the
    last run's snapshot, counted as it is written, and cleaned from there. A Parquet folder's
    listing is fixed when it is opened, and its files say how many rows they hold.
    """
    raw = {}
    for topic in TOPICS:
        source = settings.sources[topic]
        messages = read_messages(spark, source)
        if source.kind != "parquet":
            path, counted = f"{settings.lake}/_raw/{topic}", Observation()
            write_parquet(messages, path, counted=counted)
            messages, rows = spark.read.schema(messages.schema).parquet(path), rows_of(counted)
        elif counts is not None:
            rows = messages.count()
        if counts is not None:
            counts[topic] = rows
        raw[topic] = messages
    return raw


def run(
    spark: SparkSession,
    settings: Settings,
    run_ts: datetime | str | None = None,
    run_id: str | None = None,
) -> RunResult:
    """Everything in the topics to clean tables and KPIs in the lake and database.

    With ``settings.incremental`` only messages that came since the last such run on this lake are read, and
    merged into the clean tables; they are what counts as ingested.

    Rows are counted by the tasks that write them; no table is read again for it, and tasks that are
    tried again do not inflate the counts.
    """
    run_id = run_id or f"run-{uuid.uuid4().hex}"
    started = _now()
    ingested = processed = stored = 0
    try:
        counts: dict[str, int] = {}
        if settings.incremental:
            frames = merged_clean(spark, settings, counts)
        else:
            raw = land(spark, settings, counts)
            frames = {topic: CLEANERS[topic](raw[topic]) for topic in TOPICS}
        ingested = sum(counts.values())

        counts = {}
        unit = settings.date_unit
        if unit is None:
            unit, transactions = _unit(spark, settings, frames["transactions"])
            frames = {**frames, "transactions": transactions}
        clean = store_clean(
            frames, settings.lake, settings.jdbc, settings.by_date, counts, unit, settings.cluster_by, settings.buckets
        )
        processed = sum(counts.values())

        kpis = compute_all(
            *(clean[t] for t in TOPICS),
            run_ts=run_ts or started,
            limit=settings.top,
            share=f"{settings.lake}/_totals",
            buckets=settings.buckets,
        )
        kpis = store_kpis(kpis, settings.lake, settings.jdbc, counts)
        stored = sum(counts.values())
    except Exception as error:
        # the log entry must not hide what went wrong
        note = f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"
        failed = run_summary(
            spark, run_id, started, _now(), "FAILED", ingested, processed, stored, 1, note
        )
        try:
            _log(failed, settings)
        except Exception as unlogged:
            error.add_note(f"the run could not be logged either: {type(unlogged).__name__}")
        raise
    summary = run_summary(
        spark, run_id, started, _now(), "SUCCESS", ingested, processed, stored
    )
    _log(summary, settings)
    return RunResult(clean, kpis, summary)


def _unit(spark: SparkSession, settings: Settings, transactions: DataFrame) -> tuple[str, DataFrame]:
    """The unit for the lake's folders, and the transactions. What these are made of stands for their own bytes.

    Rows whose dates are looked at and that no run has stored yet are written first, so that they are cleaned once.
    """
    if not settings.by_date:
        return "day", transactions
    source = settings.sources["transactions"]
    kind = "_versions" if settings.incremental else "_raw"
    landed = settings.incremental or source.kind != "parquet"
    path = f"{settings.lake}/{kind}/transactions" if landed else source.location
    size = folder_bytes(spark, path)
    if not settings.incremental and size < FOLDER_BYTES * SURE_DAYS:
        transactions = store_at(transactions, f"{settings.lake}/_clean/transactions")
    return date_unit(transactions, size), transactions


def _log(summary: DataFrame, settings: Settings) -> None:
    write_parquet(summary, f"{settings.lake}/pipeline_runs", mode="append")
    if settings.jdbc is not None:
        # not strict: a count beyond INT is left out there rather than fail the run
        row = conform_to_target(summary, "pipeline_runs")
        write_jdbc(row, "pipeline_runs", settings.jdbc)


def _now() -> datetime:
    return datetime.now(timezone.utc)
