"""Where messages come from and where results go, as plain arguments."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from .schemas import TOPICS


@dataclass(frozen=True)
class Source:
    """One message topic.

    ``kind`` is ``kafka`` (``location`` = bootstrap servers, ``topic`` = topic) or a
    folder: ``json`` (lines with ``key`` and ``value``), ``text`` (one bare message
    per line, no key) or ``parquet`` (columns ``key`` and ``value``). ``options`` go
    to the Spark reader or writer as they are, for example
    ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` to pace a stream or
    ``kafka.group.id`` for the consumer group.
    """

    kind: str
    location: str
    topic: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in ("kafka", "json", "text", "parquet"):
            raise ValueError(f"unknown message source kind: {self.kind}")
        if self.kind == "kafka" and not self.topic:
            raise ValueError("a kafka source needs a topic")


@dataclass(frozen=True)
class JdbcTarget:
    """A relational database; ``connections`` bounds the parallel writers."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    batch_rows: int = 10_000
    connections: int = 16


@dataclass(frozen=True)
class Settings:
    """A whole run: three sources, the lake, and (if given) the database.

    ``by_date`` partitions the lake's transactions by date, in folders of a ``date_unit`` (day, month or
    year; None: as long as their bytes ask for); ``cluster_by`` sorts their files. ``buckets`` stores dimensions and totals
    by key, so that KPIs join them without a shuffle. ``incremental`` makes a run read
    only what came since the last one. ``trigger``, ``window``,
    ``horizon`` and ``checkpoint`` are for streams.
    """

    sources: Mapping[str, Source]
    lake: str
    jdbc: JdbcTarget | None = None
    checkpoint: str | None = None
    trigger: str = "10 seconds"
    window: str = "1 day"
    horizon: str | None = None
    top: int = 20
    by_date: bool = True
    date_unit: str | None = "day"
    cluster_by: tuple[str, ...] = ()
    buckets: int | None = None
    incremental: bool = False

    def __post_init__(self):
        missing = [t for t in TOPICS if t not in self.sources]
        if missing:
            raise ValueError(f"no source for {', '.join(missing)}")

    @classmethod
    def from_env(cls, env: Mapping[str, str], lake: str, **changes) -> Settings:
        """Kafka topics and PostgreSQL named by the usual environment variables."""
        # fixed values: names and defaults of the variables
        servers = env.get("KAFKA_BOOTSTRAP", "localhost:9092")
        jdbc = None
        if "POSTGRES_PASSWORD" in env:
            jdbc = JdbcTarget(
                url=env.get("POSTGRES_URL", "jdbc:postgresql://localhost:5432/ecommerce"),
                user=env.get("POSTGRES_USER", "pipeline"),
                password=env["POSTGRES_PASSWORD"],
            )
        sources = {t: Source("kafka", servers, t) for t in TOPICS}
        return cls(**{"sources": sources, "lake": lake, "jdbc": jdbc, **changes})
