"""``spark-submit`` entry point: ``python -m tallywell --mode demo --lake DIR``.

Topics are Kafka's unless ``--topics`` names a folder of JSON-line topics; the
database is used if its password is in the environment. Modes: ``publish`` made-up
messages, ``batch`` for a whole run, ``demo`` for both, ``stream`` to keep up with
the transactions topic.
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .plans import publish_synthetic, run, start_stream
from .schemas import TOPICS
from .session import recommended_conf
from .settings import Settings, Source


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallywell", description=__doc__)
    parser.add_argument("--mode", choices=["publish", "batch", "demo", "stream"], required=True)
    parser.add_argument("--lake", required=True, help="folder for tables and KPIs")
    parser.add_argument("--topics", help="folder of JSON-line topics in place of Kafka")
    parser.add_argument("--transactions", type=int, default=500)
    parser.add_argument("--clients", type=int, default=50)
    parser.add_argument("--products", type=int, default=100)
    parser.add_argument("--until-empty", action="store_true", help="stream: stop when caught up")
    parser.add_argument("--input-bytes", type=int, default=0, help="about what is read, sizes shuffles")
    given = parser.parse_args(arguments)

    changes = {}
    if given.topics:
        changes["sources"] = {t: Source("json", f"{given.topics}/{t}") for t in TOPICS}
    settings = Settings.from_env(os.environ, given.lake, **changes)
    builder = SparkSession.builder.appName("tallywell")
    if given.input_bytes:
        builder = builder.config(map=recommended_conf(given.input_bytes))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    if given.mode in ("publish", "demo"):
        now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        publish_synthetic(
            spark, settings.sources, now, given.transactions, given.clients, given.products
        )
    if given.mode in ("batch", "demo"):
        result = run(spark, settings)
        for sample in result.samples().values():
            sample.show(truncate=False)
        result.summary.show(truncate=False)
    if given.mode == "stream":
        start_stream(spark, settings, given.until_empty).awaitTermination()


if __name__ == "__main__":
    main()
