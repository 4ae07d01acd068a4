"""Message topics made of the given tables: every row becomes a message.

The tables are clean, so dirt is added by arithmetic on the keys, which the SQL side
repeats. A topic is published once per session into the shared scratch folder, as a
broker would hold it, and every query reads it from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywell.scratch import scratch_dir
from tallywell.settings import Source
from tallywell.sources import read_messages
from tallywell.sources.messages import COMPRESSION, ZSTD_LEVEL

ISO = "yyyy-MM-dd\\'T\\'HH:mm:ss\\'Z\\'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame) -> DataFrame:
    """Use all cores where a small file comes in fewer splits; large ones stay as read."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _messages(rows: DataFrame, key: str, broken: str = "false") -> DataFrame:
    """``(key, value, event_ts)`` of rows that end in ``event_ts``."""
    fields = ", ".join(c for c in rows.columns if c not in ("event_ts", "source_key"))
    value = f"CASE WHEN {broken} THEN 'not json' ELSE to_json(struct({fields})) END"
    return rows.selectExpr(f"{key} AS key", f"{value} AS value", "event_ts")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
        )
    )
    orders = table(spark, sf_dir, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "if(l_orderkey % 107 = 0, '', concat('TXN-', l_orderkey, '-', l_linenumber)) AS transaction_id",
        """CASE WHEN l_orderkey % 97 = 0 THEN '' WHEN o_custkey % 83 = 0
           THEN concat('CLI-X', o_custkey) ELSE concat('CLI-', o_custkey) END AS client_id""",
        "concat(if(l_partkey % 89 = 0, 'PRD-X', 'PRD-'), l_partkey) AS product_id",
        "if(l_orderkey % 101 = 0, 0, int(l_quantity)) AS quantity",
        "(bigint(round(l_extendedprice * 100)) div bigint(l_quantity)) / 100D AS unit_price",
        "if(l_orderkey % 109 = 0, -1D, l_extendedprice) AS total_amount",
        "element_at(array(' usd', 'USD', 'Usd ', 'EUR', 'gbp'), int(l_orderkey % 5) + 1) AS currency",
        """element_at(array(' Credit_Card', 'PAYPAL ', 'debit_card'), int(l_orderkey % 3) + 1)
           AS payment_method""",
        """CASE o_orderstatus WHEN 'F' THEN ' Completed' WHEN 'O' THEN 'PENDING'
           ELSE 'refunded ' END AS status""",
        f"if(l_orderkey % 103 = 0, 'garbage', date_format(l_shipdate, '{ISO}')) AS transaction_time",
        "l_shipdate AS event_ts",
        "l_orderkey AS source_key",
    )
    return _messages(rows, "transaction_id", broken="source_key % 113 = 0")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = (
        customers.join(nations, customers.c_nationkey == nations.n_nationkey)
        .selectExpr("*", "explode(if(c_custkey % 10 = 0, array(0, 1), array(0))) AS v")
        .selectExpr(
            "*",
            "cast(date_add(date'2015-01-01', int(c_custkey % 1825) + v) AS timestamp_ntz) AS event_ts",
        )
        .selectExpr(
            "if(c_custkey % 61 = 0, '', concat('CLI-', c_custkey)) AS client_id",
            "lower(n_name) AS first_name",
            "upper(c_name) AS last_name",
            "if(c_custkey % 67 = 0, 'nobody', concat(' USER', c_custkey, '@Example.COM ')) AS email",
            "if(c_custkey % 73 = 0, NULL, concat(' ', n_name)) AS country",
            "concat('City ', c_nationkey, ' ') AS city",
            "int(10 + c_custkey % 115) AS age",
            "if(c_custkey % 79 = 0, NULL, if(v = 1, 'vip', concat(' ', lower(c_mktsegment)))) AS segment",
            f"if(c_custkey % 71 = 0, '', date_format(event_ts, '{ISO}')) AS registered_at",
            "event_ts",
        )
    )
    return _messages(rows, "client_id")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "part")
        .selectExpr("*", "explode(if(p_partkey % 20 = 0, array(0, 1), array(0))) AS v")
        .selectExpr(
            "if(p_partkey % 59 = 0, '', concat('PRD-', p_partkey)) AS product_id",
            "if(p_partkey % 47 = 0, NULL, concat(' ', p_name, if(v = 1, ' v2 ', ' '))) AS name",
            "if(p_partkey % 43 = 0, NULL, lower(p_type)) AS category",
            "if(p_partkey % 7 = 0, NULL, concat(' ', p_brand)) AS sub_category",
            "p_brand AS brand",
            "if(p_partkey % 53 = 0, 0D, p_retailprice) AS price",
            "if(p_partkey % 11 = 0, NULL, p_size / 8D) AS weight_kg",
            "if(p_partkey % 13 = 0, NULL, (p_partkey % 15) / 2D) AS rating",
            "int(p_partkey % 5000 - 50) AS stock",
            "cast(NULL AS timestamp_ntz) AS event_ts",
        )
    )
    return _messages(rows, "product_id")


BUILDERS = {"transactions": transactions, "clients": clients, "products": products}
_published: dict[tuple[str, str, str], Source] = {}


def topic(spark: SparkSession, sf_dir: str, name: str) -> Source:
    """The topic of that name, published on its first use in a session."""
    known = (spark.sparkContext.applicationId, sf_dir, name)
    if known not in _published:
        source = Source("parquet", scratch_dir(spark, f"topic-{name}"))
        # the time stays beside the message, for queries that publish in its order
        messages = BUILDERS[name](spark, sf_dir)
        messages.write.options(**ZSTD_LEVEL).parquet(source.location, compression=COMPRESSION["parquet"])
        _published[known] = source
    return _published[known]


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_messages(spark, topic(spark, sf_dir, name))


def timed_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The messages with the time of the row each was made of."""
    return spark.read.parquet(topic(spark, sf_dir, name).location)
