"""The expected results, in DuckDB SQL over the same tables.

Written apart from the Spark side: no JSON, amounts in whole cents, text handled by
DuckDB's own functions.
"""

from __future__ import annotations

from tallywell.sources import synth

RUN_TS = "TIMESTAMP '2024-06-01 12:00:00'"


def _title(x: str) -> str:
    """Title case; the feed's texts are single words."""
    return f"upper(trim({x})[1]) || lower(trim({x})[2:])"


# --- messages as sent ---------------------------------------------------------

_TXN_SENT = """
txn_sent AS (
  SELECT l_orderkey % 113 = 0 AS broken, l_shipdate AS event_ts,
    CASE WHEN l_orderkey % 107 = 0 THEN ''
         ELSE 'TXN-' || l_orderkey || '-' || l_linenumber END AS transaction_id,
    CASE WHEN l_orderkey % 97 = 0 THEN ''
         WHEN o_custkey % 83 = 0 THEN 'CLI-X' || o_custkey
         ELSE 'CLI-' || o_custkey END AS client_id,
    CASE WHEN l_partkey % 89 = 0 THEN 'PRD-X' || l_partkey
         ELSE 'PRD-' || l_partkey END AS product_id,
    CASE WHEN l_orderkey % 101 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS unit_cents,
    CASE WHEN l_orderkey % 109 = 0 THEN -1.0::DOUBLE ELSE l_extendedprice END AS total_amount,
    CASE l_orderkey % 5 WHEN 0 THEN ' usd' WHEN 1 THEN 'USD' WHEN 2 THEN 'Usd '
                        WHEN 3 THEN 'EUR' ELSE 'gbp' END AS currency,
    CASE l_orderkey % 3 WHEN 0 THEN ' Credit_Card' WHEN 1 THEN 'PAYPAL '
                        ELSE 'debit_card' END AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN ' Completed' WHEN 'O' THEN 'PENDING'
                       ELSE 'refunded ' END AS status,
    CASE WHEN l_orderkey % 103 = 0 THEN 'garbage'
         ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') END AS transaction_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_CLI_SENT = """
cli_sent AS (
  SELECT
    CASE WHEN c_custkey % 61 = 0 THEN '' ELSE 'CLI-' || c_custkey END AS client_id,
    lower(n_name) AS first_name, upper(c_name) AS last_name,
    CASE WHEN c_custkey % 67 = 0 THEN 'nobody'
         ELSE ' USER' || c_custkey || '@Example.COM ' END AS email,
    CASE WHEN c_custkey % 73 <> 0 THEN ' ' || n_name END AS country, 'City ' || c_nationkey || ' ' AS city,
    CAST(10 + c_custkey % 115 AS INTEGER) AS age,
    CASE WHEN c_custkey % 79 = 0 THEN NULL WHEN v = 1 THEN 'vip' ELSE ' ' || lower(c_mktsegment) END AS segment,
    CASE WHEN c_custkey % 71 = 0 THEN ''
         ELSE strftime(TIMESTAMP '2015-01-01' + to_days(CAST(c_custkey % 1825 + v AS INTEGER)),
                       '%Y-%m-%dT%H:%M:%SZ') END AS registered_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN (VALUES (0), (1)) AS copies(v) ON v = 0 OR c_custkey % 10 = 0)"""

_PRD_SENT = """
prd_sent AS (
  SELECT
    CASE WHEN p_partkey % 59 = 0 THEN '' ELSE 'PRD-' || p_partkey END AS product_id,
    CASE WHEN p_partkey % 47 <> 0 THEN ' ' || p_name || CASE WHEN v = 1 THEN ' v2 ' ELSE ' ' END END AS name,
    CASE WHEN p_partkey % 43 <> 0 THEN lower(p_type) END AS category,
    CASE WHEN p_partkey % 7 <> 0 THEN ' ' || p_brand END AS sub_category,
    p_brand AS brand,
    CASE WHEN p_partkey % 53 = 0 THEN 0.0::DOUBLE ELSE p_retailprice END AS price,
    CASE WHEN p_partkey % 11 <> 0 THEN p_size / 8.0::DOUBLE END AS weight_kg,
    CASE WHEN p_partkey % 13 <> 0 THEN (p_partkey % 15) / 2.0::DOUBLE END AS rating,
    CAST(p_partkey % 5000 - 50 AS INTEGER) AS stock
  FROM part JOIN (VALUES (0), (1)) AS copies(v) ON v = 0 OR p_partkey % 20 = 0)"""

# --- valid and clean rows -----------------------------------------------------

_TXN_VALID = """
txn_valid AS (
  SELECT transaction_id, client_id, product_id, quantity,
    unit_cents / 100.0::DOUBLE AS unit_price,
    (quantity * unit_cents) / 100.0::DOUBLE AS total_amount,
    upper(trim(currency)) AS currency, lower(trim(payment_method)) AS payment_method,
    lower(trim(status)) AS status,
    strptime(transaction_time, '%Y-%m-%dT%H:%M:%SZ') AS transaction_time,
    quantity * unit_cents AS cents, event_ts
  FROM txn_sent
  WHERE NOT broken AND transaction_id <> '' AND client_id <> '' AND product_id <> ''
    AND quantity > 0 AND unit_cents > 0 AND total_amount > 0
    AND transaction_time <> 'garbage')"""

_TXN_CLEAN = """
txn AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_time DESC,
      product_id DESC, client_id DESC, quantity DESC, unit_price DESC) AS place
    FROM txn_valid) WHERE place = 1)"""

_CLI_VALID = f"""
cli_valid AS (
  SELECT client_id, {_title("first_name")} AS first_name, {_title("last_name")} AS last_name,
    lower(trim(email)) AS email, trim(country) AS country, trim(city) AS city, age,
    {_title("segment")} AS segment,
    strptime(registered_at, '%Y-%m-%dT%H:%M:%SZ') AS registered_at
  FROM cli_sent
  WHERE client_id <> '' AND contains(email, '@') AND age BETWEEN 13 AND 120
    AND registered_at <> '')"""

_CLI_CLEAN = """
cli AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY registered_at DESC) AS place
    FROM cli_valid) WHERE place = 1)"""

_PRD_VALID = f"""
prd_valid AS (
  SELECT product_id, trim(name) AS name, {_title("category")} AS category,
    {_title("sub_category")} AS sub_category, trim(brand) AS brand, round(price, 2) AS price,
    round(weight_kg, 3) AS weight_kg,
    CASE WHEN rating < 1 THEN 1.0 WHEN rating > 5 THEN 5.0 ELSE rating END::DOUBLE AS rating,
    stock
  FROM prd_sent WHERE product_id <> '' AND price > 0 AND stock >= 0)"""

_PRD_CLEAN = """
prd AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY name DESC) AS place
    FROM prd_valid) WHERE place = 1)"""

TXN = [_TXN_SENT, _TXN_VALID, _TXN_CLEAN]
CLI = [_CLI_SENT, _CLI_VALID, _CLI_CLEAN]
PRD = [_PRD_SENT, _PRD_VALID, _PRD_CLEAN]


def _with(ctes: list[str], body: str) -> str:
    return "WITH" + ",".join(ctes) + "\n" + body.strip()


TXN_COLUMNS = (
    "transaction_id, client_id, product_id, quantity, unit_price, total_amount, currency, "
    "payment_method, status, transaction_time"
)

# --- KPIs ---------------------------------------------------------------------

_REVENUE = "sum(cents)::DOUBLE / 100 AS total_revenue"
_COUNT = "count(*) AS order_count"
# half-up rounding of cents per order, in whole numbers
_AVG = "((2 * sum(cents) + count(*)) // (2 * count(*)))::DOUBLE / 100"

_KPI_PARTS = {
    "kpi_revenue_by_category": (
        "category", f"category, {_REVENUE}, {_COUNT}, {_AVG} AS avg_order_value",
        "txn LEFT JOIN prd USING (product_id)", PRD,
    ),
    "kpi_revenue_by_country": (
        "country", f"country, {_REVENUE}, {_COUNT}, count(DISTINCT txn.client_id) AS unique_clients",
        "txn LEFT JOIN cli USING (client_id)", CLI,
    ),
    "kpi_top_products": (
        "txn.product_id, name",
        f"txn.product_id AS product_id, name AS product_name, "
        f"sum(quantity)::BIGINT AS units_sold, {_REVENUE}",
        "txn LEFT JOIN prd USING (product_id)", PRD,
    ),
    "kpi_customer_segments": (
        "segment",
        f"segment, {_REVENUE}, {_COUNT}, count(DISTINCT txn.client_id) AS unique_clients, "
        f"{_AVG} AS avg_spend",
        "txn LEFT JOIN cli USING (client_id)", CLI,
    ),
}


def kpi(name: str) -> str:
    """One KPI over the whole table, at a fixed run time."""
    by, columns, joined, dimension = _KPI_PARTS[name]
    body = f"""
SELECT {RUN_TS} AS window_start, {RUN_TS} AS window_end, {columns}
FROM {joined} GROUP BY {by}"""
    if name == "kpi_top_products":
        body += "\nORDER BY units_sold DESC, product_id LIMIT 20"
    return _with(TXN + dimension, body)


def daily(name: str, days: int = 1) -> str:
    """One KPI per so many days of transaction time since 1970, over the clean tables."""
    _, columns, joined, _ = _KPI_PARTS[name]
    start = f"time_bucket(INTERVAL {days} DAY, transaction_time, TIMESTAMP '1970-01-01')"
    body = f"""
SELECT {start} AS window_start, {start} + INTERVAL {days} DAY AS window_end, {columns}
FROM {joined} GROUP BY ALL"""
    if name != "kpi_top_products":
        return body
    return f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start
    ORDER BY units_sold DESC, product_id) AS place FROM ({body}))
WHERE place <= 20"""


def windowed(name: str) -> str:
    return _with(TXN + _KPI_PARTS[name][3], daily(name))


def clean(topic: str) -> str:
    ctes, name, columns = {
        "transactions": (TXN, "txn", TXN_COLUMNS),
        "clients": (CLI, "cli", "*"),
        "products": (PRD, "prd", "*"),
    }[topic]
    return _with(ctes, f"SELECT {columns} FROM {name}")


def _decoded_transactions() -> str:
    fields = [f.strip() for f in TXN_COLUMNS.split(",")]
    columns = ", ".join(
        f"CASE WHEN NOT broken THEN "
        f"{'unit_cents / 100.0::DOUBLE' if f == 'unit_price' else f} END AS {f}"
        for f in fields
    )
    return _with([_TXN_SENT], f"SELECT {columns} FROM txn_sent")


_REJECTS = """
, orders_of AS (
  SELECT *, try_cast(regexp_extract(transaction_id, 'TXN-([0-9]+)-', 1) AS BIGINT) AS o FROM txn_sent),
judged AS (
  SELECT *, broken OR coalesce(o % 131 = 0, false) AS gone FROM orders_of)
SELECT 'transactions' AS entity, NULL::VARCHAR AS field, 'read' AS reason, count(*) AS row_count FROM judged
UNION ALL SELECT 'transactions', NULL, 'kept', count(*) FROM judged WHERE NOT gone
UNION ALL SELECT 'transactions', NULL, 'no object', count(*) FROM judged WHERE gone
UNION ALL SELECT 'transactions', 'quantity', 'type', count(*) FROM judged WHERE NOT gone AND o % 127 = 0
UNION ALL SELECT 'transactions', 'unit_price', 'type', count(*) FROM judged
  WHERE NOT gone AND o % 127 <> 0 AND o % 137 = 0"""

_COUNTS = """
SELECT 'transactions' AS entity, (SELECT count(*) FROM txn_sent) AS raw_rows,
  (SELECT count(*) FROM txn) AS clean_rows
UNION ALL SELECT 'clients', (SELECT count(*) FROM cli_sent), (SELECT count(*) FROM cli)
UNION ALL SELECT 'products', (SELECT count(*) FROM prd_sent), (SELECT count(*) FROM prd)"""


_FLAT = {
    "kpi_revenue_by_category": "category AS key, order_count AS number, avg_order_value AS mean, "
    "NULL::BIGINT AS clients, NULL::VARCHAR AS name",
    "kpi_revenue_by_country": "country, order_count, NULL::DOUBLE, unique_clients, NULL::VARCHAR",
    "kpi_top_products": "product_id, units_sold, NULL::DOUBLE, NULL::BIGINT, product_name",
    "kpi_customer_segments": "segment, order_count, avg_spend, unique_clients, NULL::VARCHAR",
}


def flat_kpis(orphans: str = "keep") -> str:
    """All four KPIs under one another, with all their columns."""
    parts = []
    for name, shown in _FLAT.items():
        by, columns, joined, _ = _KPI_PARTS[name]
        if orphans == "drop":
            joined = joined.replace("LEFT JOIN", "JOIN")
        if orphans == "label":
            # a known product or client keeps its null
            for table, key, attributes in (
                ("prd", "product_id", ("category", "name")), ("cli", "client_id", ("country", "segment")),
            ):
                named = ", ".join(
                    f"CASE WHEN {table}.{key} IS NULL THEN 'Unknown' ELSE {a} END AS {a}" for a in attributes
                )
                if table in joined:
                    joined = f"(SELECT txn.*, {named} FROM txn LEFT JOIN {table} USING ({key})) AS txn"
        top = "ORDER BY units_sold DESC, product_id LIMIT 20" if "top" in name else ""
        parts.append(
            f"SELECT '{name}' AS kpi, {RUN_TS} AS window_start, {RUN_TS} AS window_end, "
            f"total_revenue, {shown} "
            f"FROM (SELECT {columns} FROM {joined} GROUP BY {by} {top})"
        )
    return "\nUNION ALL ".join(parts)


_STORED = """
kpi_rows AS (
  SELECT 'kpis/kpi_revenue_by_category' AS folder, count(*) AS n
  FROM (SELECT DISTINCT category FROM txn LEFT JOIN prd USING (product_id))
  UNION ALL SELECT 'kpis/kpi_revenue_by_country', count(*)
  FROM (SELECT DISTINCT country FROM txn LEFT JOIN cli USING (client_id))
  UNION ALL SELECT 'kpis/kpi_top_products', least(20, count(DISTINCT product_id)) FROM txn
  UNION ALL SELECT 'kpis/kpi_customer_segments', count(*)
  FROM (SELECT DISTINCT segment FROM txn LEFT JOIN cli USING (client_id))),
clean_rows AS (
  SELECT 'transactions' AS folder, count(*) AS n FROM txn
  UNION ALL SELECT 'clients', count(*) FROM cli
  UNION ALL SELECT 'products', count(*) FROM prd)"""

# --- target rules -------------------------------------------------------------


def _violations(table: str, source: str, key: str, rules: list[tuple[str, str, str]]) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS \"column\", '{r}' AS rule, "
        f"count(*) AS row_count FROM {source} WHERE {test}"
        for c, r, test in rules
    ]
    parts.append(
        f"SELECT '{table}', '{key}', 'duplicate_key', count(*) - count(DISTINCT {key}) "
        f"FROM {source} WHERE {key} IS NOT NULL"
    )
    return "\nUNION ALL ".join(parts)


def target_violations() -> str:
    """The rules the messages can break; the driver's tables break no other."""
    fields = [f.strip() for f in TXN_COLUMNS.split(",")]
    txn = [(f, "null", "broken") for f in fields]
    txn += [
        ("currency", "length", "NOT broken AND length(currency) > 3"),
        ("transaction_time", "type", "NOT broken AND transaction_time = 'garbage'"),
    ]
    sent = "(SELECT * REPLACE (CASE WHEN NOT broken THEN transaction_id END AS transaction_id) FROM txn_sent)"
    parts = [
        _violations("transactions", sent, "transaction_id", txn),
        _violations("clients", "cli_sent", "client_id", [
            ("registered_at", "type", "registered_at = ''"), ("country", "null", "country IS NULL"), ("segment", "null", "segment IS NULL"),
        ]),
        _violations("products", "prd_sent", "product_id", [("name", "null", "name IS NULL"), ("category", "null", "category IS NULL")]),
        """SELECT 'kpi_revenue_by_category', 'category', 'null', count(*) FROM (
  SELECT DISTINCT category FROM txn LEFT JOIN prd USING (product_id)) WHERE category IS NULL""",
    ]
    union = "\nUNION ALL ".join(parts)
    return _with(TXN + PRD + [_CLI_SENT], f"SELECT * FROM ({union}) WHERE row_count > 0")


# --- synthetic rows -----------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _noise(n: str, salt: int, seed: int = 0) -> str:
    p = synth.PRIME
    shift = (seed * synth.STEP_C + salt * 1_000_003) % p
    first = f"(({n} % {p} * {synth.STEP_A} + {n} // {p} * {synth.STEP_C} + {shift}) % {p})"
    return f"(({first} * {first} + {salt}) % {p} * {synth.STEP_B} % {p})"


def _between(n: str, salt: int, bounds: tuple[int, int]) -> str:
    low, high = bounds
    return f"({_noise(n, salt)} % {high - low + 1} + {low})"


def _pick(n: str, salt: int, values) -> str:
    return f"{_list(values)}[{_noise(n, salt)} % {len(values)} + 1]"


def _hex_id(prefix: str, n: str) -> str:
    return f"'{prefix}' || lpad(lower(to_hex({n})), greatest(8, length(to_hex({n})))::INTEGER, '0')"


def _before(seconds: str) -> str:
    return (
        f"strftime(TIMESTAMP '2024-06-01 12:00:00' - to_seconds({seconds}), '%Y-%m-%dT%H:%M:%SZ')"
    )


def synth_clients() -> str:
    n = "c_custkey"
    countries = tuple(synth.CITIES)
    place = f"({_noise(n, 4)} % {len(countries)} + 1)"
    cities = "[" + ", ".join(_list(c) for c in synth.CITIES.values()) + "]"
    return f"""
SELECT {_hex_id("CLI-", n)} AS client_id, first_name, last_name,
  lower(first_name || '.' || last_name || mail) || '@example.com' AS email, country,
  local[city % len(local) + 1] AS city, age, segment, {_before("days * 86400")} AS registered_at
FROM (SELECT {n}, {_pick(n, 1, synth.FIRST_NAMES)} AS first_name,
  {_pick(n, 2, synth.LAST_NAMES)} AS last_name, {_between(n, 3, synth.MAIL_NUMBER)} AS mail,
  {_list(countries)}[{place}] AS country, {cities}[{place}] AS local, {_noise(n, 5)} AS city,
  {_between(n, 6, synth.AGES)}::INTEGER AS age, {_pick(n, 7, synth.SEGMENTS)} AS segment,
  {_between(n, 8, synth.REGISTERED_DAYS)} AS days FROM customer)""".strip()


def synth_products() -> str:
    n = "p_partkey"
    names = tuple(synth.SUB_CATEGORIES)
    kind = f"({_noise(n, 1)} % {len(names)} + 1)"
    subs = "[" + ", ".join(_list(c) for c in synth.SUB_CATEGORIES.values()) + "]"
    low, high = ([synth.PRICES[c][i] * 100 for c in names] for i in (0, 1))
    return f"""
SELECT {_hex_id("PRD-", n)} AS product_id, brand || ' ' || sub_category || ' ' || number AS name,
  category, sub_category, brand, (low + dear % (high - low + 1)) / 100.0::DOUBLE AS price,
  weight_kg, rating, stock
FROM (SELECT {n}, {_list(names)}[{kind}] AS category, {subs}[{kind}][{_noise(n, 2)} % 5 + 1] AS sub_category,
  {_pick(n, 3, synth.BRANDS)} AS brand, {_between(n, 4, synth.NAME_NUMBER)} AS number,
  {low}[{kind}] AS low, {high}[{kind}] AS high, {_noise(n, 5)} AS dear,
  {_between(n, 6, synth.WEIGHT_CENTS)} / 100.0::DOUBLE AS weight_kg,
  {_between(n, 7, synth.RATING_CENTS)} / 100.0::DOUBLE AS rating,
  {_between(n, 8, synth.STOCK)}::INTEGER AS stock FROM part)""".strip()


def synth_transactions() -> str:
    n = "n"
    p = synth.PRIME
    client = f"(({_noise(n, 1)} * {p} + {_noise(n, 2)}) % (SELECT count(*) FROM customer))"
    product = f"(({_noise(n, 3)} * {p} + {_noise(n, 4)}) % (SELECT count(*) FROM part))"
    return f"""
SELECT {_hex_id("TXN-", n)} AS transaction_id, {_hex_id("CLI-", "client")} AS client_id,
  {_hex_id("PRD-", "product")} AS product_id, quantity, cents / 100.0::DOUBLE AS unit_price,
  cents * quantity / 100.0::DOUBLE AS total_amount, currency, payment_method, status,
  {_before("seconds")} AS transaction_time
FROM (SELECT n, {client} AS client, {product} AS product,
  {_between(n, 5, synth.QUANTITY)}::INTEGER AS quantity,
  {_between(n, 6, synth.UNIT_PRICE_CENTS)} AS cents, {_pick(n, 7, synth.CURRENCIES)} AS currency,
  {_pick(n, 8, synth.PAYMENT_METHODS)} AS payment_method, {_pick(n, 9, synth.STATUSES)} AS status,
  {_between(n, 10, synth.RECENT_SECONDS)} AS seconds
  FROM (SELECT l_orderkey * 10 + l_linenumber AS n FROM lineitem))""".strip()


# --- streams ------------------------------------------------------------------


def late_rows() -> str:
    """What is left of the category KPI when late rows behind the watermark are lost.

    The first two thirds of the time span arrive in order. The rest arrives last, and
    with it the late rows of the whole span; by then the watermark stands thirty
    days before the latest time seen. A copy check comes first in that query, so a
    row is lost when its own time is not after the watermark, or its window ended.
    """
    _, columns, joined, dimension = _KPI_PARTS["kpi_revenue_by_category"]
    arrivals = """
span AS (
  SELECT min(l_shipdate) AS low, date_diff('day', min(l_shipdate), max(l_shipdate)) // 3 + 1 AS days
  FROM lineitem),
arrived AS (
  SELECT txn.*, CASE WHEN quantity % 7 = 0 THEN 2
    ELSE date_diff('day', low, transaction_time) // days END AS slice
  FROM txn, span),
mark AS (SELECT max(transaction_time) - INTERVAL 30 DAY AS mark FROM arrived WHERE slice < 2),
kept AS (SELECT arrived.* FROM arrived, mark WHERE slice < 2 OR transaction_time > mark)"""
    body = f"""
SELECT date_trunc('day', transaction_time)::TIMESTAMP AS window_start,
  date_trunc('day', transaction_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end, {columns}
FROM {joined.replace("txn", "kept")} GROUP BY ALL"""
    return _with(TXN + dimension + [arrivals], _closed(body, 30))


def paced(slices: int = 5) -> str:
    """What each batch of a run takes in and closes that gets one part of the time span a batch.

    A batch closes the windows that end by the watermark: a day before the latest time of the batches before it.
    """
    batches = f"""
span AS (
  SELECT min(l_shipdate) AS low, date_diff('day', min(l_shipdate), max(l_shipdate)) // {slices} + 1 AS days
  FROM lineitem),
arrived AS (SELECT txn.*, date_diff('day', low, transaction_time) // days AS slice FROM txn, span),
marks AS (
  SELECT b, (SELECT max(transaction_time) FROM arrived WHERE slice < b) - INTERVAL 1 DAY AS mark,
    (SELECT max(transaction_time) FROM arrived WHERE slice < b - 1) - INTERVAL 1 DAY AS before
  FROM range({slices + 1}) r(b)),
ends AS (
  SELECT date_trunc('day', transaction_time) + INTERVAL 1 DAY AS ended, count(*) AS n FROM txn GROUP BY 1),
closed AS (
  SELECT b, count(*) AS windows, sum(n)::BIGINT AS n
  FROM ends JOIN marks ON ended <= mark AND (before IS NULL OR ended > before) GROUP BY b)"""
    return _with(
        [*TXN, batches],
        """
SELECT b AS batch_id, (SELECT count(*) FROM arrived WHERE slice = b) AS rows_in,
  coalesce(windows, 0) AS windows_closed, coalesce(n, 0) AS rows_closed
FROM marks LEFT JOIN closed USING (b)
WHERE b < (SELECT max(b) FROM marks) OR windows IS NOT NULL""",
    )


def _closed(windows: str, days: int) -> str:
    """Windows that end by the last watermark, ``days`` before the latest time; the stream keeps the open ones back."""
    return f"""
SELECT * FROM ({windows})
WHERE window_end <= (SELECT max(transaction_time) FROM txn) - INTERVAL {days} DAY"""


def flat_windows(days: int = 1) -> str:
    """All four windowed KPIs under one another, with all their columns."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS kpi, window_start, window_end, total_revenue, {shown} FROM ({daily(name, days)})"
        for name, shown in _FLAT.items()
    )


def _row(columns: str, doubles: str) -> str:
    """A row as text, doubles in thousandths."""
    shown = [
        f"CAST(round({c} * 1000) AS BIGINT)" if c in doubles.split() else c for c in columns.split(", ")
    ]
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in shown)


def queries() -> dict[str, str]:
    sql = {
        "src_messages": _with(
            [_TXN_SENT, _CLI_SENT, _PRD_SENT],
            """
SELECT 'transactions' AS entity, 'json' AS kind, count(*) AS messages, count(*) AS keyed
FROM txn_sent
UNION ALL SELECT 'clients', 'text', count(*), 0 FROM cli_sent
UNION ALL SELECT 'products', 'parquet', count(*), count(*) FROM prd_sent""",
        ),
        "decode_transactions": _decoded_transactions(),
        "decode_clients": _with([_CLI_SENT], "SELECT * FROM cli_sent"),
        "decode_products": _with([_PRD_SENT], "SELECT * FROM prd_sent"),
        "encode_roundtrip": clean("transactions"),
        "dedup_latest": clean("transactions"),
        "run_counts": _with(TXN + CLI + PRD, _COUNTS),
    }
    for topic in ("transactions", "clients", "products"):
        sql[f"clean_{topic}"] = clean(topic)
    for name in _KPI_PARTS:
        sql[name] = kpi(name)
        sql[name.replace("kpi_", "win_")] = windowed(name)
    sql["kpi_row_counts"] = _with(
        TXN + CLI + PRD,
        """
SELECT 'kpi_revenue_by_category' AS kpi, count(*) AS row_count FROM (
  SELECT DISTINCT category FROM txn LEFT JOIN prd USING (product_id))
UNION ALL SELECT 'kpi_revenue_by_country', count(*) FROM (
  SELECT DISTINCT country FROM txn LEFT JOIN cli USING (client_id))
UNION ALL SELECT 'kpi_top_products', least(20, count(DISTINCT product_id)) FROM txn
UNION ALL SELECT 'kpi_customer_segments', count(*) FROM (
  SELECT DISTINCT segment FROM txn LEFT JOIN cli USING (client_id))""",
    )
    sql["parquet_roundtrip"] = clean("transactions")
    sql["parquet_partition_pruned"] = _with(
        TXN,
        """
SELECT status, count(*) AS order_count, sum(quantity)::BIGINT AS units FROM txn
WHERE year(transaction_time) = 1998 GROUP BY status""",
    )
    sql["lake_clients_in_month"] = _with(
        TXN + CLI,
        """
SELECT client_id, count(*) AS order_count, sum(quantity)::BIGINT AS units FROM txn
WHERE transaction_time::DATE BETWEEN DATE '1996-02-10' AND DATE '1996-03-09'
  AND client_id IN (SELECT client_id FROM cli WHERE age BETWEEN 30 AND 39) GROUP BY client_id""",
    )
    money = "CAST(CAST({0} AS DECIMAL(12,2)) AS VARCHAR) AS {0}"
    shaped = TXN_COLUMNS
    for column in ("unit_price", "total_amount"):
        shaped = shaped.replace(column, money.format(column))
    sql["target_conform"] = _with(TXN, f"SELECT {shaped} FROM txn")
    sql["target_violations"] = target_violations()
    sql["orphan_keys"] = _with(
        TXN + PRD,
        """
SELECT product_id, count(*) AS row_count FROM txn
WHERE product_id NOT IN (SELECT product_id FROM prd) GROUP BY product_id""",
    )
    cli = "client_id, first_name, last_name, email, country, city, age, segment, registered_at"
    prd = "product_id, name, category, sub_category, brand, price, weight_kg, rating, stock"
    sql["store_clean"] = _with(
        TXN + CLI + PRD,
        f"""
SELECT 'transactions' AS entity, {_row(TXN_COLUMNS, "unit_price total_amount")} AS row FROM txn
UNION ALL SELECT 'clients', {_row(cli, "")} FROM cli
UNION ALL SELECT 'products', {_row(prd, "price weight_kg rating")} FROM prd""",
    )
    for what in ("drop", "label"):
        sql[f"kpi_orphans_{what}"] = _with(TXN + CLI + PRD, flat_kpis(what))
    sql["store_kpis"] = sql["end_to_end"] = sql["kpi_bucketed"] = _with(TXN + CLI + PRD, flat_kpis())
    sql["sink_audit"] = _with(
        TXN + CLI + PRD + [_STORED],
        """
SELECT folder, n AS row_count, true AS has_files FROM (
  SELECT * FROM kpi_rows UNION ALL SELECT * FROM clean_rows UNION ALL SELECT 'pipeline_runs', 1)""",
    )
    sql["run_summary"] = _with(
        TXN + CLI + PRD + [_STORED],
        """
SELECT 'SUCCESS' AS status, (SELECT count(*) FROM txn_sent) + (SELECT count(*) FROM cli_sent)
    + (SELECT count(*) FROM prd_sent) AS records_ingested,
  (SELECT sum(n)::BIGINT FROM clean_rows) AS records_processed,
  (SELECT sum(n)::BIGINT FROM clean_rows) + (SELECT sum(n)::BIGINT FROM kpi_rows) AS records_stored,
  0::BIGINT AS errors""",
    )
    sql["synth_clients"] = synth_clients()
    sql["synth_products"] = synth_products()
    sql["synth_transactions"] = synth_transactions()
    sql["stream_clean_transactions"] = _with(
        [_TXN_SENT, _TXN_VALID], f"SELECT {TXN_COLUMNS} FROM txn_valid"
    )
    sql["stream_dedup"] = _with(
        [_TXN_SENT, _TXN_VALID],
        """
SELECT DISTINCT transaction_id, 1::BIGINT AS row_count, 1::BIGINT AS rows_as_sent FROM txn_valid""",
    )
    for name in _KPI_PARTS:
        sql[name.replace("kpi_", "stream_win_")] = _with(
            TXN + _KPI_PARTS[name][3], _closed(daily(name), 1)
        )
    sql["decode_rejects"] = _with([_TXN_SENT], _REJECTS)
    sql["distinct_clients_merged"] = _with(
        TXN,
        """
SELECT date_trunc('quarter', transaction_time)::TIMESTAMP AS period, count(DISTINCT client_id) AS exact_clients,
  count(*) AS orders, true AS within_bound
FROM txn GROUP BY 1""",
    )
    halves = """
halves AS (
  SELECT min(l_shipdate) AS low, date_diff('day', min(l_shipdate), max(l_shipdate)) // 2 + 1 AS days
  FROM lineitem),
taken AS (
  SELECT date_diff('day', low, event_ts) // days AS slice, count(*) AS n FROM txn_sent, halves GROUP BY 1)"""
    sql["incremental_run"] = _with(
        [*TXN, *CLI, *PRD, halves],
        f"""
SELECT * FROM ({flat_kpis()})
UNION ALL BY NAME SELECT 'run 1' AS kpi, n + (SELECT count(*) FROM cli_sent) + (SELECT count(*) FROM prd_sent) AS number
FROM taken WHERE slice = 0
UNION ALL BY NAME SELECT 'run 2' AS kpi, n AS number FROM taken WHERE slice = 1""",
    )
    sql["stream_paced"] = paced()
    sql["stream_dedup_latest"] = clean("transactions")
    sql["stream_late_rows"] = late_rows()
    sql["stream_foreach_batch"] = _with(TXN + CLI + PRD, flat_windows())
    sql["stream_horizon"] = _with(TXN + CLI + PRD, flat_windows(28))
    return sql
