"""Message schemas and relational target tables.

Messages are flat JSON objects. Timestamps travel as text and are parsed by the
cleaners. ``from_json`` never enforces nullability, so it is not stated here; the
cleaners test what must be present.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}


def _struct(fields: str) -> T.StructType:
    """``"name type, name type"``, without the session that parsing DDL would need."""
    pairs = (field.split() for field in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values: message fields and their types -----------------------------

TRANSACTION = _struct(
    "transaction_id string, client_id string, product_id string, quantity int, "
    "unit_price double, total_amount double, currency string, "
    "payment_method string, status string, transaction_time string"
)
CLIENT = _struct(
    "client_id string, first_name string, last_name string, email string, "
    "country string, city string, age int, segment string, registered_at string"
)
PRODUCT = _struct(
    "product_id string, name string, category string, sub_category string, "
    "brand string, price double, weight_kg double, rating double, stock int"
)

TOPICS = ("transactions", "clients", "products")
MESSAGE_SCHEMAS = {"transactions": TRANSACTION, "clients": CLIENT, "products": PRODUCT}


# --- relational targets -------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One target column. ``filled`` columns are set by the database itself."""

    name: str
    type: str
    required: bool = True
    max_chars: int | None = None
    filled: bool = False


@dataclass(frozen=True)
class Target:
    name: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def written(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if not f.filled)


def _field(spec: str) -> Field:
    """``"name type"``; a trailing ``?`` allows null, ``=db`` is filled there."""
    name, kind = spec.split(" ", 1)
    filled = kind.endswith("=db")
    kind = kind.removesuffix("=db").strip()
    required = not kind.endswith("?")
    kind = kind.rstrip("?")
    if kind.startswith("varchar("):
        return Field(name, "string", required, int(kind[8:-1]), filled)
    return Field(name, kind, required, None, filled)


def _target(name: str, key: str, *specs: str) -> Target:
    return Target(name, tuple(key.split(" ")), tuple(_field(s) for s in specs))


# --- fixed values: target tables, types, keys ---------------------------------

_TARGETS = (
    _target(
        "transactions", "transaction_id",
        "transaction_id varchar(64)", "client_id varchar(64)",
        "product_id varchar(64)", "quantity int", "unit_price decimal(12,2)",
        "total_amount decimal(12,2)", "currency varchar(3)",
        "payment_method varchar(32)", "status varchar(16)",
        "transaction_time timestamp", "ingested_at timestamp =db",
    ),
    _target(
        "clients", "client_id",
        "client_id varchar(64)", "first_name varchar(128)",
        "last_name varchar(128)", "email varchar(256)", "country varchar(64)",
        "city varchar(128)", "age int", "segment varchar(32)",
        "registered_at timestamp", "ingested_at timestamp =db",
    ),
    _target(
        "products", "product_id",
        "product_id varchar(64)", "name varchar(256)", "category varchar(128)",
        "sub_category varchar(128)?", "brand varchar(128)",
        "price decimal(12,2)", "weight_kg decimal(8,3)?",
        "rating decimal(3,2)?", "stock int", "ingested_at timestamp =db",
    ),
    _target(
        "kpi_revenue_by_category", "window_start window_end category",
        "window_start timestamp", "window_end timestamp",
        "category varchar(128)", "total_revenue decimal(14,2)",
        "order_count int", "avg_order_value decimal(12,2)",
        "computed_at timestamp =db",
    ),
    _target(
        "kpi_revenue_by_country", "window_start window_end country",
        "window_start timestamp", "window_end timestamp",
        "country varchar(64)", "total_revenue decimal(14,2)",
        "order_count int", "unique_clients int", "computed_at timestamp =db",
    ),
    _target(
        "kpi_top_products", "window_start window_end product_id",
        "window_start timestamp", "window_end timestamp",
        "product_id varchar(64)", "product_name varchar(256)",
        "units_sold int", "total_revenue decimal(14,2)",
        "computed_at timestamp =db",
    ),
    _target(
        "kpi_customer_segments", "window_start window_end segment",
        "window_start timestamp", "window_end timestamp",
        "segment varchar(32)", "total_revenue decimal(14,2)",
        "order_count int", "unique_clients int", "avg_spend decimal(12,2)",
        "computed_at timestamp =db",
    ),
    _target(
        "pipeline_runs", "run_id",
        "run_id varchar(64)", "start_time timestamp", "end_time timestamp?",
        "status varchar(16)", "records_ingested int?",
        "records_processed int?", "records_stored int?", "errors int?",
        "notes string?",
    ),
)
TARGETS = {t.name: t for t in _TARGETS}
KPI_NAMES = (
    "kpi_revenue_by_category",
    "kpi_revenue_by_country",
    "kpi_top_products",
    "kpi_customer_segments",
)
