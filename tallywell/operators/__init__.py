from .clean import (
    ENTITIES,
    clean_clients,
    clean_products,
    clean_transactions,
    valid_rows,
)
from .conform import conform_to_target
from .dedup import dedup_latest
from .distinct import client_sketches, distinct_clients, merged_sketches, relative_error
from .kpis import (
    KPI_COLUMNS,
    client_totals,
    compute_all,
    customer_segments,
    kpi_row_counts,
    product_totals,
    revenue_by_category,
    revenue_by_country,
    top_products,
)
from .quality import orphan_keys, reject_counts, stage_counts, target_violations
from .windows import windowed_kpi

__all__ = [
    "ENTITIES",
    "KPI_COLUMNS",
    "clean_clients",
    "clean_products",
    "clean_transactions",
    "client_sketches",
    "client_totals",
    "compute_all",
    "conform_to_target",
    "customer_segments",
    "dedup_latest",
    "distinct_clients",
    "kpi_row_counts",
    "merged_sketches",
    "orphan_keys",
    "product_totals",
    "reject_counts",
    "relative_error",
    "revenue_by_category",
    "revenue_by_country",
    "stage_counts",
    "target_violations",
    "top_products",
    "valid_rows",
    "windowed_kpi",
]
