from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TARGETS


def fit(name: str, kind: str) -> Column:
    """The column in the target's type, null where its value has no place there."""
    return F.col(name).try_cast(kind)


def conform_to_target(df: DataFrame, table: str, strict: bool = False) -> DataFrame:
    """The columns of a target table, in its order and types.

    Decimals are rounded half up to the target's scale. A value out of the type's
    range becomes null, or with ``strict`` fails the job, as the database would.
    Columns the database fills itself are left out.
    """
    columns = []
    for field in TARGETS[table].written:
        value = F.col(field.name).cast(field.type) if strict else fit(field.name, field.type)
        columns.append(value.alias(field.name))
    return df.select(*columns)
