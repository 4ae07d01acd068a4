"""Text normalization. ``trim`` takes off blanks only, never tabs or newlines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_text(name: str) -> Column:
    """Present and not empty. A text of blanks counts as present."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def upper_text(name: str) -> Column:
    return F.upper(F.trim(name))


def lower_text(name: str) -> Column:
    return F.lower(F.trim(name))


def title_text(name: str) -> Column:
    """First letter of each blank-separated word upper case, the rest lower."""
    return F.initcap(F.trim(name))
