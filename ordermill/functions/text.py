"""Text and guard expressions used by the cleaning operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy(name: str) -> Column:
    return F.trim(F.col(name))


def tidy_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def tidy_upper(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def keep_if(name: str, condition: Column) -> Column:
    """The value where the condition holds, NULL elsewhere."""
    return F.when(condition, F.col(name))


def is_blank(name: str) -> Column:
    """NULL or empty string."""
    return F.col(name).isNull() | (F.col(name) == "")
