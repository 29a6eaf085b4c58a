"""Expressions over the ordered ``path`` array of a journey."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_string(path: str = "path", sep: str = " > ", field: str = "channel") -> Column:
    """Ordered STRING_AGG of the path channels (the array is already ordered)."""
    return F.array_join(F.col(f"{path}.{field}"), sep)


def path_string_capped(n: int, path: str = "path", sep: str = " → ", field: str = "channel") -> Column:
    """First ``n`` touches joined with an arrow (stand-alone reports)."""
    return F.array_join(F.slice(F.col(f"{path}.{field}"), 1, n), sep)
