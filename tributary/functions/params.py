"""Lookups into the repeated ``event_params`` key/value struct."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("string", "int", "float", "double")


def event_param(key: str, kind: str = "string", params: str = "event_params") -> Column:
    """Value of ``key`` in ``event_params`` as ``<kind>_value``, NULL if absent.

    The position of the key picks the value out of the parallel array of
    values: one scan of the keys, inside whole-stage codegen, without a
    lambda. If a key repeats, the first entry wins.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    at = F.array_position(F.col(f"{params}.key"), F.lit(key))
    return F.get(F.col(f"{params}.value.{kind}_value"), (at - 1).cast("int"))
