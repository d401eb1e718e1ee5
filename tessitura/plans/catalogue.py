"""All core queries, by module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessitura.plans import captions_q, intervals_q, manifest_q, more_q

MODULES = [intervals_q, captions_q, manifest_q, more_q]
FLAGSHIP = "q_clean_gate"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
