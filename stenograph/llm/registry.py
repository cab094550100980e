"""All queries of the training-text operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import counts, distinctive, mixture, names, pairs, scans, sentences, tokens, turns

MODULES = [turns, names, distinctive, scans, pairs, counts, tokens, mixture, sentences]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
