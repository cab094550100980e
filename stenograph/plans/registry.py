"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import analysis, core_problems, loading, pipeline, quality, relations, upkeep

MODULES = [core_problems, analysis, relations, quality, loading, pipeline, upkeep]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return analysis.ngram_series(spark, folder)
