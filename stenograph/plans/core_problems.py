"""Queries of the general training-data problems, with the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import attributes_as_of, flexible_date, same_label
from ..sources.tables import one_per_key, table


def register_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The register as typed changes, one row per ``reg_n``."""
    raw = one_per_key(table(spark, folder, "deputies"), "reg_n", "reg_n", ["reg_n", "id_dep", "party", "district", "start_date", "end_date", "recorded_on"])
    return raw.select(
        "reg_n",
        "id_dep",
        "party",
        "district",
        *[flexible_date(F.col(c)).alias(c) for c in ("start_date", "end_date", "recorded_on")],
    )


def p7_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Every intervention with ``id_dep`` and date, with the party and district known on its day."""
    events = table(spark, folder, "interventions").select("id_int", "row_n", "id_dep", "date", "party", "district").where(F.col("id_dep").isNotNull() & F.col("date").isNotNull())
    return attributes_as_of(
        events,
        register_changes(spark, folder),
        event_entity=["id_dep"],
        event_date="date",
        change_entity=["id_dep"],
        valid_from="start_date",
        valid_to="end_date",
        known_from="recorded_on",
        priority=["recorded_on", "start_date", "reg_n"],
        attributes=["reg_n", "party", "district"],
    )


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose stored party or district isn't what was on record for their date."""
    joined = p7_as_of(spark, folder).where(F.col("known_reg_n").isNotNull())
    differs = lambda c: (F.trim(F.coalesce(F.col(c), F.lit(""))) != "") & ~same_label(F.col(c), F.col(f"known_{c}"))
    return joined.where(differs("party") | differs("district")).select("id_int", F.col("known_reg_n").alias("reg_n")).distinct()


P7_SQL = """
WITH reg AS (
  SELECT DISTINCT reg_n, id_dep, party, district,
    coalesce(try_strptime(trim(start_date), '%Y-%m-%d'), try_strptime(trim(start_date), '%d/%m/%Y'))::DATE AS s,
    coalesce(try_strptime(trim(end_date), '%Y-%m-%d'), try_strptime(trim(end_date), '%d/%m/%Y'))::DATE AS e,
    coalesce(try_strptime(trim(recorded_on), '%Y-%m-%d'), try_strptime(trim(recorded_on), '%d/%m/%Y'))::DATE AS r
  FROM deputies),
ev AS (
  SELECT DISTINCT id_int, id_dep, date, party, district FROM interventions
  WHERE id_dep IS NOT NULL AND date IS NOT NULL),
best AS (
  SELECT ev.*, reg.reg_n, reg.party AS kp, reg.district AS kd,
    row_number() OVER (PARTITION BY ev.id_int ORDER BY reg.r DESC, reg.s DESC, reg.reg_n DESC) AS k
  FROM ev JOIN reg ON ev.id_dep = reg.id_dep AND reg.s <= ev.date AND (reg.e IS NULL OR ev.date <= reg.e) AND reg.r <= ev.date)
"""
_CLEAN = "lower(trim(replace(coalesce({}, ''), '.', '')))"
P7_FOUND_SQL = P7_SQL + f"""
SELECT id_int, reg_n FROM best WHERE k = 1 AND (
  (trim(coalesce(party, '')) <> '' AND {_CLEAN.format('party')} <> {_CLEAN.format('kp')})
  OR (trim(coalesce(district, '')) <> '' AND {_CLEAN.format('district')} <> {_CLEAN.format('kd')}))
"""

QUERIES = {"p7_found": p7_found}
SQL = {"p7_found": P7_FOUND_SQL}
