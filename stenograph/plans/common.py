"""What several query modules share: one row per turn, typed registers, and the SQL of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.register import typed_terms
from ..sources.tables import one_per_key, spread, table

COLUMNS = "country id_session id_int legislature legislative_session session_number date session_type intervention_order speaker_raw id_dep speaker_name sex party district dm_speech text n_words row_n".split()


def turns(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One row per ``id_int`` (the lowest ``row_n``), only the columns asked for."""
    keep = list(dict.fromkeys(["id_int", *columns]))
    rows = table(spark, folder, "interventions")
    if columns == ("*",):
        keep = [c for c in COLUMNS if c in rows.columns]
    rows = rows.select(*dict.fromkeys([*keep, "row_n"]))
    return one_per_key(spread(rows) if "text" in keep else rows, "id_int", "row_n", keep, payload="text" in keep)


def terms(spark: SparkSession, folder: str) -> DataFrame:
    return typed_terms(table(spark, folder, "deputies"))


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per sitting of the fact table: country, legislature, first date, number."""
    from pyspark.sql import functions as F

    rows = turns(spark, folder, "id_session", "country", "legislature", "session_number", "date")
    return rows.groupBy("id_session").agg(F.min("country").alias("country"), F.min("legislature").alias("legislature"), F.min("session_number").alias("session_number"), F.min("date").alias("date"))


TURNS = "t AS (SELECT DISTINCT ON (id_int) * FROM interventions WHERE id_int IS NOT NULL ORDER BY id_int, row_n)"
_DAY = "coalesce(try_strptime(trim({0}), '%Y-%m-%d'), try_strptime(trim({0}), '%d/%m/%Y'))::DATE"
TERMS = (
    "r AS (SELECT DISTINCT ON (reg_n) reg_n, country, id_dep, speaker_name, party, district, sex, legislature, "
    + ", ".join(f"{_DAY.format(c)} AS {c}" for c in ("start_date", "end_date", "recorded_on"))
    + " FROM deputies ORDER BY reg_n)"
)
SESSIONS = "s AS (SELECT id_session, min(country) AS country, min(legislature) AS legislature, min(session_number) AS session_number, min(date) AS date FROM t GROUP BY 1)"


def folded(column: str) -> str:
    return f"trim(strip_accents(lower({column})))"


def normal(column: str) -> str:
    """SQL of the double-blank normal form of a text's words."""
    return f"(' ' || array_to_string(regexp_extract_all({folded(column)}, '[\\p{{L}}\\p{{N}}]+'), '  ') || ' ')"


def uses(column: str, *patterns: str) -> str:
    return "(" + " + ".join(f"coalesce(len(regexp_extract_all({normal(column)}, '{p}')), 0)" for p in patterns) + ")"
