"""Queries that write and read back: CSV import, partition replacement, incremental index, exported subsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import event_window as in_window
from ..functions.terms import Selection, at_most_words, having, speeches, within
from ..operators import libraries as L
from ..operators import register as R
from ..operators.texts import quote_status
from ..session import scratch_path
from ..sources import corpus as C
from ..sources.tables import table
from ..streaming.arrivals import words_by_window
from .common import TURNS, folded, turns, uses


def csv_import(spark, d):
    """All turns through CSV (quoted, multi-line) and the canonical projection again."""
    path = scratch_path(spark, "csv")
    turns(spark, d, "*").select(*C.CANONICAL).write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return C.canonical(C.read_csv(spark, path, ","), "XX").select("id_int", "date", "intervention_order", "dm_speech", "n_words")


def replace_partition(spark, d):
    """Import all countries, then replace one by its speech rows; the others stay."""
    path = scratch_path(spark, "partitions")
    rows = turns(spark, d, "country", "dm_speech")
    C.import_country(rows, path)
    C.import_country(rows.where("country = 'PT' AND dm_speech = 1"), path)
    return spark.read.parquet(path).groupBy("country").agg(F.count("*").alias("n"))


def subset_export(spark, d):
    """A subset written as JSON by country with its index, read back with its checksums."""
    rows = turns(spark, d, "country", "date", "dm_speech", "speaker_raw", "text")
    path = scratch_path(spark, "subset")
    L.export(L.create(rows, ["hospital"], Selection(speeches())).select("id_int"), rows, path, {"terms": ["hospital"]})
    return L.load(spark, path).select("id_int", "country")


def alias_columns(spark, d):
    """The fullest of several alias columns becomes the canonical one."""
    raw = turns(spark, d, "speaker_name", "speaker_raw", "district").withColumnsRenamed({"speaker_name": "orador", "speaker_raw": "interviniente"})
    out = C.resolve_aliases(raw, {"speaker_raw": ["orador", "interviniente"], "region": ["provincia", "district"]})
    return out.select("id_int", "speaker_raw", "region")


def override_by_session(spark, d):
    """Ids of one sitting's typed speakers overridden by a table, manual matches kept."""
    rows = turns(spark, d, "id_session", "speaker_raw", "id_dep").withColumn("match_method", F.when(F.md5("id_int") < "4", "manual").otherwise("table"))
    o = rows.where("id_dep IS NOT NULL AND speaker_raw IS NOT NULL").groupBy("id_session", "speaker_raw").agg(F.max("id_dep").alias("id_dep")).where(F.md5("speaker_raw") < "8")
    return R.override_ids(rows, o, ["id_session", "speaker_raw"]).select("id_int", "id_dep")


def numbered_rows(spark, d):
    """All rows of the table numbered in reading order, copies included."""
    return C.number_rows(table(spark, d, "interventions").select("id_int"))


def removed_country(spark, d):
    path = scratch_path(spark, "removed")
    C.import_country(turns(spark, d, "country", "n_words"), path)
    C.remove_country(spark, path, "PT")
    return spark.read.parquet(path).groupBy("country").agg(F.count("*").alias("n"), F.sum("n_words").cast("bigint").alias("words"))


def subset_members(spark, d):
    """Short speeches of two parties among the members of a subset."""
    rows = turns(spark, d, "country", "date", "dm_speech", "party", "n_words", "text")
    members = L.create(rows, ["hospital"], Selection(speeches()))
    return Selection(speeches(), at_most_words(150), having("party", "GUCU", "QOCI"), within(members)).apply(rows).select("id_int", "party", "n_words")


def subset_edited(spark, d):
    """A subset after some turns are removed and others added; what was removed doesn't come back."""
    rows = turns(spark, d, "country", "date", "dm_speech", "text")
    items, none = L.create(rows, ["hospital"], Selection(speeches())).select("id_int"), rows.limit(0).select("id_int")
    kept, excluded = L.remove(items, none, items.where(F.md5("id_int") < "4"))
    return L.add(kept, rows.where(F.md5("id_int") < "6").select("id_int"), excluded)


def event_turns(spark, d):
    """Turns from 30 days before an event to 60 days behind it, by country."""
    rows = turns(spark, d, "country", "date")
    return rows.where(in_window(F.col("date"), "2015-06-15", 30, 60)).groupBy("country").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))


def quotes(spark, d):
    return turns(spark, d, "text").select(quote_status(F.lit("la verdad  es que"), F.col("text")).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def daily_words(spark, d):
    """The windowed counts of the stream, over all dated turns at once."""
    rows = turns(spark, d, "country", "date", "text").withColumn("opened_at", F.col("date").cast("timestamp"))
    return words_by_window(rows).select(F.to_date("start").alias("day"), "country", "turns", "words")


QUERIES = {q.__name__: q for q in (csv_import, replace_partition, subset_export, alias_columns, override_by_session, numbered_rows, removed_country, subset_members, subset_edited, event_turns, quotes, daily_words)}
SQL = {
    "numbered_rows": "SELECT id_int, row_number() OVER () AS row_n FROM interventions",
    "removed_country": f"WITH {TURNS} SELECT country, count(*) AS n, sum(n_words)::BIGINT AS words FROM t WHERE country <> 'PT' GROUP BY 1",
    "subset_members": f"WITH {TURNS} SELECT id_int, party, n_words FROM t WHERE dm_speech = 1 AND n_words <= 150 AND party IN ('GUCU', 'QOCI') AND {uses('text', ' hospital ')} > 0",
    "subset_edited": f"WITH {TURNS}, k AS (SELECT id_int FROM t WHERE dm_speech = 1 AND {uses('text', ' hospital ')} > 0) SELECT id_int FROM k WHERE md5(id_int) >= '4' UNION SELECT id_int FROM t WHERE md5(id_int) < '6' AND id_int NOT IN (SELECT id_int FROM k WHERE md5(id_int) < '4')",
    "event_turns": f"WITH {TURNS} SELECT country, count(*) AS n, min(date) AS a, max(date) AS b FROM t WHERE date BETWEEN DATE '2015-06-15' - 30 AND DATE '2015-06-15' + 60 GROUP BY 1",
    "quotes": f"WITH {TURNS}, k AS (SELECT trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS a, trim(regexp_replace({folded('text')}, '\\s+', ' ', 'g'), ' ') AS b FROM t) SELECT CASE WHEN contains(a, 'la verdad es que') THEN 'verbatim' WHEN contains(b, 'la verdad es que') THEN 'differs' ELSE 'missing' END AS status, count(*) AS n FROM k GROUP BY 1",
    "daily_words": f"WITH {TURNS} SELECT date AS day, country, count(*) AS turns, sum(coalesce(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')), 0))::BIGINT AS words FROM t WHERE date IS NOT NULL GROUP BY 1, 2",
    "csv_import": f"WITH {TURNS} SELECT id_int, date, intervention_order, dm_speech, coalesce(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')), 0)::INT AS n_words FROM t",
    "replace_partition": f"WITH {TURNS} SELECT country, count(*) AS n FROM t WHERE country <> 'PT' OR dm_speech = 1 GROUP BY 1",
    "subset_export": f"WITH {TURNS} SELECT id_int, country FROM t WHERE dm_speech = 1 AND {uses('text', ' hospital ')} > 0",
    "alias_columns": f"WITH {TURNS} SELECT id_int, speaker_raw, district AS region FROM t",
    "override_by_session": f"WITH {TURNS}, o AS (SELECT id_session, speaker_raw, max(id_dep) AS o FROM t WHERE id_dep IS NOT NULL AND md5(speaker_raw) < '8' GROUP BY 1, 2) SELECT id_int, CASE WHEN o IS NOT NULL AND md5(id_int) >= '4' THEN o ELSE id_dep END AS id_dep FROM t LEFT JOIN o USING (id_session, speaker_raw)",
}
