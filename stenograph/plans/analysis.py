"""Queries of counting and comparing, over all turns, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.terms import CHAIR, NOT_CHAIR, Selection, at_most_words, is_chair, not_chairing, since, speeches, until
from ..operators import analysis as A
from ..sources import corpus as C
from ..sources.tables import spread, table
from .common import TERMS, TURNS, terms, turns, uses

SPEECH = Selection(speeches())
PEOPLE = Selection(speeches(), not_chairing(), at_most_words())


def ngram_series(spark, d):
    return A.ngram_series(spread(table(spark, d, "interventions")), "presupuesto + orçamento, adjudic*, agua potable", SPEECH, version="row_n")


_SERIES = [("presupuesto + orçamento", [" presupuesto ", " orcamento "]), ("adjudic*", [r" adjudic[\p{L}\p{N}]* "]), ("agua potable", [" agua  potable "])]
_NGRAM_SQL = f"""WITH {TURNS},
k AS (SELECT year(date)::INT AS year, id_session, n_words, {', '.join(f"{uses('text', *p)} AS s{i}" for i, (_, p) in enumerate(_SERIES))} FROM t WHERE dm_speech = 1 AND date IS NOT NULL),
y AS (SELECT year, sum(n_words)::BIGINT AS words, count(*) AS turns, count(DISTINCT id_session) AS sessions, {', '.join(f'sum(s{i})::BIGINT AS c{i}' for i in range(3))} FROM k GROUP BY 1),
spine AS (SELECT unnest(range(min(year), max(year) + 1))::INT AS year FROM y),
f AS (SELECT * FROM spine LEFT JOIN y USING (year))
""" + " UNION ALL ".join(
    f"SELECT '{label}' AS series, year, c{i} AS count, CASE WHEN words > 0 THEN round(c{i} * 1e6 / words, 3) END AS value, words, turns, sessions, coalesce(words < 250000 OR sessions < 10, true) AS low_base FROM f"
    for i, (label, _) in enumerate(_SERIES)
)


def ngram_smoothed(spark, d):
    rows = spread(table(spark, d, "interventions"))
    return A.ngram_series(rows, "hospital", SPEECH, by_country=True, measure="interventions_pct", smoothing=1, version="row_n").select("series", "country", "year", "count", "value", "turns")


_SMOOTH_SQL = f"""WITH {TURNS},
k AS (SELECT country, year(date)::INT AS year, {uses('text', ' hospital ')} AS s FROM t WHERE dm_speech = 1 AND date IS NOT NULL),
y AS (SELECT country, year, count(*) AS turns, sum(s)::BIGINT AS count, count(*) FILTER (s > 0) AS users FROM k GROUP BY 1, 2),
spine AS (SELECT country, unnest(range(min(year), max(year) + 1))::INT AS year FROM y GROUP BY 1),
f AS (SELECT spine.country, spine.year, turns, count, users * 100.0::DOUBLE / turns AS v FROM spine LEFT JOIN y ON spine.country = y.country AND spine.year = y.year)
SELECT 'hospital' AS series, country, year, count, round(CASE WHEN v IS NOT NULL THEN avg(v) OVER (PARTITION BY country ORDER BY year ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END, 3) AS value, turns FROM f"""


def ngram_index(spark, d):
    return A.ngram_from_unigrams(table(spark, d, "unigrams"), "Hospital", Selection(speeches(), since("2006"), until("2020")))


def term_counter(spark, d):
    return A.term_counter(spread(table(spark, d, "interventions")), ["señor presidente", "senhor presidente"], SPEECH, "row_n")


def _frequency(by, variants=("deuda", "dívida")):
    def query(spark, d):
        return A.term_frequency(spread(table(spark, d, "interventions")), list(variants), by(), SPEECH, "row_n")

    return query


def _frequency_sql(expr, patterns=(" deuda ", " divida ")):
    return f"""WITH {TURNS}, k AS (SELECT {expr} AS grp, n_words, {uses('text', *patterns)} AS occ FROM t WHERE dm_speech = 1 AND text IS NOT NULL)
SELECT grp, sum(occ)::BIGINT AS uses, count(*) FILTER (occ > 0) AS turns, sum(n_words)::BIGINT AS words, round(sum(occ) * 1e6 / nullif(sum(n_words), 0), 2) AS per_million FROM k GROUP BY 1"""


def top_parties(spark, d):
    return A.top_groups(spread(table(spark, d, "interventions")), ["corrupción", "inflación", "inflação"], SPEECH, "party", 3, "row_n")


def share_of_voice(spark, d):
    rows = turns(spark, d, "country", "date", "dm_speech", "speaker_raw", "sex", "n_words")
    return A.share_of_voice(rows, terms(spark, d).select("country", "id_dep", "sex", "start_date", "end_date"), PEOPLE)


_CHAIR_SQL = f"(coalesce(regexp_matches(speaker_raw, '{CHAIR.replace('(?iu)', '(?i)')}') AND NOT regexp_matches(speaker_raw, '{NOT_CHAIR.replace('(?iu)', '(?i)')}'), false))"
_VOICE_SQL = f"""WITH {TURNS}, {TERMS},
w AS (SELECT country, year(date)::INT AS year, sex AS grp, sum(n_words)::BIGINT AS words FROM t WHERE dm_speech = 1 AND NOT {_CHAIR_SQL} AND n_words <= 10000 AND date IS NOT NULL AND sex IS NOT NULL GROUP BY 1, 2, 3),
y AS (SELECT DISTINCT country, year FROM w),
m AS (SELECT country, year, sex AS grp, count(*) AS members FROM (
  SELECT y.country, y.year, id_dep, sex, row_number() OVER (PARTITION BY y.country, y.year, id_dep ORDER BY start_date, sex) AS k
  FROM r JOIN y ON r.country = y.country AND year(start_date) <= y.year AND coalesce(year(end_date), 2999) >= y.year WHERE sex IS NOT NULL) WHERE k = 1 GROUP BY 1, 2, 3),
j AS (SELECT country, year, grp, coalesce(words, 0) AS words, coalesce(members, 0) AS members FROM w FULL JOIN m USING (country, year, grp)),
p AS (SELECT *, words / sum(words) OVER (PARTITION BY country, year) AS sw, members / nullif(sum(members) OVER (PARTITION BY country, year), 0) AS sm FROM j)
SELECT country, year, grp, words, round(sw, 6) AS share_words, members, round(sm, 6) AS share_members, round(sw / nullif(sm, 0), 4) AS ratio FROM p"""


def coverage(spark, d):
    return A.coverage(turns(spark, d, "country", "id_session", "date", "dm_speech", "n_words", "id_dep", "sex", "text", "speaker_raw"), F.year("date"))


_COVERAGE_SQL = f"""WITH {TURNS}
SELECT country, year(date)::INT AS period, count(DISTINCT id_session) AS sessions, count(*) AS n_rows, count(*) FILTER (dm_speech = 1) AS speech_rows,
  coalesce(sum(n_words) FILTER (dm_speech = 1), 0)::BIGINT AS speech_words,
  round(count(*) FILTER (dm_speech = 1 AND id_dep IS NOT NULL) * 100.0::DOUBLE / nullif(count(*) FILTER (dm_speech = 1), 0), 2) AS linked_pct,
  round(count(*) FILTER (dm_speech = 1 AND sex IS NOT NULL) * 100.0::DOUBLE / nullif(count(*) FILTER (dm_speech = 1), 0), 2) AS sex_known_pct,
  count(*) FILTER (text IS NULL) AS without_text, count(*) FILTER (date IS NULL) AS undated, count(*) FILTER (dm_speech = 1 AND {_CHAIR_SQL}) AS chair_rows
FROM t GROUP BY 1, 2"""


def missing_years(spark, d):
    return A.missing_years(turns(spark, d, "country", "date"))


def distinctive_words(spark, d):
    side = F.when(F.col("sex") == "F", "a").when(F.col("sex") == "M", "b")
    return A.distinctive_words(table(spark, d, "unigrams").select("fold", "n", "sex"), side)


_Z_SQL = """WITH s AS (SELECT fold AS word, coalesce(sum(n) FILTER (sex = 'F'), 0)::DOUBLE AS ya, coalesce(sum(n) FILTER (sex = 'M'), 0)::DOUBLE AS yb FROM unigrams GROUP BY 1),
n AS (SELECT sum(ya) AS na, sum(yb) AS nb FROM s),
z AS (SELECT word, ya, yb, 1000.0::DOUBLE * (ya + yb) / (na + nb) AS al, na, nb FROM s, n WHERE ya + yb >= 20 AND length(word) >= 2 AND NOT regexp_full_match(word, '\\p{N}+'))
SELECT word, ya::BIGINT AS ya, yb::BIGINT AS yb, round((ln((ya + al) / (na + 1000 - ya - al)) - ln((yb + al) / (nb + 1000 - yb - al))) / sqrt(1 / (ya + al) + 1 / (yb + al)), 5) AS z FROM z"""


def distinctive_extremes(spark, d):
    return A.extremes(distinctive_words(spark, d), "z", "word", 15)


def collocations(spark, d):
    return A.collocations(turns(spark, d, "text"), "presupuesto")


_COLL_SQL = f"""WITH {TURNS},
w AS (SELECT id_int, regexp_extract_all(trim(strip_accents(lower(text))), '[\\p{{L}}\\p{{N}}]+') AS w FROM t WHERE text IS NOT NULL),
h AS (SELECT id_int, w, list_filter(range(1, len(w) + 1), lambda k: w[k] = 'presupuesto') AS hits FROM w WHERE list_contains(w, 'presupuesto')),
p AS (SELECT hits, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS term FROM h),
q AS (SELECT term, len(list_filter(hits, lambda h: abs(h - pos) <= 5)) > 0 AS near FROM p WHERE term <> 'presupuesto' AND length(term) > 1 AND NOT regexp_full_match(term, '\\p{{N}}+')),
s AS (SELECT term, count(*) FILTER (near) AS a, count(*) FILTER (NOT near) AS b FROM q GROUP BY 1),
n AS (SELECT sum(a)::DOUBLE AS ta, sum(b)::DOUBLE AS tb FROM s),
e AS (SELECT term, a, b, (a + b) * (ta / (ta + tb)) AS ea, (a + b) * (tb / (ta + tb)) AS eb FROM s, n)
SELECT term AS word, a AS near, b AS far, round(2 * (CASE WHEN a > 0 THEN a * ln(a / ea) ELSE 0 END + CASE WHEN b > 0 THEN b * ln(b / eb) ELSE 0 END), 4) AS g2 FROM e WHERE a >= 5 AND a > ea"""


def keyness(spark, d):
    u = table(spark, d, "unigrams")
    return A.keyness(u.where(F.col("year") >= 2020), u.where(F.col("year") < 2020))


_KEY_SQL = """WITH a AS (SELECT fold, sum(n)::BIGINT AS a FROM unigrams WHERE year >= 2020 GROUP BY 1), b AS (SELECT fold, sum(n)::BIGINT AS b FROM unigrams WHERE year < 2020 GROUP BY 1),
n AS (SELECT (SELECT sum(a) FROM a)::DOUBLE AS c, (SELECT sum(b) FROM b)::DOUBLE AS d),
j AS (SELECT fold, a, coalesce(b, 0) AS b, c, d, c + d AS n, a + coalesce(b, 0) AS s FROM a LEFT JOIN b USING (fold), n WHERE a >= 5),
g AS (SELECT *, 2 * (a * ln(1 + (a - s * (c / n)) / (s * (c / n))) + CASE WHEN b > 0 THEN b * ln(1 + (b - s * (d / n)) / (s * (d / n))) ELSE 0 END
  + (c - a) * ln(1 + ((c - a) - (n - s) * (c / n)) / ((n - s) * (c / n))) + (d - b) * ln(1 + ((d - b) - (n - s) * (d / n)) / ((n - s) * (d / n)))) AS g2 FROM j)
SELECT fold, a, b, round(CASE WHEN a / c >= b / d THEN g2 ELSE -g2 END, 4) AS g2, round(log2((a / c) / (greatest(b, 0.5) / d)), 4) AS log_ratio FROM g WHERE round(CASE WHEN a / c >= b / d THEN g2 ELSE -g2 END, 4) >= 10.83"""


def index_unigrams(spark, d):
    return C.index_unigrams(turns(spark, d, "country", "date", "sex", "dm_speech", "text"))


def index_vocab(spark, d):
    return C.index_vocab(turns(spark, d, "country", "dm_speech", "text"))


def catalog(spark, d):
    return C.catalog(turns(spark, d, "country", "id_session", "date"), table(spark, d, "datasets"))


def rollup(spark, d):
    rows = turns(spark, d, "country", "date", "n_words")
    return rows.rollup("country", F.year("date").alias("year")).agg(F.count("*").alias("turns"), F.sum("n_words").cast("bigint").alias("words"), F.grouping_id().cast("int").alias("level"))


def word_quantiles(spark, d):
    rows = turns(spark, d, "country", "dm_speech", "n_words").where("dm_speech = 1")
    return rows.groupBy("country").agg(F.median("n_words").alias("median_words"), F.round(F.percentile("n_words", 0.9), 4).alias("p90_words"), F.max_by("id_int", F.struct("n_words", "id_int")).alias("longest_id"))


def linkage(spark, d):
    rows = turns(spark, d, "country", "dm_speech", "id_dep", "speaker_raw")
    speech = F.col("dm_speech") == 1
    nobody = F.col("id_dep").isNull() & F.col("speaker_raw").rlike(r"(?iu)^\W*(una voz|um? senhor|varios|vários|voces|vozes|\(sin|la presidencia|a presidência|mesa|comisi|comiss)")
    guest = F.col("id_dep").isNull() & F.col("speaker_raw").rlike(r"(?iu)^\W*(invitad|convidad|el ministro|la ministra|o ministro|a ministra)")
    g = rows.groupBy("country").agg(F.count("*").alias("n_rows"), F.count_if(speech).alias("speech"), F.count_if(speech & F.col("id_dep").isNotNull()).alias("linked"), F.count_if(speech & guest).alias("no_seat"), F.count_if(speech & ~guest & nobody).alias("unattributable"))
    base = F.col("speech") - F.col("no_seat") - F.col("unattributable")
    return g.withColumn("gross_pct", F.round(F.col("linked") * 100.0 / F.nullif("speech", F.lit(0)), 2)).withColumn("effective_pct", F.round(F.col("linked") * 100.0 / F.nullif(base, F.lit(0)), 2))


_GUEST_SQL = "(id_dep IS NULL AND coalesce(regexp_matches(speaker_raw, '(?i)^\\W*(invitad|convidad|el ministro|la ministra|o ministro|a ministra)'), false))"
_NOBODY_SQL = "(id_dep IS NULL AND coalesce(regexp_matches(speaker_raw, '(?i)^\\W*(una voz|um? senhor|varios|vários|voces|vozes|\\(sin|la presidencia|a presidência|mesa|comisi|comiss)'), false))"

QUERIES = {
    "ngram_series": ngram_series,
    "ngram_smoothed": ngram_smoothed,
    "ngram_index": ngram_index,
    "term_counter": term_counter,
    "term_by_year": _frequency(lambda: F.year("date").cast("string")),
    "term_by_decade": _frequency(lambda: (F.floor(F.year("date") / 10) * 10).cast("string")),
    "term_by_party": _frequency(lambda: F.col("party")),
    "term_by_session": _frequency(lambda: F.col("id_session")),
    "top_parties": top_parties,
    "share_of_voice": share_of_voice,
    "coverage": coverage,
    "missing_years": missing_years,
    "distinctive_words": distinctive_words,
    "distinctive_extremes": distinctive_extremes,
    "collocations": collocations,
    "keyness": keyness,
    "index_unigrams": index_unigrams,
    "index_vocab": index_vocab,
    "catalog": catalog,
    "rollup": rollup,
    "word_quantiles": word_quantiles,
    "linkage": linkage,
}
SQL = {
    "ngram_series": _NGRAM_SQL,
    "ngram_smoothed": _SMOOTH_SQL,
    "ngram_index": "SELECT year::INT AS year, sum(CASE WHEN fold = 'hospital' THEN n ELSE 0 END)::BIGINT AS count, sum(n)::BIGINT AS words FROM unigrams WHERE year BETWEEN 2006 AND 2020 GROUP BY 1",
    "term_counter": f"""WITH {TURNS}, k AS (SELECT *, {uses('text', ' senor  presidente ', ' senhor  presidente ')} AS occ FROM t WHERE dm_speech = 1)
SELECT country, sum(occ)::BIGINT AS uses, count(*) AS turns, count(DISTINCT id_session) AS sessions, count(DISTINCT id_dep) AS speakers, count(id_dep) AS linked,
  min(date) AS first_date, max(date) AS last_date, first(id_int ORDER BY date NULLS LAST, id_int) AS first_id FROM k WHERE occ > 0 GROUP BY 1""",
    "term_by_year": _frequency_sql("year(date)::VARCHAR"),
    "term_by_decade": _frequency_sql("(floor(year(date) / 10) * 10)::BIGINT::VARCHAR"),
    "term_by_party": _frequency_sql("party"),
    "term_by_session": _frequency_sql("id_session"),
    "top_parties": f"""WITH {TURNS}, k AS (SELECT country, party, sum({uses('text', ' corrupcion ', ' inflacion ', ' inflacao ')})::BIGINT AS uses FROM t WHERE dm_speech = 1 AND party IS NOT NULL GROUP BY 1, 2 HAVING sum({uses('text', ' corrupcion ', ' inflacion ', ' inflacao ')}) > 0)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY uses DESC, party)::INT AS rank FROM k) WHERE rank <= 3""",
    "share_of_voice": _VOICE_SQL,
    "coverage": _COVERAGE_SQL,
    "missing_years": f"WITH {TURNS}, y AS (SELECT DISTINCT country, year(date)::INT AS year FROM t WHERE date IS NOT NULL), s AS (SELECT country, unnest(range(min(year), max(year) + 1))::INT AS year FROM y GROUP BY 1) SELECT * FROM s EXCEPT SELECT * FROM y",
    "distinctive_words": _Z_SQL,
    "distinctive_extremes": f"WITH q AS ({_Z_SQL}) (SELECT *, 'high' AS \"end\" FROM q ORDER BY z DESC, word LIMIT 15) UNION ALL (SELECT *, 'low' FROM q ORDER BY z, word LIMIT 15)",
    "collocations": _COLL_SQL,
    "keyness": _KEY_SQL,
    "index_unigrams": f"WITH {TURNS}, w AS (SELECT country, year(date)::SMALLINT AS year, sex, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')) AS word FROM t WHERE dm_speech = 1 AND date IS NOT NULL) SELECT country, year, sex, trim(strip_accents(word)) AS fold, count(*) AS n FROM w GROUP BY ALL",
    "index_vocab": f"WITH {TURNS}, w AS (SELECT country, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')) AS word FROM t WHERE dm_speech = 1), k AS (SELECT country, word, count(*) AS k FROM w GROUP BY ALL) SELECT country, trim(strip_accents(word)) AS fold, first(word ORDER BY k DESC, word) AS word, sum(k)::BIGINT AS n FROM k GROUP BY 1, 2",
    "catalog": f"WITH {TURNS}, c AS (SELECT country, count(*) AS turns, count(DISTINCT id_session) AS sessions, min(date) AS first_date, max(date) AS last_date FROM t GROUP BY 1) SELECT d.country, version, n_rows, turns, sessions, first_date, last_date, n_rows IS DISTINCT FROM turns AS stale FROM datasets d LEFT JOIN c USING (country)",
    "rollup": f"WITH {TURNS} SELECT country, year(date)::INT AS year, count(*) AS turns, sum(n_words)::BIGINT AS words, (grouping(country) * 2 + grouping(year(date)))::INT AS level FROM t GROUP BY ROLLUP (country, year(date))",
    "word_quantiles": f"WITH {TURNS} SELECT country, median(n_words)::DOUBLE AS median_words, round(quantile_cont(n_words, 0.9), 4) AS p90_words, first(id_int ORDER BY n_words DESC, id_int DESC) AS longest_id FROM t WHERE dm_speech = 1 GROUP BY 1",
    "linkage": f"""WITH {TURNS}, g AS (SELECT country, count(*) AS n_rows, count(*) FILTER (dm_speech = 1) AS speech, count(*) FILTER (dm_speech = 1 AND id_dep IS NOT NULL) AS linked,
  count(*) FILTER (dm_speech = 1 AND {_GUEST_SQL}) AS no_seat, count(*) FILTER (dm_speech = 1 AND NOT {_GUEST_SQL} AND {_NOBODY_SQL}) AS unattributable FROM t GROUP BY 1)
SELECT *, round(linked * 100.0::DOUBLE / nullif(speech, 0), 2) AS gross_pct, round(linked * 100.0::DOUBLE / nullif(speech - no_seat - unattributable, 0), 2) AS effective_pct FROM g""",
}
