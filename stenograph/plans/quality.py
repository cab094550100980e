"""Queries of corpus checks and repairs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as K
from ..sources.tables import table
from .common import TURNS, folded, turns

THEMES = [("health", "hospital"), ("health", "vacuna"), ("health", "farmacia"), ("money", "presupuesto"), ("money", "deuda"), ("money", "impuesto"), ("school", "escuela"), ("school", "universidad"), ("school", "docente")]


def fingerprint(spark, d):
    return K.fingerprint(turns(spark, d, "country", "id_session", "text", "n_words", "id_dep", "date", "speaker_raw"))


_PRINT = {
    "rows": "count(*)", "chars": "coalesce(sum(length(text)), 0)", "words": "coalesce(sum(n_words), 0)", "empty": "count(*) FILTER (coalesce(trim(text), '') = '')", "linked": "count(id_dep)", "undated": "count(*) FILTER (date IS NULL)",
    "sessions": "count(DISTINCT id_session)", "persons": "count(DISTINCT id_dep)", "speakers": "count(DISTINCT speaker_raw)", "unnamed": "count(*) FILTER (speaker_raw IS NULL)", "long_turns": "count(*) FILTER (n_words > 10000)",
    "short_turns": "count(*) FILTER (n_words < 5)", "years": "count(DISTINCT year(date))", "longest": "coalesce(max(length(text)), 0)",
    "digit_lines": "coalesce(sum(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\\W*\\d+\\W*$')))), 0)",
    "cut_lines": "coalesce(sum(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[\\p{L}][-\\x{ad}\\x{2010}¬]\\s*$')))), 0)",
}
_PRINT_SQL = f"WITH {TURNS}, " + f"a AS (SELECT {', '.join(f'({v})::BIGINT AS m_{k}' for k, v in _PRINT.items())} FROM t) " + " UNION ALL ".join(f"SELECT '{k}' AS measure, m_{k} AS value FROM a" for k in _PRINT) + " UNION ALL SELECT 'hapax_speakers', count(*) FROM (SELECT country, speaker_raw FROM t WHERE speaker_raw IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1)"


def conformity(spark, d):
    rows = turns(spark, d, "country", "id_session", "id_dep", "sex", "party", "legislature", "speaker_raw", "dm_speech", "intervention_order", "text", "date")
    return K.conformity(rows, table(spark, d, "deputies"))


_RULES = {
    "id_form": "NOT coalesce(regexp_full_match(id_int, '[A-Z]{2}\\d{12}'), false)", "id_prefix": "NOT coalesce(left(id_int, 9) = id_session, false)", "sex_value": "NOT coalesce(sex IN ('F', 'M'), true)",
    "speech_flag": "NOT coalesce(dm_speech IN (0, 1), false)", "order_negative": "intervention_order < 0", "markup": "regexp_matches(text, '<[a-zA-Z/][^>]*>')", "foreign_id": "id_dep IS NOT NULL AND left(id_dep, 2) <> country",
    "date_missing": "date IS NULL", "speech_without_text": "dm_speech = 1 AND coalesce(trim(text, ' '), '') = ''", "speech_without_speaker": "dm_speech = 1 AND coalesce(trim(speaker_raw, ' '), '') = ''",
    "person_without_party": "id_dep IS NOT NULL AND coalesce(trim(party, ' '), '') = ''", "legislature_missing": "coalesce(trim(legislature, ' '), '') = ''",
    "unknown_id": "id_dep IS NOT NULL AND id_dep NOT IN (SELECT id_dep FROM deputies WHERE id_dep IS NOT NULL)",
}
_CONFORM_SQL = f"WITH {TURNS} " + " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) AS broken FROM t WHERE {v}" for k, v in _RULES.items()) + """
 UNION ALL SELECT 'order_repeated', coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM t WHERE intervention_order > 0 GROUP BY id_session, intervention_order HAVING count(*) > 1)
 UNION ALL SELECT 'session_days', count(*) FROM (SELECT id_session FROM t WHERE date IS NOT NULL GROUP BY 1 HAVING count(DISTINCT date) > 1)"""


def verdicts(spark, d):
    return K.verdicts(turns(spark, d, "id_session", "dm_speech", "id_dep", "n_words", "text"))


_VERDICT_SQL = f"""WITH {TURNS}, m AS (SELECT id_session, median(n_words) AS m FROM t WHERE dm_speech = 1 GROUP BY 1),
g AS (SELECT id_session, count(*) FILTER (dm_speech = 1) AS n, count(*) FILTER (dm_speech = 1 AND id_dep IS NOT NULL) AS linked, count(*) FILTER (dm_speech = 1 AND n_words > 20 * m AND n_words > 400) AS giant,
  count(*) FILTER (dm_speech = 1 AND regexp_matches(text, '\\n\\s*(?:El señor|La señora|O SR\\.|A SRA\\.) \\p{{Lu}}')) AS markers FROM t LEFT JOIN m USING (id_session) GROUP BY 1),
r AS (SELECT id_session, list_filter([CASE WHEN n = 0 THEN 'no speech' END, CASE WHEN linked < n * 0.5::DOUBLE THEN 'few linked' END, CASE WHEN giant > n * 0.02::DOUBLE THEN 'giant turns' END, CASE WHEN markers > 0 THEN 'markers left' END], lambda x: x IS NOT NULL) AS r FROM g)
SELECT id_session, CASE WHEN len(r) = 0 THEN 'PASS' ELSE 'FLAG' END AS verdict, array_to_string(r, '; ') AS reasons FROM r"""


def confidence(spark, d):
    g = turns(spark, d, "country", "id_session", "id_dep").groupBy("country", "id_session").agg((F.count("id_dep") / F.count("*")).alias("score"))
    c = K.confidence(g, ["country"], "score")
    return c.select("country", *[F.round(x, 6).alias(x) for x in ("mean", "least", "harmonic")], "level")


def usual_spelling(spark, d):
    return K.usual_spelling(turns(spark, d, "country", "speaker_raw"))


_SKELETON = "regexp_replace(regexp_replace(regexp_replace(" + folded("speaker_raw") + ", '^\\W*(?:(?:el|la|o|a)\\s+)?(?:sr|sra|senor|senora|senhor|senhora|dip|dep|diputad[oa]|deputad[oa])\\b\\.?', ''), '\\([^)]*\\)', '', 'g'), '[^\\p{L}]', '', 'g')"
_USUAL_SQL = f"""WITH {TURNS}, n AS (SELECT country, speaker_raw, count(*) AS n FROM t WHERE speaker_raw IS NOT NULL GROUP BY 1, 2), k AS (SELECT *, {_SKELETON} AS k FROM n)
SELECT country, speaker_raw, first_value(speaker_raw) OVER (PARTITION BY country, k ORDER BY n DESC, speaker_raw) AS usual FROM k WHERE k <> ''"""


def speaker_variants(spark, d):
    return K.variants_of_frequent(turns(spark, d, "country", "speaker_raw"))


def register_duplicates(spark, d):
    return K.register_duplicates(table(spark, d, "deputies"))


def register_variants(spark, d):
    return K.register_variants(table(spark, d, "deputies"))


def adopt_neighbour(spark, d):
    return K.adopt_neighbour(turns(spark, d, "id_session", "id_dep", "speaker_raw"))


_ADOPT_SQL = f"""WITH {TURNS}, p AS (SELECT id_session, id_int, id_dep, row_number() OVER (PARTITION BY id_session ORDER BY id_int) AS place, {_SKELETON} AS k FROM t), q AS (SELECT * FROM p WHERE length(k) >= 6)
SELECT a.id_int, min(b.id_dep) AS id_dep FROM q a JOIN q b ON a.id_session = b.id_session AND a.k = b.k AND abs(a.place - b.place) <= 10 WHERE a.id_dep IS NULL AND b.id_dep IS NOT NULL GROUP BY 1 HAVING count(DISTINCT b.id_dep) = 1"""


def no_person(spark, d):
    rows = turns(spark, d, "speaker_raw")
    return rows.select(K.no_person(F.col("speaker_raw")).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def header_dates(spark, d):
    return K.header_dates(turns(spark, d, "id_session", "date", "text"))


def theme_dominance(spark, d):
    return K.theme_dominance(turns(spark, d, "text"), spark.createDataFrame(THEMES, "theme string, term string"))


_THEME_SQL = f"""WITH {TURNS}, m(theme, term) AS (VALUES {', '.join(map(str, THEMES))}), z AS (SELECT theme, count(*) AS size FROM m GROUP BY 1),
w AS (SELECT id_int, unnest(list_distinct(regexp_extract_all({folded('text')}, '[\\p{{L}}\\p{{N}}]+'))) AS term FROM t),
s AS (SELECT id_int, theme, count(*) / any_value(size) AS share FROM w JOIN m USING (term) JOIN z USING (theme) GROUP BY 1, 2 HAVING count(*) >= 2),
k AS (SELECT *, row_number() OVER (PARTITION BY id_int ORDER BY share DESC, theme) AS k, lead(share) OVER (PARTITION BY id_int ORDER BY share DESC, theme) AS second FROM s)
SELECT id_int, theme, round(share, 6) AS share FROM k WHERE k = 1 AND coalesce(second, 0) < share"""

_NOBODY_SQL = f"""WITH {TURNS}, f AS (SELECT speaker_raw, {folded('speaker_raw')} AS f FROM t), k AS (SELECT CASE WHEN coalesce(trim(speaker_raw, ' '), '') = '' THEN 'blank'
  WHEN regexp_matches(f, '^\\W*(una voz|um senhor|uma voz|varios|vozes|voces|senhores|senores)') THEN 'voices' WHEN regexp_matches(f, '^\\W*\\(?(sin identificar|nao identificad|no identificad)') THEN 'unknown'
  WHEN regexp_matches(f, '^\\W*(?:el |la |o |a )?(?:sr\\.? |sra\\.? |senor |senora |senhor )?(?:president[ea]|presidencia|secretari[oa]|mesa|comision|comissao|ministr[oa]|relator)(?:\\W*$| d[aeo] | diret| direct)') THEN 'office' END AS kind FROM f)
SELECT kind, count(*) AS n FROM k GROUP BY 1"""
_HEADER_SQL = f"""WITH {TURNS}, e AS (SELECT id_session, unnest(regexp_extract_all(text, '(?m)^.{{0,40}}?(\\d{{2}}/\\d{{2}}/\\d{{4}})', 1)) AS found FROM t),
n AS (SELECT id_session, try_strptime(found, '%d/%m/%Y')::DATE AS printed, count(*) AS n FROM e GROUP BY 1, 2), u AS (SELECT id_session, first(printed ORDER BY n DESC, printed) AS printed FROM n WHERE printed IS NOT NULL GROUP BY 1),
s AS (SELECT id_session, min(date) AS date FROM t GROUP BY 1)
SELECT s.id_session, date, printed, CASE WHEN printed IS NULL THEN 'NONE' WHEN printed IS NOT DISTINCT FROM date THEN 'OK' ELSE 'DIFFERENT' END AS verdict FROM s LEFT JOIN u ON s.id_session = u.id_session OR (s.id_session IS NULL AND u.id_session IS NULL AND false)"""

_NAMES = "fingerprint conformity verdicts confidence usual_spelling speaker_variants register_duplicates register_variants adopt_neighbour no_person header_dates theme_dominance".split()
QUERIES = {name: globals()[name] for name in _NAMES}
SQL = {
    "fingerprint": _PRINT_SQL,
    "conformity": _CONFORM_SQL,
    "verdicts": _VERDICT_SQL,
    "confidence": f"WITH {TURNS}, g AS (SELECT country, count(id_dep) / count(*) AS s FROM t GROUP BY country, id_session) SELECT country, round(avg(s), 6) AS mean, round(min(s), 6) AS least, round(count(*) FILTER (s > 0) / sum(CASE WHEN s > 0 THEN 1 / s END), 6) AS harmonic, CASE WHEN avg(s) >= 0.85 THEN 'AUTO' WHEN avg(s) >= 0.65 THEN 'FLAG' ELSE 'HALT' END AS level FROM g GROUP BY 1",
    "usual_spelling": _USUAL_SQL,
    "register_duplicates": "WITH p AS (SELECT DISTINCT country, id_dep, array_to_string(list_sort(list_distinct(regexp_extract_all(trim(strip_accents(lower(speaker_name))), '[\\p{L}]{3,}'))), ' ') AS name FROM deputies WHERE speaker_name IS NOT NULL), q AS (SELECT * FROM p WHERE len(string_split(name, ' ')) >= 3), f AS (SELECT country, name, min(id_dep) AS a FROM q GROUP BY 1, 2 HAVING count(*) > 1) SELECT country, a, id_dep AS b, name FROM q JOIN f USING (country, name) WHERE id_dep <> a",
    "adopt_neighbour": _ADOPT_SQL,
    "no_person": _NOBODY_SQL,
    "header_dates": _HEADER_SQL,
    "theme_dominance": _THEME_SQL,
}
