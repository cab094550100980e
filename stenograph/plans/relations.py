"""Queries of joins, order, duplicates, subsets, networks and texts, over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import MONTHS, half_up, nearest_month
from ..functions.terms import CHAIR, NOT_CHAIR, Selection, since, speeches
from ..functions.text import count_words, fold
from ..operators import libraries as L
from ..operators import networks as N
from ..operators import register as R
from ..operators import sequence as S
from ..operators import spotting as P
from ..operators import texts as X
from ..sources import corpus as C
from ..sources.tables import table
from .common import SESSIONS, TERMS, TURNS, folded, normal, sessions, terms, turns, uses

_SAFE = "CASE WHEN trim({0}) <> '' AND lower(trim({0})) NOT IN ('nan', 'none', 'null') THEN trim({0}) END"


# --- joins with registers ---
def close_open_terms(spark, d):
    return R.close_open_terms(terms(spark, d)).select("reg_n", "closed_end")


def covering_term(spark, d):
    return R.covering_term(turns(spark, d, "id_dep", "date"), terms(spark, d))


_COVERING_SQL = f"""WITH {TURNS}, {TERMS},
j AS (SELECT t.id_int, r.reg_n, r.party, greatest(date_diff('day', t.date, r.start_date), coalesce(date_diff('day', r.end_date, t.date), 0), 0)::INT AS distance, r.start_date
  FROM t JOIN r ON t.id_dep = r.id_dep WHERE t.date IS NOT NULL AND r.start_date IS NOT NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY id_int ORDER BY distance, start_date DESC, reg_n DESC) AS k FROM j)
SELECT t.id_int, id_dep, date, reg_n, b.party AS term_party, distance FROM t LEFT JOIN b ON t.id_int = b.id_int AND k = 1"""


def in_office(spark, d):
    return R.in_office(terms(spark, d), "2015-06-15")


def merge_ids(spark, d):
    rows = turns(spark, d, "country", "speaker_raw", "legislature", "id_dep")
    matches = rows.where(F.col("id_dep").isNotNull() & F.col("speaker_raw").isNotNull() & F.col("legislature").isNotNull()).select("speaker_raw", "legislature", "id_dep")
    return R.merge_ids(rows, matches).select("id_int", "id_dep")


_MERGE_SQL = f"""WITH {TURNS},
m AS (SELECT speaker_raw, legislature, min(id_dep) AS mid FROM t WHERE speaker_raw IS NOT NULL AND legislature IS NOT NULL AND {_SAFE.format('id_dep')} IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT id_dep) = 1)
SELECT id_int, coalesce({_SAFE.format('id_dep')}, mid) AS id_dep FROM t LEFT JOIN m USING (speaker_raw, legislature)"""


def propagate_district(spark, d):
    return R.propagate_single_valued(turns(spark, d, "id_dep", "district"), "id_dep", "district").select("id_int", "district")


def clip_overlaps(spark, d):
    t = terms(spark, d).where("start_date IS NOT NULL")
    end = F.coalesce("end_date", F.lit("2999-12-31").cast("date"))
    left = t.where("legislature IS NOT NULL").select("id_dep", F.col("legislature").alias("l_label"), F.col("start_date").alias("l_start"), end.alias("l_end"))
    right = t.where("party IS NOT NULL").select("id_dep", F.col("party").alias("r_label"), F.col("start_date").alias("r_start"), end.alias("r_end"))
    return R.clip_overlaps(left, right, "id_dep").distinct()


_CLIP_SQL = f"""WITH {TERMS}, q AS (SELECT id_dep, legislature, party, start_date AS a, coalesce(end_date, DATE '2999-12-31') AS b FROM r WHERE start_date IS NOT NULL)
SELECT DISTINCT l.id_dep, l.legislature AS l_label, p.party AS r_label, greatest(l.a, p.a) AS start, least(l.b, p.b) AS "end"
FROM q l JOIN q p ON l.id_dep = p.id_dep AND l.a < p.b AND l.b > p.a WHERE l.legislature IS NOT NULL AND p.party IS NOT NULL"""


def unknown_ids(spark, d):
    return R.unknown_ids(turns(spark, d, "id_dep"), table(spark, d, "deputies"))


def ambiguous_keys(spark, d):
    return R.ambiguous_keys(turns(spark, d, "country", "speaker_raw", "id_dep"), "speaker_raw")


def impose_frozen(spark, d):
    rows = turns(spark, d, "country", "speaker_raw", "id_dep")
    frozen = rows.where("id_dep IS NOT NULL AND speaker_raw IS NOT NULL")
    return R.impose_frozen(rows, frozen, "speaker_raw").select("id_int", "id_dep")


def seats_check(spark, d):
    return R.seats_check(terms(spark, d))


def bound_terms(spark, d):
    return R.bound_terms(terms(spark, d), turns(spark, d, "country", "legislature", "date"))


def sex_cascade(spark, d):
    return R.sex_cascade(turns(spark, d, "id_dep", "speaker_raw"), table(spark, d, "deputies"))


def legislature_keys(spark, d):
    raw = turns(spark, d, "legislature")
    return raw.select(R.legislature_key(F.concat(F.lit("ES"), F.col("legislature"), F.lit("ª"))).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


# --- order and sittings ---
def renumber(spark, d):
    return S.renumber(turns(spark, d, "id_session", "intervention_order", "text")).select("id_int", "new_order")


def get_session(spark, d):
    rows = turns(spark, d, "id_session", "intervention_order", "speaker_raw", "text")
    opening = F.left("text", F.lit(160))
    return rows.select("id_session", "id_int", "intervention_order", "speaker_raw", opening.alias("opening"))


def around(spark, d):
    rows = turns(spark, d, "id_session", "speaker_raw")
    middle = rows.agg(F.min("id_int")).first()[0]
    return S.around(rows, middle, 3).select("id_int", "id_session", F.col("place").cast("int").alias("place"))


def order_gaps(spark, d):
    return S.order_gaps(turns(spark, d, "id_session", "intervention_order"))


def impute_by_date(spark, d):
    s = sessions(spark, d).withColumn("known", F.when(F.md5("id_session") < "b", F.col("legislature")))
    return S.impute_by_date(s.select("id_session", "country", "date", "known"), "known").select("id_session", "imputed")


_IMPUTE_SQL = f"""WITH {TURNS}, {SESSIONS}, k AS (SELECT id_session, country, date, CASE WHEN md5(id_session) < 'b' THEN legislature END AS known FROM s WHERE date IS NOT NULL),
p AS (SELECT *, last_value(CASE WHEN known IS NOT NULL THEN {{'d': date, 'v': known}} END IGNORE NULLS) OVER (PARTITION BY country ORDER BY date, id_session ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a,
  first_value(CASE WHEN known IS NOT NULL THEN {{'d': date, 'v': known}} END IGNORE NULLS) OVER (PARTITION BY country ORDER BY date, id_session ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b FROM k),
q AS (SELECT id_session, known, a.v AS av, b.v AS bv, date_diff('day', a.d, date) AS da, date_diff('day', date, b.d) AS db FROM p)
SELECT id_session, coalesce(known, CASE WHEN da <= 120 AND (db IS NULL OR da <= db) THEN av WHEN db <= 120 THEN bv WHEN da <= 120 THEN av END) AS imputed FROM q"""


def impute_gap(spark, d):
    s = sessions(spark, d).withColumn("number", F.expr("try_cast(session_number AS int)"))
    s = s.withColumn("number", F.when(F.md5("id_session") < "c", F.col("number")))
    return S.impute_gap_of_two(s).select("id_session", "number", "imputed")


def dense_ids(spark, d):
    return S.dense_ids(sessions(spark, d)).select("id_session", "new_id")


_DENSE_SQL = f"""WITH {TURNS}, {SESSIONS}, f AS (SELECT country, legislature, min(date) AS opens FROM s GROUP BY 1, 2),
l AS (SELECT country, legislature, dense_rank() OVER (PARTITION BY country ORDER BY opens NULLS LAST, legislature) AS ln FROM f),
q AS (SELECT id_session, s.country, ln, dense_rank() OVER (PARTITION BY s.country, s.legislature ORDER BY date NULLS LAST, try_cast(regexp_extract(session_number, '^\\s*(\\d+)', 1) AS INT) NULLS LAST, session_number NULLS LAST) AS sn FROM s JOIN l ON s.country = l.country AND s.legislature = l.legislature)
SELECT id_session, country || lpad(ln::VARCHAR, 3, '0') || lpad(sn::VARCHAR, 4, '0') AS new_id FROM q"""


def chair_segments(spark, d):
    return S.chair_segments(turns(spark, d, "id_session", "speaker_raw")).select("id_session", F.col("segment").cast("int").alias("segment"), "chair", "first_id", "turns")


_CHAIR_SQL = f"""WITH {TURNS},
n AS (SELECT id_session, id_int, CASE WHEN coalesce(regexp_matches(speaker_raw, '{CHAIR.replace('(?iu)', '(?i)')}') AND NOT regexp_matches(speaker_raw, '{NOT_CHAIR.replace('(?iu)', '(?i)')}'), false)
  THEN nullif(upper(trim(regexp_extract(speaker_raw, '\\(([^)]{{3,}})\\)', 1))), '') END AS named FROM t),
h AS (SELECT *, last_value(named IGNORE NULLS) OVER (PARTITION BY id_session ORDER BY id_int ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chair FROM n),
c AS (SELECT *, CASE WHEN chair IS NOT NULL AND chair IS DISTINCT FROM lag(chair) OVER (PARTITION BY id_session ORDER BY id_int) THEN 1 ELSE 0 END AS ch FROM h),
g AS (SELECT *, sum(ch) OVER (PARTITION BY id_session ORDER BY id_int)::INT AS segment FROM c)
SELECT id_session, segment, chair, min(id_int) AS first_id, count(*) AS turns FROM g WHERE chair IS NOT NULL GROUP BY 1, 2, 3"""


def vocative_sex(spark, d):
    return S.vocative_sex(turns(spark, d, "id_session", "text"))


_VOCATIVE_SQL = f"""WITH {TURNS}, v AS (SELECT id_session, id_int, CASE WHEN regexp_matches(text, '(?i)señora presidenta|senhora presidenta') THEN 'F' WHEN regexp_matches(text, '(?i)señor presidente|senhor presidente') THEN 'M' END AS v FROM t),
n AS (SELECT id_int, coalesce(v, lag(v, 1) OVER w, lead(v, 1) OVER w, lag(v, 2) OVER w, lead(v, 2) OVER w) AS called FROM v WINDOW w AS (PARTITION BY id_session ORDER BY id_int))
SELECT * FROM n WHERE called IS NOT NULL"""


def date_plausibility(spark, d):
    return S.date_plausibility(sessions(spark, d)).select("id_session", "date", "previous", "next")


# --- duplicates ---
def doubled_sessions(spark, d):
    return S.doubled_sessions(turns(spark, d, "id_session", "text"))


_NORMAL_TEXT = "trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
_DOUBLED_SQL = f"""WITH {TURNS}, p AS (SELECT id_session, CASE WHEN length(text) >= 80 THEN md5({_NORMAL_TEXT}) END AS k, count(*) AS n FROM t GROUP BY 1, 2),
s AS (SELECT id_session, sum(n) FILTER (k IS NOT NULL)::BIGINT AS n_rows, count(*) FILTER (k IS NOT NULL AND n > 1) AS repeated, count(*) FILTER (k IS NOT NULL AND n = 2) AS twice, sum(n - 1) FILTER (k IS NOT NULL) AS extra, sum(n) AS every_n FROM p GROUP BY 1)
SELECT id_session, n_rows, repeated, twice FROM s WHERE repeated >= 20 AND twice >= repeated * 0.7::DOUBLE AND extra >= every_n * 0.25::DOUBLE"""


def keep_best(spark, d):
    return S.keep_best(turns(spark, d, "id_session", "id_dep", "text")).select("id_int")


_BEST_SQL = f"""WITH {TURNS}, k AS (SELECT id_int, row_number() OVER (PARTITION BY id_session, CASE WHEN length(text) >= 80 THEN md5({_NORMAL_TEXT}) ELSE 'row:' || id_int END ORDER BY id_dep IS NULL, length(text) DESC, id_int) AS rn FROM t)
SELECT id_int FROM k WHERE rn = 1"""


def exact_repeats(spark, d):
    return S.exact_repeats(turns(spark, d, "legislature", "date", "speaker_raw", "text"))


def same_day_duplicates(spark, d):
    rows = turns(spark, d, "country", "date", "id_session", "session_number", "text")
    return S.same_day_duplicates(rows)


_SAME_SQL = f"""WITH {TURNS}, k AS (SELECT DISTINCT country, date, id_session, md5({_NORMAL_TEXT}) AS k FROM t WHERE date IS NOT NULL AND length(text) >= 40),
z AS (SELECT id_session, count(*) AS n FROM k GROUP BY 1),
m AS (SELECT country, date, id_session, min(nullif(trim(session_number), '')) AS number FROM t WHERE date IS NOT NULL GROUP BY 1, 2, 3),
p AS (SELECT a.id_session AS a, b.id_session AS b, count(*) AS both_n FROM k a JOIN k b ON a.country = b.country AND a.date = b.date AND a.k = b.k AND a.id_session < b.id_session GROUP BY 1, 2),
q AS (SELECT a.country, a.date, a.id_session AS a, b.id_session AS b, a.number AS na, b.number AS nb FROM m a JOIN m b ON a.country = b.country AND a.date = b.date AND a.id_session < b.id_session),
j AS (SELECT q.a, q.b, coalesce(round(both_n / (x.n + y.n - both_n), 6), 0) AS jaccard, na = nb AS same FROM q LEFT JOIN p USING (a, b) LEFT JOIN z x ON q.a = x.id_session LEFT JOIN z y ON q.b = y.id_session),
h AS (SELECT a, b, jaccard, CASE WHEN coalesce(same, false) THEN 'number' ELSE 'texts' END AS reason FROM j WHERE coalesce(same, false) OR (jaccard >= 0.35 AND same IS NULL))
SELECT CASE WHEN coalesce(x.n, 0) >= coalesce(y.n, 0) THEN a ELSE b END AS keeper, CASE WHEN coalesce(x.n, 0) >= coalesce(y.n, 0) THEN b ELSE a END AS redundant, jaccard, reason FROM h LEFT JOIN z x ON a = x.id_session LEFT JOIN z y ON b = y.id_session"""


def copies(spark, d):
    rows = table(spark, d, "interventions")
    return rows.groupBy("id_int").agg(F.count("*").alias("copies"), F.min("row_n").alias("first_row")).where("copies > 1")


# --- samples and top-k (limits are the feature) ---
def seeded_sample(spark, d):
    return S.seeded_sample(turns(spark, d, "country"), "id_int", "seed-1", 50)


def round_robin(spark, d):
    return S.round_robin(turns(spark, d, "country"), "country", "id_int", "s", 40).select("id_int", "country", "turn")


def proportional(spark, d):
    return S.proportional(turns(spark, d, "country"), "country", "id_int", "s", 60).select("id_int", "country")


def newest(spark, d):
    return X.search_page(turns(spark, d, "date", "text"), "agua potable", limit=20).select("id_int", "date")


def matches(spark, d):
    return X.matches(turns(spark, d, "text"), "enmienda")


# --- subsets ---
def _subset(spark, d, terms_):
    return L.create(turns(spark, d, "country", "date", "dm_speech", "sex", "text"), terms_, Selection(speeches()), 1)


def subset_create(spark, d):
    return L.create(turns(spark, d, "country", "date", "dm_speech", "text"), ["presupuesto", "orçamento"], Selection(speeches(), since("2010")), 2)


_SUBSET_SQL = f"""WITH {TURNS}, k AS (SELECT id_int, country, {uses('text', ' presupuesto ', ' orcamento ')}::INT AS occ, md5(coalesce(text, '')) AS text_md5 FROM t WHERE dm_speech = 1 AND date >= DATE '2010-01-01')
SELECT * FROM k WHERE occ >= 2"""


def _combined(op):
    def query(spark, d):
        a = _subset(spark, d, ["hospital"]).select("id_int", F.lit("a").alias("note"))
        b = _subset(spark, d, ["escuela", "escola"]).select("id_int", F.lit("b").alias("note"))
        return L.combine(a, b, op)

    return query


def _combined_sql(op):
    return f"""WITH {TURNS}, a AS (SELECT id_int FROM t WHERE dm_speech = 1 AND {uses('text', ' hospital ')} > 0), b AS (SELECT id_int FROM t WHERE dm_speech = 1 AND {uses('text', ' escuela ', ' escola ')} > 0),
k AS (SELECT id_int FROM a {op} SELECT id_int FROM b) SELECT id_int, CASE WHEN id_int IN (SELECT id_int FROM a) THEN 'a' ELSE 'b' END AS note FROM k"""


def subset_rebuild(spark, d):
    rows = turns(spark, d, "country", "date", "dm_speech", "text")
    items = L.create(rows, ["hospital"], Selection(speeches()))
    edition = rows.where(F.md5("id_int") >= "2").withColumn("text", F.when(F.md5("id_int") < "5", F.concat("text", F.lit("."))).otherwise(F.col("text")))
    return L.rebuild(items, edition)


_REBUILD_SQL = f"""WITH {TURNS}, o AS (SELECT id_int, country, md5(text) AS m FROM t WHERE dm_speech = 1 AND {uses('text', ' hospital ')} > 0),
e AS (SELECT id_int, country, md5(coalesce(CASE WHEN md5(id_int) < '5' THEN text || '.' ELSE text END, '')) AS m FROM t WHERE md5(id_int) >= '2'),
n AS (SELECT country, m, min(id_int) AS new_id FROM e GROUP BY 1, 2)
SELECT o.id_int AS old_id, CASE WHEN e.m = o.m THEN o.id_int ELSE new_id END AS id_int, CASE WHEN e.m = o.m THEN 'kept' WHEN new_id IS NOT NULL THEN 'moved' ELSE 'lost' END AS status
FROM o LEFT JOIN e ON o.id_int = e.id_int LEFT JOIN n ON o.country = n.country AND o.m = n.m"""


def subset_describe(spark, d):
    return L.describe(_subset(spark, d, ["hospital"]), turns(spark, d, "country", "id_session", "id_dep", "n_words", "sex", "speaker_raw", "date"))


_DESCRIBE_SQL = f"""WITH {TURNS}, k AS (SELECT * FROM t WHERE dm_speech = 1 AND {uses('text', ' hospital ')} > 0)
SELECT country, count(*) AS turns, count(DISTINCT id_session) AS sessions, count(DISTINCT id_dep) AS speakers, sum(n_words)::BIGINT AS words,
  round(sum(CASE WHEN sex = 'F' THEN n_words ELSE 0 END) * 100.0::DOUBLE / nullif(sum(n_words), 0), 2) AS women_pct,
  round(sum(CASE WHEN coalesce(regexp_matches(speaker_raw, '{CHAIR.replace('(?iu)', '(?i)')}') AND NOT regexp_matches(speaker_raw, '{NOT_CHAIR.replace('(?iu)', '(?i)')}'), false) THEN n_words ELSE 0 END) * 100.0::DOUBLE / nullif(sum(n_words), 0), 2) AS chair_pct,
  count(*) FILTER (n_words > 10000) AS long_turns, count(*) FILTER (date IS NULL) AS undated, min(date) AS first_date, max(date) AS last_date FROM k GROUP BY 1"""

# --- networks ---
ENTITIES = [(w, w) for w in ("hospital", "escuela", "presupuesto", "agua potable", "deuda", "vivienda", "transporte", "orcamento", "escola", "seguranca")]


def presence(spark, d):
    return N.entity_presence(turns(spark, d, "dm_speech", "text").where("dm_speech = 1"), ENTITIES)


def pair_network(spark, d):
    rows = turns(spark, d, "dm_speech", "text").where("dm_speech = 1")
    return N.pair_network(N.entity_presence(rows, ENTITIES), rows.count(), 2, -1.0)


_PRESENT = " UNION ALL ".join(f"SELECT id_int, '{n}' AS entity FROM x WHERE contains(x, '{' ' + '  '.join(p.split()) + ' '}')" for n, p in ENTITIES)
_PRESENCE_SQL = f"WITH {TURNS}, x AS (SELECT id_int, {normal('text')} AS x FROM t WHERE dm_speech = 1), p AS ({_PRESENT})"
_PAIR_SQL = f"""{_PRESENCE_SQL}, n AS (SELECT count(*) AS big_n FROM x), f AS (SELECT entity, count(*) AS n FROM p GROUP BY 1),
c AS (SELECT a.entity AS a, b.entity AS b, count(*) AS co FROM p a JOIN p b ON a.id_int = b.id_int AND a.entity < b.entity GROUP BY 1, 2),
j AS (SELECT c.*, x.n AS n_a, y.n AS n_b, CASE WHEN co = big_n THEN 1.0 ELSE ln((co / big_n) / ((x.n / big_n) * (y.n / big_n))) / -ln(co / big_n) END AS raw FROM c JOIN f x ON a = x.entity JOIN f y ON b = y.entity, n)
SELECT a, b, co, n_a, n_b, round(raw, 6) AS npmi, round(co / (n_a + n_b - co), 6) AS jaccard FROM j WHERE co >= 2 AND raw >= -1"""


def pruned_network(spark, d):
    return N.prune_neighbours(pair_network(spark, d), "co", 2).select("a", "b", "co")


def _mentions(spark, d):
    """Distinct surnames of the register stand in for a gazetteer; persons who share one are left out."""
    people = terms(spark, d).where("speaker_name IS NOT NULL").groupBy("id_dep").agg(F.min("speaker_name").alias("n"))
    pair = people.select("id_dep", F.expr("array_join(slice(split(trim(regexp_replace(n, ' +', ' ')), ' '), -2, 2), ' ')").alias("s")).select("id_dep", fold("s").alias("s"))
    single = pair.groupBy("s").agg(F.count("*").alias("k"), F.min("id_dep").alias("id_dep")).where("k = 1")
    rows = turns(spark, d, "id_dep", "dm_speech", "text").where("dm_speech = 1")
    grams = P.token_lists(rows.where("id_dep IS NOT NULL"), "id_int", "id_dep").where(F.size("w") > 1)
    two = grams.select("id_int", F.col("id_dep").alias("source"), F.explode(F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))).alias("s"))
    return two.join(single.select("s", F.col("id_dep").alias("target")), "s").where("source <> target").groupBy("source", "target").agg(F.countDistinct("id_int").alias("turns"))


_MENTION_SQL = f"""WITH {TURNS}, {TERMS}, p AS (SELECT id_dep, min(speaker_name) AS n FROM r WHERE speaker_name IS NOT NULL GROUP BY 1),
s AS (SELECT id_dep, trim(strip_accents(lower(array_to_string(string_split(trim(regexp_replace(n, ' +', ' ', 'g')), ' ')[-2:], ' ')))) AS s FROM p),
u AS (SELECT s, min(id_dep) AS target FROM s GROUP BY 1 HAVING count(*) = 1),
w AS (SELECT id_int, id_dep AS source, regexp_extract_all({folded('text')}, '[\\p{{L}}\\p{{N}}]+') AS w FROM t WHERE dm_speech = 1 AND id_dep IS NOT NULL),
g AS (SELECT id_int, source, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS s FROM w)
SELECT source, target, count(DISTINCT id_int) AS turns FROM g JOIN u USING (s) WHERE source <> target GROUP BY 1, 2"""


def mention_rank(spark, d):
    from ..session import materialize

    return N.page_rank(materialize(_mentions(spark, d), "mention-edges")).select("node", F.round("rank", 6).alias("rank"))


def themes(spark, d):
    """Communities of the pruned word network; collected because the dictionary bounds its size."""
    g = N.Graph.collect(pair_network(spark, d), "a", "b", "co")
    label, between = g.communities(), g.betweenness()
    return spark.createDataFrame([(n, label[n], round(between[n], 6)) for n in g.nodes] or [("", 0, 0.0)], "node string, theme int, betweenness double")


def coder_agreement(spark, d):
    rows = turns(spark, d, "sex", "speaker_raw")
    a = F.when(F.upper(F.left(F.trim("sex"), F.lit(1))).isin("F", "M"), F.upper(F.left(F.trim("sex"), F.lit(1))))
    b = F.when(F.col("speaker_raw").rlike(r"(?iu)^\W*(la|a) |sra|señora|diputada|deputada"), "F").when(F.col("speaker_raw").rlike(r"(?iu)^\W*(el|o) |sr|señor|diputado|deputado"), "M")
    return N.kappa(rows.select(a.alias("a"), b.alias("b")), "a", "b")


_KAPPA_SQL = f"""WITH {TURNS}, c AS (SELECT CASE WHEN upper(left(trim(sex), 1)) IN ('F', 'M') THEN upper(left(trim(sex), 1)) END AS a,
  CASE WHEN regexp_matches(speaker_raw, '(?i)^\\W*(la|a) |sra|señora|diputada|deputada') THEN 'F' WHEN regexp_matches(speaker_raw, '(?i)^\\W*(el|o) |sr|señor|diputado|deputado') THEN 'M' END AS b FROM t),
k AS (SELECT * FROM c WHERE a IS NOT NULL AND b IS NOT NULL), n AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS o, count(*) FILTER (a = 'F') AS af, count(*) FILTER (b = 'F') AS bf FROM k),
p AS (SELECT n, o / n AS po, (af * bf + (n - af) * (n - bf)) / (n::DOUBLE * n) AS pe FROM n)
SELECT n, round(po, 6) AS agreement, round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END, 6) AS kappa FROM p"""


def prevalence(spark, d):
    g = turns(spark, d, "country", "dm_speech", "text").where("dm_speech = 1 AND text IS NOT NULL").groupBy("country").agg(F.count("*").alias("n"), F.count_if(F.col("text").rlike("(?i)hospital")).alias("k"))
    low, high = N.wilson(F.col("k").cast("double"), F.col("n").cast("double"))
    return g.select("country", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


_WILSON_SQL = f"""WITH {TURNS}, g AS (SELECT country, count(*) AS n, count(*) FILTER (regexp_matches(text, '(?i)hospital')) AS k FROM t WHERE dm_speech = 1 AND text IS NOT NULL GROUP BY 1),
p AS (SELECT *, k / n AS p, 1.959964::DOUBLE AS z FROM g)
SELECT country, n, k, round((p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n::DOUBLE * n)) / (1 + z * z / n), 6) AS low,
  round((p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n::DOUBLE * n)) / (1 + z * z / n), 6) AS high FROM p"""


def reading_list(spark, d):
    weights = spark.createDataFrame([("health", "hospital", 12.0), ("health", "vacuna", 9.0), ("health", "pension", 4.0), ("money", "presupuesto", 15.0), ("money", "deuda", 8.0)], "theme string, term string, g2 double")
    return N.reading_list(turns(spark, d, "text"), weights, 20)


_READ_SQL = f"""WITH {TURNS}, w(theme, term, g2) AS (VALUES ('health', 'hospital', 12.0::DOUBLE), ('health', 'vacuna', 9.0), ('health', 'pension', 4.0), ('money', 'presupuesto', 15.0), ('money', 'deuda', 8.0)),
x AS (SELECT id_int, regexp_extract_all({folded('text')}, '[\\p{{L}}\\p{{N}}]+') AS w FROM t), l AS (SELECT id_int, w, len(w) AS length FROM x WHERE len(w) > 0),
a AS (SELECT avg(length) AS average FROM l), e AS (SELECT id_int, length, unnest(w) AS term FROM l),
f AS (SELECT theme, id_int, length, term, g2, count(*) AS tf FROM e JOIN w USING (term) GROUP BY ALL),
s AS (SELECT theme, id_int, round(sum(ln(1 + g2) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average))), 6) AS score FROM f, a GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY score DESC, id_int)::INT AS place FROM s) WHERE place <= 20"""


# --- texts ---
def folded_words(spark, d):
    return table(spark, d, "vocab").select(fold("word").alias("f")).where("f <> ''").groupBy("f").agg(F.count("*").alias("n"))


def word_counts(spark, d):
    return turns(spark, d, "text").select("id_int", count_words("text").alias("words"))


def expressions(spark, d):
    return P.count_expressions(turns(spark, d, "text"), ["agua potable", "mi grupo votará a favor", "reforma educativa", "senhores deputados"])


_EXPR = [("agua potable", 2), ("mi grupo votara a favor", 5), ("reforma educativa", 2), ("senhores deputados", 2)]
_EXPR_SQL = f"WITH {TURNS}, x AS (SELECT {normal('text')} AS x FROM t WHERE text IS NOT NULL), q AS (" + " UNION ALL ".join(
    f"SELECT '{e}' AS expression, sum(len(regexp_extract_all(x, ' {'  '.join(e.split())} ')))::BIGINT AS n FROM x" for e, _ in _EXPR
) + ") SELECT * FROM q WHERE n > 0"


def concordance(spark, d):
    return X.concordance(turns(spark, d, "text"), "agua potable")


def spoken_chars(spark, d):
    return turns(spark, d, "text").select("id_int", F.length(X.spoken_only("text")).alias("n"))


def stretches(spark, d):
    return turns(spark, d, "text").select("id_int", F.size(X.stretches("text")).alias("n")).where("n > 0")


def candidate_names(spark, d):
    return X.candidate_names(turns(spark, d, "text"))


def recurring_lines(spark, d):
    return X.recurring_lines(turns(spark, d, "id_session", "text"))


_LINES_SQL = f"""WITH {TURNS}, l AS (SELECT id_session, unnest(string_split(text, chr(10))) AS line FROM t), f AS (SELECT id_session, regexp_replace(trim(line, ' '), '\\d+', '9', 'g') AS form FROM l WHERE length(trim(line, ' ')) >= 3 AND length(line) <= 60)
SELECT form, count(DISTINCT id_session) AS sessions, count(*) AS lines FROM f GROUP BY 1 HAVING count(DISTINCT id_session) >= 3"""


def speech_motive(spark, d):
    return turns(spark, d, "text").select(F.coalesce(X.speech_motive(F.col("text")), F.lit("speech")).alias("motive")).groupBy("motive").agg(F.count("*").alias("n"))


_MOTIVE_SQL = f"""WITH {TURNS} SELECT CASE WHEN coalesce(trim(text), '') = '' THEN 'empty'
  WHEN regexp_matches(text, '(?i)votaci[óo]n nominal|votação nominal|votan a favor|votam a favor') OR len(regexp_extract_all(text, '(?i)[\\p{{L}}]+, [\\p{{L}} ]+: (?:s[ií]|não|no|abstención|abstenção)(?:[^\\p{{L}}]|$)')) >= 3 THEN 'vote'
  WHEN regexp_matches(text, '(?i)^\\s*se da lectura|^\\s*lê-se|^\\s*acta n') THEN 'reading' ELSE 'speech' END AS motive, count(*) AS n FROM t GROUP BY 1"""


def tagged_turns(spark, d):
    return X.tag_lines(turns(spark, d, "text").where("text IS NOT NULL"))


def sound_keys(spark, d):
    return table(spark, d, "vocab").select(X.sound_spelling(F.col("word")).alias("k"), "word").groupBy("k").agg(F.countDistinct("word").alias("spellings")).where("spellings > 2")


def name_matches(spark, d):
    rows = turns(spark, d, "country", "id_dep", "speaker_raw").where("id_dep IS NULL AND speaker_raw IS NOT NULL")
    return X.match_names(rows.select("country", F.col("speaker_raw").alias("name")).distinct(), table(spark, d, "deputies"))


def months(spark, d):
    return table(spark, d, "vocab").where(F.length("word") >= 4).select("word", nearest_month(F.col("word")).alias("month")).where("month IS NOT NULL").distinct()


def halves(spark, d):
    return table(spark, d, "mixture_targets").select("source", half_up(F.col("target_share"), 2).alias("share"))


def guarded(spark, d):
    rows = turns(spark, d, "country", "dm_speech", "n_words")
    return C.guarded_sql(spark, "SELECT country, count(*) AS n, max(n_words) AS longest FROM turns WHERE dm_speech = 1 GROUP BY ALL", {"turns": rows})[0]


def longest_per_country(spark, d):
    return C.qualify(turns(spark, d, "country", "n_words").where("n_words IS NOT NULL"), ["country"], [F.desc("n_words"), "id_int"], 3).select("country", "id_int", "n_words")


_CONCORDANCE_SQL = f"""WITH {TURNS}, f AS (SELECT id_int, trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS flat FROM t),
h AS (SELECT *, regexp_extract_all(flat, '(?i)\\b[aáàâã]gua[^\\p{{L}}\\p{{N}}]+p[oóòôõ]t[aáàâã]vel\\b|(?i)\\b[aáàâã]gua[^\\p{{L}}\\p{{N}}]+p[oóòôõ]t[aáàâã]bl[eéèê]\\b') AS hits, string_split_regex(flat, '(?i)\\b[aáàâã]gua[^\\p{{L}}\\p{{N}}]+p[oóòôõ]t[aáàâã]bl[eéèê]\\b') AS parts FROM f),
g AS (SELECT id_int, flat, hits, parts, unnest(range(1, least(len(hits), 3) + 1)) AS k FROM h WHERE len(parts) > 1),
b AS (SELECT id_int, flat, k, hits[k] AS hit, (list_sum(list_transform(parts[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: length(x))), 0))::BIGINT AS b FROM g)
SELECT id_int, k::INT AS place, substring(flat, greatest(b - 40, 0) + 1, least(b, 40)) AS left, hit, substring(flat, b + length(hit) + 1, 40) AS right FROM b""".replace("(?i)\\b[aáàâã]gua[^\\p{L}\\p{N}]+p[oóòôõ]t[aáàâã]vel\\b|", "")
_SPOKEN_SQL = f"""WITH {TURNS} SELECT id_int, length(array_to_string(list_filter(string_split(regexp_replace(text, '\\([^()]{{0,400}}\\)', ' ', 'g'), chr(10)),
  lambda x: NOT (length(regexp_replace(x, '[^\\p{{Lu}}]', '', 'g')) >= 8 AND length(regexp_replace(x, '[^\\p{{Lu}}]', '', 'g')) > 3 * length(regexp_replace(x, '[^\\p{{Ll}}]', '', 'g')))), chr(10)))::INT AS n FROM t"""
_STRETCH_SQL = f"""WITH {TURNS}, k AS (SELECT id_int, len(list_filter(string_split_regex({folded('text')}, '[^\\p{{L}}\\p{{N}}\\s''’-]+|\\n|\\s{{6,}}'), lambda p: regexp_matches(p, '[\\p{{L}}\\p{{N}}]')))::INT AS n FROM t)
SELECT * FROM k WHERE n > 0"""
_CANDIDATE_SQL = f"""WITH {TURNS}, c AS (SELECT id_int, unnest(list_distinct(regexp_extract_all(text, '\\p{{Lu}}[\\p{{L}}]+(?:\\s+(?:de\\s+|del\\s+|da\\s+|do\\s+)?\\p{{Lu}}[\\p{{L}}]+)+|\\p{{Lu}}{{3,}}'))) AS name FROM t),
n AS (SELECT name, count(DISTINCT id_int) AS turns FROM c GROUP BY 1 HAVING count(DISTINCT id_int) >= 3),
w AS (SELECT unnest(regexp_extract_all(text, '[\\p{{L}}]+')) AS t FROM t), u AS (SELECT lower(t) AS low, count(*) AS n, count(*) FILTER (lower(t) = t) AS small FROM w GROUP BY 1)
SELECT name, turns FROM n JOIN u ON lower(regexp_extract(name, '^\\p{{L}}+')) = low WHERE small < n * 0.3::DOUBLE"""
_MARKER = "^\\s*(?:El|La|O|A)\\s+(?:[Ss]r|[Ss]e[ñn]or|[Ss]enhor|SR|SRA)[^:]{2,60}:"
_TAGGED_SQL = f"""WITH {TURNS}, l AS (SELECT id_int, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM t WHERE text IS NOT NULL),
m AS (SELECT *, regexp_matches(line, '{_MARKER}') AS marker FROM l),
n AS (SELECT *, sum(marker::INT) OVER (PARTITION BY id_int ORDER BY pos)::INT AS turn, CASE WHEN marker THEN trim(regexp_replace(regexp_extract(line, '{_MARKER}'), ':\\s*$', ''), ' ') END AS speaker,
  trim(CASE WHEN marker THEN regexp_replace(line, '{_MARKER}', '') ELSE line END, ' ') AS said FROM m)
SELECT id_int, turn, max(speaker) AS speaker, trim(string_agg(said, ' ' ORDER BY pos), ' ') AS text FROM n GROUP BY 1, 2"""


def _without_pairs(sql: str) -> str:
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        sql = f"replace({sql}, '{c}{c}', '{c}')"
    return sql


_SOUND = folded("word")
for _a, _b in (("h", ""), ("z|ç", "s"), ("c([ei])", "s\\1"), ("v", "b"), ("g([ei])", "j\\1"), ("ll", "y")):
    _SOUND = f"regexp_replace({_SOUND}, '{_a}', '{_b}', 'g')"
_SOUND_SQL = f"WITH k AS (SELECT {_without_pairs(_SOUND)} AS k, word FROM vocab) SELECT k, count(DISTINCT word) AS spellings FROM k GROUP BY 1 HAVING count(DISTINCT word) > 2"
_MONTH_SQL = f"""WITH m(name, num) AS (VALUES {', '.join(map(str, MONTHS.items()))}), v AS (SELECT DISTINCT word, lower(word) AS low FROM vocab WHERE length(word) >= 4),
e AS (SELECT word, low, num, min(levenshtein(low, name)) AS d FROM v, m WHERE abs(length(low) - length(name)) <= 3 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY d, num) AS k, lead(d) OVER (PARTITION BY word ORDER BY d, num) AS second FROM e)
SELECT word, num::INT AS month FROM r WHERE k = 1 AND ((d <= greatest(2, length(low) // 2) AND coalesce(second, 99) - d >= 2) OR d = 0)"""
_F_TITLE = "(?i)^\\W*(la|a)\\s+(sra|señora|senhora|diputada|deputada)|^\\W*(sra|diputada|deputada)\\b"
_M_TITLE = "(?i)^\\W*(el|o)\\s+(sr|señor|senhor|diputado|deputado)\\b|^\\W*(sr|diputado|deputado)\\b"
_SEX_SQL = f"""WITH {TURNS}, c AS (SELECT *, CASE WHEN upper(trim(sex)) IN ('F', 'M') THEN upper(trim(sex)) END AS s FROM deputies),
reg AS (SELECT id_dep, min(s) AS registered FROM c WHERE s IS NOT NULL GROUP BY 1 HAVING count(DISTINCT s) = 1),
ty AS (SELECT id_dep, CASE WHEN regexp_matches(speaker_raw, '{_F_TITLE}') THEN 'F' WHEN regexp_matches(speaker_raw, '{_M_TITLE}') THEN 'M' END AS t FROM t WHERE id_dep IS NOT NULL),
ho AS (SELECT id_dep, CASE WHEN count(*) FILTER (t = 'F') >= count(*) * 0.9::DOUBLE THEN 'F' WHEN count(*) FILTER (t = 'F') <= count(*) * (1 - 0.9::DOUBLE) THEN 'M' END AS honorific FROM ty WHERE t IS NOT NULL GROUP BY 1),
pe AS (SELECT id_dep, min(lower(string_split_regex(trim(speaker_name), '\\s+')[1])) AS given FROM deputies WHERE speaker_name IS NOT NULL GROUP BY 1),
le AS (SELECT given, CASE WHEN count(*) >= 2 THEN min(registered) END AS by_name, CASE WHEN count(*) = 1 THEN min(registered) END AS by_rare FROM pe JOIN reg USING (id_dep) GROUP BY 1 HAVING count(DISTINCT registered) = 1),
q AS (SELECT pe.id_dep, registered, honorific, by_name, by_rare, CASE WHEN suffix(given, 'a') THEN 'F' WHEN suffix(given, 'o') THEN 'M' END AS ending FROM pe LEFT JOIN reg USING (id_dep) LEFT JOIN ho USING (id_dep) LEFT JOIN le USING (given))
SELECT id_dep, coalesce(registered, honorific, by_name, by_rare, ending) AS sex, CASE WHEN registered IS NOT NULL THEN 'register' WHEN honorific IS NOT NULL THEN 'honorific' WHEN by_name IS NOT NULL THEN 'name' WHEN by_rare IS NOT NULL THEN 'rare' WHEN ending IS NOT NULL THEN 'ending' END AS sex_source FROM q"""

_ALL = """close_open_terms covering_term in_office merge_ids propagate_district clip_overlaps unknown_ids ambiguous_keys impose_frozen seats_check bound_terms sex_cascade legislature_keys
renumber get_session around order_gaps impute_by_date impute_gap dense_ids chair_segments vocative_sex date_plausibility doubled_sessions keep_best exact_repeats same_day_duplicates copies
seeded_sample round_robin proportional newest matches subset_create subset_rebuild subset_describe presence pair_network pruned_network mention_rank themes coder_agreement prevalence reading_list
folded_words word_counts expressions concordance spoken_chars stretches candidate_names recurring_lines speech_motive tagged_turns sound_keys name_matches months halves guarded longest_per_country""".split()
QUERIES = {name: globals()[name] for name in _ALL} | {"mentions": _mentions} | {f"subset_{op}": _combined(op) for op in ("union", "intersection", "difference")}
SQL = {
    "close_open_terms": f"""WITH {TERMS}, s AS (SELECT country, legislature, min(start_date) AS opens FROM r WHERE start_date IS NOT NULL GROUP BY 1, 2),
n AS (SELECT *, lead(opens) OVER (PARTITION BY country ORDER BY opens, legislature) AS nx FROM s)
SELECT reg_n, coalesce(end_date, nx - 1, DATE '2999-12-31')::DATE AS closed_end FROM r LEFT JOIN n USING (country, legislature)""",
    "covering_term": _COVERING_SQL,
    "in_office": f"WITH {TERMS} SELECT DISTINCT country, id_dep FROM r WHERE start_date <= DATE '2015-06-15' AND coalesce(end_date, DATE '2999-12-31') >= DATE '2015-06-15'",
    "merge_ids": _MERGE_SQL,
    "propagate_district": f"WITH {TURNS}, k AS (SELECT id_dep, min({_SAFE.format('district')}) AS v FROM t WHERE id_dep IS NOT NULL AND {_SAFE.format('district')} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {_SAFE.format('district')}) = 1) SELECT id_int, coalesce({_SAFE.format('district')}, v) AS district FROM t LEFT JOIN k USING (id_dep)",
    "clip_overlaps": _CLIP_SQL,
    "unknown_ids": f"WITH {TURNS} SELECT id_dep, count(*) AS turns FROM t WHERE id_dep IS NOT NULL AND id_dep NOT IN (SELECT id_dep FROM deputies WHERE id_dep IS NOT NULL) GROUP BY 1",
    "ambiguous_keys": f"WITH {TURNS} SELECT country, speaker_raw, count(DISTINCT id_dep) AS persons, count(*) AS turns FROM t WHERE speaker_raw IS NOT NULL AND id_dep IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT id_dep) > 1",
    "impose_frozen": f"WITH {TURNS}, f AS (SELECT country, speaker_raw, min(id_dep) AS f FROM t WHERE id_dep IS NOT NULL AND speaker_raw IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT id_dep) = 1) SELECT id_int, coalesce(f, id_dep) AS id_dep FROM t LEFT JOIN f USING (country, speaker_raw)",
    "seats_check": f"WITH {TERMS}, n AS (SELECT country, legislature, count(DISTINCT id_dep) AS persons FROM r WHERE legislature IS NOT NULL GROUP BY 1, 2), m AS (SELECT country, median(persons)::DOUBLE AS usual FROM n GROUP BY 1) SELECT country, legislature, persons, usual FROM n JOIN m USING (country) WHERE persons > usual * 1.4::DOUBLE",
    "bound_terms": f"WITH {TURNS}, {TERMS}, m AS (SELECT country, legislature, min(date) AS a, max(date) AS b FROM t WHERE date IS NOT NULL GROUP BY 1, 2), c AS (SELECT reg_n, greatest(start_date, a) AS start, least(coalesce(end_date, b), b) AS \"end\" FROM r JOIN m USING (country, legislature) WHERE start_date IS NOT NULL) SELECT * FROM c WHERE start <= \"end\"",
    "legislature_keys": f"WITH {TURNS} SELECT regexp_replace(trim(legislature), '[º°ª.]', '', 'g') AS key, count(*) AS n FROM t GROUP BY 1",
    "renumber": f"WITH {TURNS}, k AS (SELECT id_int, id_session, intervention_order AS o, coalesce(intervention_order = 0, false) AS front FROM t WHERE trim(text, ' ') <> '') SELECT id_int, CASE WHEN front THEN 0 ELSE row_number() OVER (PARTITION BY id_session, front ORDER BY o NULLS LAST, id_int) END::INT AS new_order FROM k",
    "get_session": f"WITH {TURNS} SELECT id_session, id_int, intervention_order, speaker_raw, left(text, 160) AS opening FROM t",
    "around": f"WITH {TURNS}, m AS (SELECT min(id_int) AS m FROM t), k AS (SELECT id_int, id_session, row_number() OVER (PARTITION BY id_session ORDER BY id_int)::INT AS place FROM t) SELECT k.* FROM k, m, k AS c WHERE c.id_int = m AND k.id_session = c.id_session AND abs(k.place - c.place) <= 3",
    "order_gaps": f"WITH {TURNS}, n AS (SELECT DISTINCT id_session, intervention_order AS o FROM t WHERE intervention_order > 0), g AS (SELECT *, lead(o) OVER (PARTITION BY id_session ORDER BY o) AS nx FROM n) SELECT id_session, o AS after, nx AS before, nx - o - 1 AS missing FROM g WHERE nx > o + 1",
    "impute_by_date": _IMPUTE_SQL,
    "impute_gap": f"WITH {TURNS}, {SESSIONS}, k AS (SELECT id_session, country, legislature, CASE WHEN md5(id_session) < 'c' THEN try_cast(session_number AS INT) END AS number FROM s) SELECT id_session, number, coalesce(number, CASE WHEN lead(number) OVER w - lag(number) OVER w = 2 THEN lag(number) OVER w + 1 END) AS imputed FROM k WINDOW w AS (PARTITION BY country, legislature ORDER BY id_session)",
    "dense_ids": _DENSE_SQL,
    "chair_segments": _CHAIR_SQL,
    "vocative_sex": _VOCATIVE_SQL,
    "date_plausibility": f"WITH {TURNS}, {SESSIONS}, k AS (SELECT id_session, date, lag(date) OVER w AS previous, lead(date) OVER w AS next FROM s WINDOW w AS (PARTITION BY country, legislature ORDER BY id_session)) SELECT * FROM k WHERE date < previous OR date > next",
    "concordance": _CONCORDANCE_SQL,
    "spoken_chars": _SPOKEN_SQL,
    "stretches": _STRETCH_SQL,
    "candidate_names": _CANDIDATE_SQL,
    "tagged_turns": _TAGGED_SQL,
    "sound_keys": _SOUND_SQL,
    "months": _MONTH_SQL,
    "sex_cascade": _SEX_SQL,
    "doubled_sessions": _DOUBLED_SQL,
    "keep_best": _BEST_SQL,
    "exact_repeats": f"WITH {TURNS} SELECT md5(text) AS text_md5, count(*) AS copies, min(id_int) AS first_id FROM t WHERE length(text) > 400 GROUP BY legislature, date, speaker_raw, md5(text) HAVING count(*) > 1",
    "same_day_duplicates": _SAME_SQL,
    "copies": "SELECT id_int, count(*) AS copies, min(row_n) AS first_row FROM interventions GROUP BY 1 HAVING count(*) > 1",
    "seeded_sample": f"WITH {TURNS} SELECT id_int, country FROM t ORDER BY md5(id_int || 'seed-1'), id_int LIMIT 50",
    "round_robin": f"WITH {TURNS} SELECT id_int, country, row_number() OVER (PARTITION BY country ORDER BY md5(id_int || 's'), id_int)::INT AS turn FROM t ORDER BY turn, country LIMIT 40",
    "proportional": f"WITH {TURNS}, c AS (SELECT country, count(*) AS n FROM t GROUP BY 1), z AS (SELECT country, n, sum(n) OVER () AS total FROM c), q AS (SELECT country, (60 * n // total)::INT AS q, (60 * n % total) AS rest FROM z), e AS (SELECT country, q + CASE WHEN row_number() OVER (ORDER BY rest DESC, country) <= 60 - sum(q) OVER () THEN 1 ELSE 0 END AS quota FROM q), k AS (SELECT id_int, country, row_number() OVER (PARTITION BY country ORDER BY md5(id_int || 's'), id_int) AS rn FROM t) SELECT id_int, country FROM k JOIN e USING (country) WHERE rn <= quota",
    "newest": f"WITH {TURNS} SELECT id_int, date FROM t WHERE {uses('text', ' agua  potable ')} > 0 ORDER BY date DESC NULLS LAST, id_int LIMIT 20",
    "matches": f"WITH {TURNS}, k AS (SELECT id_int, {uses('text', ' enmienda ')}::INT AS n FROM t) SELECT * FROM k WHERE n > 0",
    "subset_create": _SUBSET_SQL,
    "subset_union": _combined_sql("UNION"),
    "subset_intersection": _combined_sql("INTERSECT"),
    "subset_difference": _combined_sql("EXCEPT"),
    "subset_rebuild": _REBUILD_SQL,
    "subset_describe": _DESCRIBE_SQL,
    "presence": _PRESENCE_SQL + " SELECT * FROM p",
    "pair_network": _PAIR_SQL,
    "pruned_network": f"WITH q AS ({_PAIR_SQL}), e AS (SELECT a, b, co, unnest([a, b]) AS n FROM q), k AS (SELECT a, b, co, row_number() OVER (PARTITION BY n ORDER BY co DESC, a, b) AS r FROM e) SELECT DISTINCT a, b, co FROM k WHERE r <= 2",
    "mentions": _MENTION_SQL,
    "coder_agreement": _KAPPA_SQL,
    "prevalence": _WILSON_SQL,
    "reading_list": _READ_SQL,
    "folded_words": "SELECT trim(strip_accents(lower(word))) AS f, count(*) AS n FROM vocab WHERE trim(strip_accents(lower(word))) <> '' GROUP BY 1",
    "word_counts": f"WITH {TURNS} SELECT id_int, coalesce(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')), 0)::INT AS words FROM t",
    "expressions": _EXPR_SQL,
    "recurring_lines": _LINES_SQL,
    "speech_motive": _MOTIVE_SQL,
    "halves": "SELECT source, floor(target_share * 100 + 0.5) / 100 AS share FROM mixture_targets",
    "guarded": f"WITH {TURNS} SELECT country, count(*) AS n, max(n_words) AS longest FROM t WHERE dm_speech = 1 GROUP BY 1",
    "longest_per_country": f"WITH {TURNS} SELECT country, id_int, n_words FROM t WHERE n_words IS NOT NULL QUALIFY row_number() OVER (PARTITION BY country ORDER BY n_words DESC, id_int) <= 3",
}
