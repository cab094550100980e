"""Queries of parsing, matching and themes over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.terms import CHAIR, NOT_CHAIR
from ..operators import lexicon as W
from ..operators import mentions as M
from ..operators import parsing as G
from ..operators import register as R
from ..operators import rosters as O
from ..session import materialize
from ..sources.tables import one_per_key, table
from .analysis import _GUEST_SQL, _NOBODY_SQL
from .common import SESSIONS, TURNS, folded, sessions, turns


# --- words and themes ---
def _speech_tokens(spark, d):
    return materialize(W.tokens_of(turns(spark, d, "dm_speech", "text").where("dm_speech = 1"), "id_int"), "speech-tokens")


def _network(spark, d):
    """(tokens of the turns that name a hospital, their lexicon, the network) against all speech."""
    every = _speech_tokens(spark, d)
    own = every.where(F.array_contains("w", "hospital"))
    vocabulary = materialize(W.lexicon(W.word_sums(own), W.word_sums(every), W.function_words(every), ["hospital"], threshold=3.84, limit=60), "vocabulary")
    return own, vocabulary, W.word_network(own, vocabulary, 10, 0.0)


def word_lexicon(spark, d):
    return _network(spark, d)[1].select("rank", "fold", F.col("a").alias("n"), F.col("b").alias("n_rest"), F.round("g2", 2).alias("g2"))


def word_network(spark, d):
    return _network(spark, d)[2]


def word_themes(spark, d):
    _, vocabulary, edges = _network(spark, d)
    return W.word_themes(edges, vocabulary)


def theme_statistics(spark, d):
    own, vocabulary, edges = _network(spark, d)
    themes = W.word_themes(edges, vocabulary)
    size = own.agg(F.count("*").alias("n"), F.sum(F.size("w")).alias("w")).first()
    return W.theme_statistics(W.theme_shares(own, themes), size["n"], size["w"] or 0)


def party_words(spark, d):
    rows = turns(spark, d, "dm_speech", "party", "text").where("dm_speech = 1")
    groups = rows.select("id_int", F.nullif(F.trim("party"), F.lit("")).alias("grp"))
    return W.group_words(W.tokens_of(rows, "id_int"), groups, threshold=15.0)


_TOKENS_SQL = f"k AS (SELECT id_int, regexp_extract_all({folded('text')}, '[\\p{{L}}\\p{{N}}]+') AS w FROM t WHERE dm_speech = 1), e AS (SELECT * FROM k WHERE len(w) > 0)"
_LEXICON_SQL = f"""WITH {TURNS}, {_TOKENS_SQL}, o AS (SELECT * FROM e WHERE list_contains(w, 'hospital')),
a AS (SELECT fold, count(*)::DOUBLE AS a FROM (SELECT unnest(w) AS fold FROM o) GROUP BY 1), s AS (SELECT fold, count(*)::DOUBLE AS s FROM (SELECT unnest(w) AS fold FROM e) GROUP BY 1),
z AS (SELECT (SELECT sum(a) FROM a) AS c, (SELECT sum(s) FROM s) - (SELECT sum(a) FROM a) AS d), stop AS (SELECT fold FROM (SELECT unnest(list_distinct(w)) AS fold FROM e) GROUP BY 1 HAVING count(*) >= (SELECT count(*) FROM e) * 0.25::DOUBLE),
j AS (SELECT fold, a, s - a AS b, s, c, d, c + d AS n FROM a JOIN s USING (fold), z WHERE a >= 5),
q AS (SELECT *, 2 * (a * ln(1 + (a - s * (c / n)) / (s * (c / n))) + CASE WHEN b > 0 THEN b * ln(1 + (b - s * (d / n)) / (s * (d / n))) ELSE 0 END
  + CASE WHEN c - a > 0 THEN (c - a) * ln(1 + ((c - a) - (n - s) * (c / n)) / ((n - s) * (c / n))) ELSE 0 END + CASE WHEN d - b > 0 THEN (d - b) * ln(1 + ((d - b) - (n - s) * (d / n)) / ((n - s) * (d / n))) ELSE 0 END) AS g FROM j),
r AS (SELECT fold, a, b, round(CASE WHEN a / c >= b / d THEN g ELSE -g END, 4) AS g2 FROM q),
v AS (SELECT row_number() OVER (ORDER BY g2 DESC, fold)::INT AS rank, fold, a::BIGINT AS n, b::BIGINT AS n_rest, g2 FROM r WHERE g2 >= 3.84 AND length(fold) >= 2 AND NOT regexp_full_match(fold, '\\p{{N}}+') AND fold <> 'hospital' AND fold NOT IN (SELECT fold FROM stop) QUALIFY rank <= 60)"""
_NETWORK_SQL = f"""{_LEXICON_SQL},
h AS (SELECT DISTINCT id_int, rank FROM (SELECT id_int, unnest(w) AS fold FROM o) JOIN v USING (fold)), f AS (SELECT rank, count(*)::DOUBLE AS df FROM h GROUP BY 1), big AS (SELECT count(*)::DOUBLE AS n FROM o),
p AS (SELECT x.rank AS i, y.rank AS j, count(*)::DOUBLE AS co FROM h x JOIN h y ON x.id_int = y.id_int AND x.rank < y.rank GROUP BY 1, 2),
m AS (SELECT i, j, co AS a, fj.df - co AS b, fi.df AS c, n - fi.df AS d, fi.df * fj.df / n AS e FROM p JOIN f fi ON i = fi.rank JOIN f fj ON j = fj.rank, big),
u AS (SELECT *, greatest(0, 2 * (a * ln(1 + (a - c * (a + b) / (c + d)) / (c * (a + b) / (c + d))) + CASE WHEN b > 0 THEN b * ln(1 + (b - d * (a + b) / (c + d)) / (d * (a + b) / (c + d))) ELSE 0 END
  + CASE WHEN c - a > 0 THEN (c - a) * ln(1 + ((c - a) - (c - c * (a + b) / (c + d))) / (c - c * (a + b) / (c + d))) ELSE 0 END
  + CASE WHEN d - b > 0 THEN (d - b) * ln(1 + ((d - b) - (d - d * (a + b) / (c + d))) / (d - d * (a + b) / (c + d))) ELSE 0 END)) AS g2 FROM m WHERE a > e),
n2 AS (SELECT i, j, g2, unnest([i, j]) AS tip FROM u), k2 AS (SELECT DISTINCT i, j FROM (SELECT i, j, row_number() OVER (PARTITION BY tip ORDER BY g2 DESC, i, j) AS k FROM n2) WHERE k <= 10)
SELECT x.fold AS a, y.fold AS b, u.a::BIGINT AS co, round(e, 3) AS expected, round(u.g2, 2) AS g2, round(u.a / e, 4) AS weight FROM u JOIN k2 USING (i, j) JOIN v x ON u.i = x.rank JOIN v y ON u.j = y.rank"""
_PARTY_SQL = f"""WITH {TURNS}, g AS (SELECT id_int, nullif(trim(party), '') AS grp, regexp_extract_all({folded('text')}, '[\\p{{L}}\\p{{N}}]+') AS w FROM t WHERE dm_speech = 1), e AS (SELECT * FROM g WHERE len(w) > 0 AND grp IS NOT NULL),
h AS (SELECT grp, sum(len(w))::DOUBLE AS c FROM e GROUP BY 1 HAVING count(*) >= 5), p AS (SELECT grp, fold, count(*)::DOUBLE AS a FROM (SELECT grp, unnest(w) AS fold FROM e) GROUP BY 1, 2), s AS (SELECT fold, sum(a) AS t FROM p GROUP BY 1),
z AS (SELECT sum(len(w))::DOUBLE AS whole FROM e), m AS (SELECT grp, fold, a, t - a AS b, c, whole - c AS d FROM p JOIN h USING (grp) JOIN s USING (fold), z WHERE a >= 5 AND c < whole),
u AS (SELECT *, greatest(0, 2 * (a * ln(1 + (a - c * (a + b) / (c + d)) / (c * (a + b) / (c + d))) + CASE WHEN b > 0 THEN b * ln(1 + (b - d * (a + b) / (c + d)) / (d * (a + b) / (c + d))) ELSE 0 END
  + CASE WHEN c - a > 0 THEN (c - a) * ln(1 + ((c - a) - (c - c * (a + b) / (c + d))) / (c - c * (a + b) / (c + d))) ELSE 0 END + CASE WHEN d - b > 0 THEN (d - b) * ln(1 + ((d - b) - (d - d * (a + b) / (c + d))) / (d - d * (a + b) / (c + d))) ELSE 0 END)) AS g FROM m)
SELECT grp, fold, a::BIGINT AS a, b::BIGINT AS b, round(CASE WHEN a * d >= b * c THEN g ELSE -g END, 2) AS g2 FROM u WHERE round(CASE WHEN a * d >= b * c THEN g ELSE -g END, 2) >= 15 AND length(fold) > 1"""


# --- mentions ---
def _mention_rows(spark, d):
    register = one_per_key(table(spark, d, "deputies"), "reg_n", "reg_n", ["reg_n", "first_name", "last_name"])
    people = R.close_open_terms(R.typed_terms(table(spark, d, "deputies"))).join(register, "reg_n")
    common = table(spark, d, "vocab").groupBy("country", "fold").agg(F.sum("n").alias("n"))
    from pyspark.sql import Window

    top = common.withColumn("k", F.row_number().over(Window.partitionBy("country").orderBy(F.desc("n"), "fold"))).where("k <= 5000")
    rows = turns(spark, d, "country", "id_dep", "date", "dm_speech", "text").where("dm_speech = 1")
    return M.find_mentions(rows, M.gazetteers(people, top))


def mention_list(spark, d):
    return _mention_rows(spark, d)


def mention_network(spark, d):
    return M.mention_network(materialize(_mention_rows(spark, d), "mentions"))


# --- parsing ---
def speaker_parts(spark, d):
    raw = turns(spark, d, "speaker_raw").where("speaker_raw IS NOT NULL").select("speaker_raw").distinct()
    return raw.withColumn("p", G.speaker_parts(F.col("speaker_raw"))).select("speaker_raw", "p.speaker", "p.party")


_PARTS_SQL = f"""WITH {TURNS}, r AS (SELECT DISTINCT speaker_raw FROM t WHERE speaker_raw IS NOT NULL),
s AS (SELECT speaker_raw, regexp_replace(regexp_replace(trim(speaker_raw, ' '), '^ª\\s+', ''), '^[ao]\\s+(\\p{{Lu}})', '\\1') AS s FROM r),
p AS (SELECT *, nullif(trim(regexp_extract(s, '\\(([^()]+)\\)[)\\s]*[.:,;–—-]*\\s*$', 1), ' '), '') AS party, trim(regexp_replace(s, '\\s*\\([^()]*\\)[)\\s]*[.:,;–—-]*\\s*$', ''), ' ') AS bare FROM s),
n AS (SELECT *, trim(regexp_replace(regexp_replace(bare, '(\\p{{Ll}})(\\p{{Lu}})', '\\1 \\2', 'g'), '[\\s\\-–—!;:.,''"]+$', ''), ' ') AS name FROM p),
o AS (SELECT *, length(s) >= 3 AND NOT regexp_matches(s, '^\\p{{Ll}}') AND NOT (length(s) <= 6 AND regexp_matches(s, '\\p{{L}}') AND NOT regexp_matches(s, '\\p{{Ll}}')) AND NOT regexp_matches(s, '[!?.…]\\s+(?:O|A|El|La)\\s+(?:Sr|Se[ñn])') AND length(name) >= 3 AS ok FROM n)
SELECT speaker_raw, CASE WHEN ok THEN name END AS speaker, CASE WHEN ok THEN party END AS party FROM o"""


def marker_scores(spark, d):
    """Every line of every turn that may open a turn, scored with the register's surnames."""
    rows = turns(spark, d, "text").where("text IS NOT NULL")
    lines = rows.select(F.col("id_int").alias("id"), F.posexplode(F.split("text", "\n")).alias("line", "text"))
    surnames = table(spark, d, "deputies").select(F.explode(F.split(F.lower("last_name"), " ")).alias("w")).select(G.fold("w").alias("fold")).where(F.length("fold") >= 3)
    return G.marker_scores(lines, surnames)


_STRICT_SQL = G.STRICT.replace("'", "''").replace("\\p{Lu}\\s", "\\p{Lu}\\s")
_LOOSE_SQL = G.LOOSE.replace("'", "''")
_MARK_SQL = f"""WITH {TURNS}, x AS (SELECT id_int AS id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM t WHERE text IS NOT NULL),
a AS (SELECT id, n::INT AS line, trim(line, ' ') AS text FROM x),
b AS (SELECT *, regexp_matches(text, '{_STRICT_SQL}') AS strict, trim(regexp_extract(text, '{_LOOSE_SQL}', 1), ' ') AS loose, regexp_extract(text, '{_LOOSE_SQL}', 2) AS bracket, substring(text, length(regexp_extract(text, '{_LOOSE_SQL}', 0)) + 1) AS rest FROM a),
c AS (SELECT id, line, strict, CASE WHEN strict THEN trim(regexp_extract(text, '{_STRICT_SQL}', 1), ' ') ELSE loose END AS name,
  CASE WHEN regexp_matches(rest, '^\\s*\\.\\s*[-–—]') THEN 0.55 WHEN regexp_matches(rest, '^\\s*[-–—.:]') THEN 0.40 ELSE 0.15 END::DOUBLE
  + CASE WHEN regexp_matches(rest, '^\\s*,|^\\s+\\p{{Ll}}') THEN -0.30 WHEN regexp_matches(rest, '^\\s*[.:\\-–—]*\\s*[¿¡«"“]?\\p{{Lu}}') THEN 0.20 ELSE 0 END::DOUBLE
  + CASE WHEN bracket <> '' THEN 0.10 ELSE 0 END::DOUBLE
  + CASE WHEN len(list_filter(string_split_regex(loose, '\\s+'), lambda w: w <> '')) <= 4 AND len(list_filter(string_split_regex(loose, '\\s+'), lambda w: w <> '' AND (length(w) < 2 OR length(w) > 20))) = 0 THEN 0.10 ELSE -0.20 END::DOUBLE AS s FROM b),
k AS (SELECT DISTINCT trim(strip_accents(unnest(string_split(lower(last_name), ' ')))) AS fold FROM deputies), kn AS (SELECT fold FROM k WHERE length(fold) >= 3),
q AS (SELECT id, line, name, strict, CASE WHEN len(list_filter(string_split_regex({folded('name')}, '[^\\p{{L}}]+'), lambda w: w IN (SELECT fold FROM kn))) > 0 THEN s + 0.30 ELSE s END AS s FROM c WHERE name <> ''),
g AS (SELECT id, line, name, strict, CASE WHEN strict THEN 1.0 ELSE round(least(greatest(s, 0), 1), 2) END::DOUBLE AS score FROM q)
SELECT id, line, name, CASE WHEN strict THEN 'strict' WHEN score >= 0.6::DOUBLE THEN 'likely' ELSE 'unsure' END AS kind, score FROM g WHERE strict OR score >= 0.4::DOUBLE"""
_MARK_SQL = _MARK_SQL.replace("len(list_filter(string_split_regex(" + folded("name") + ", '[^\\p{L}]+'), lambda w: w IN (SELECT fold FROM kn))) > 0", "list_has_any(string_split_regex(" + folded("name") + ", '[^\\p{L}]+'), (SELECT list(fold) FROM kn))")


def embedded_turns(spark, d):
    return G.embedded_turns(turns(spark, d, "text"))


_EMBED_SQL = f"""WITH {TURNS}, m AS (SELECT id_int, text, string_split(regexp_replace(text, '(^|[.!?…»)\\]]\\s+|\\n\\s*)({G.EMBEDDED.replace("'", "''")})', '\\1' || chr(30) || '\\2' || chr(30), 'g'), chr(30)) AS p FROM t WHERE text IS NOT NULL),
s AS (SELECT *, list_transform(list_filter(range(3, len(p) + 1), lambda k: k % 2 = 1), lambda k: length(trim(p[k], ' '))) AS said FROM m),
w AS (SELECT *, len(p) < 3 OR length(regexp_replace(p[1], '[^«]', '', 'g')) > length(regexp_replace(p[1], '[^»]', '', 'g')) OR (len(said) >= 3 AND len(list_filter(said, lambda n: n < 20)) * 2 > len(said)) OR length(regexp_replace(text, '[^«]', '', 'g')) < length(regexp_replace(text, '[^»]', '', 'g')) AS whole FROM s),
c AS (SELECT id_int, text, p, whole, unnest(CASE WHEN whole THEN [0] ELSE range(0, len(p) // 2 + 1) END) AS part FROM w),
o AS (SELECT id_int, part::INT AS part, CASE WHEN part > 0 THEN trim(p[2 * part], ' ') END AS label, trim(CASE WHEN whole THEN text ELSE p[2 * part + 1] END, ' ') AS text FROM c)
SELECT * FROM o WHERE text <> ''"""


def roll_calls(spark, d):
    return G.roll_calls(turns(spark, d, "text"))


_VOTES = G.VOTES.replace(r"(?![\p{L}])", r"(?:[^\p{L}]|$)").replace("'", "''")
_ROLL_SQL = f"""WITH {TURNS}, e AS (SELECT id_int, unnest(regexp_extract_all(text, '{_VOTES}')) AS entry, generate_subscripts(regexp_extract_all(text, '{_VOTES}'), 1) AS k FROM t WHERE text IS NOT NULL),
p AS (SELECT id_int, k::INT AS place, regexp_extract(entry, '^([^,]*), ([^:]*): (\\p{{L}}+)', ['s', 'g', 'v']) AS x FROM e)
SELECT id_int, place, x['s'] || ', ' || trim(x['g'], ' ') AS name, CASE WHEN x['v'] IN ('sí', 'sim', 'si') THEN 'yes' WHEN x['v'] IN ('não', 'no') THEN 'no' ELSE 'abstained' END AS vote FROM p"""


def attendance(spark, d):
    return G.attendance(turns(spark, d, "text"))


def line_shapes(spark, d):
    return G.line_shapes(turns(spark, d, "id_session", "text"))


def read_documents(spark, d):
    return G.read_documents(turns(spark, d, "text"), 2)


def session_headers(spark, d):
    """The text of each sitting's first turn, read as a header."""
    first = turns(spark, d, "id_session", "text").groupBy("id_session").agg(F.min_by("text", "id_int").alias("text"))
    return G.session_header(first.select(F.col("id_session").alias("id"), "text")).select("id", "date", "date_source", "session_type", "president", "missing")


# --- matching ---
def match_cascade(spark, d):
    rows = turns(spark, d, "country", "id_session", "legislature", "speaker_raw", "id_dep")
    return O.match_cascade(rows, rows, [["id_session", "speaker_raw"], ["country", "legislature", "speaker_raw"], ["country", "speaker_raw"]]).select("id_int", "id_dep", "match_level")


def _level(n, keys):
    return f"m{n} AS (SELECT {keys}, min(id_dep) AS v{n} FROM s WHERE id_dep IS NOT NULL AND {' AND '.join(f'{k} IS NOT NULL' for k in keys.split(', '))} GROUP BY {keys} HAVING count(DISTINCT id_dep) = 1)"


_SAFE_ID = "CASE WHEN trim(id_dep) <> '' AND lower(trim(id_dep)) NOT IN ('nan', 'none', 'null') THEN trim(id_dep) END"
_CASCADE_SQL = f"""WITH {TURNS}, s AS (SELECT id_int, country, id_session, legislature, speaker_raw, {_SAFE_ID} AS id_dep FROM t),
{_level(1, 'id_session, speaker_raw')}, {_level(2, 'country, legislature, speaker_raw')}, {_level(3, 'country, speaker_raw')}
SELECT id_int, coalesce(id_dep, v1, v2, v3) AS id_dep, CASE WHEN id_dep IS NOT NULL THEN 0 WHEN v1 IS NOT NULL THEN 1 WHEN v2 IS NOT NULL THEN 2 WHEN v3 IS NOT NULL THEN 3 END AS match_level
FROM s LEFT JOIN m1 USING (id_session, speaker_raw) LEFT JOIN m2 USING (country, legislature, speaker_raw) LEFT JOIN m3 USING (country, speaker_raw)"""


def match_rate(spark, d):
    return O.match_rate(turns(spark, d, "country", "speaker_raw", "id_dep"), "country")


def match_present(spark, d):
    """Present are those who speak in the sitting under their own id; names are the register's."""
    rows = turns(spark, d, "id_session", "speaker_raw", "id_dep")
    names = table(spark, d, "deputies").where("id_dep IS NOT NULL").select("id_dep", F.explode(F.array("speaker_name", "last_name")).alias("name")).where("name IS NOT NULL").distinct()
    return O.match_present(rows, rows.where("id_dep IS NOT NULL").select("id_session", "id_dep").distinct().join(names, "id_dep"))


_SKEL = "regexp_replace(regexp_replace(regexp_replace(trim(strip_accents(lower({0}))), '^\\W*(?:(?:el|la|o|a)\\s+)?(?:sr|sra|senor|senora|senhor|senhora|dip|dep|diputad[oa]|deputad[oa])\\b\\.?', ''), '\\([^)]*\\)', '', 'g'), '[^\\p{{L}}]', '', 'g')"
_PRESENT_SQL = f"""WITH {TURNS}, n AS (SELECT DISTINCT id_dep, unnest([speaker_name, last_name]) AS name FROM deputies WHERE id_dep IS NOT NULL), q AS (SELECT DISTINCT id_session, id_dep FROM t WHERE id_dep IS NOT NULL),
w AS (SELECT DISTINCT id_session, q.id_dep, {_SKEL.format('name')} AS k FROM q JOIN n USING (id_dep) WHERE name IS NOT NULL), a AS (SELECT id_session, id_int, {_SKEL.format('speaker_raw')} AS s FROM t WHERE id_dep IS NULL)
SELECT id_int, min(w.id_dep) AS id_dep FROM a JOIN w ON a.id_session = w.id_session AND length(k) >= 4 AND suffix(s, k) GROUP BY 1 HAVING count(DISTINCT w.id_dep) = 1"""


def session_numbers(spark, d):
    return turns(spark, d, "session_number", "session_type", "sex").select(
        "id_int", O.valid_number(F.col("session_number")).alias("number"), O.session_type_form(F.col("session_type")).alias("kind"), O.sex_form(F.col("sex")).alias("sex")
    )


_FORMS_SQL = f"""WITH {TURNS}, k AS (SELECT id_int, regexp_replace(trim(session_number, ' '), '\\.0+$', '') AS n, {folded('session_type')} AS y, {folded('sex')} AS x FROM t)
SELECT id_int, CASE WHEN regexp_full_match(n, '\\d+') THEN coalesce(nullif(ltrim(n, '0'), ''), '0') WHEN regexp_full_match(n, '[\\p{{L}}\\d]*\\d[\\p{{L}}\\d]*(?:-[\\p{{L}}\\d]+)?') THEN regexp_replace(upper(n), '^0+(\\d)', '\\1') END AS number,
  nullif(CASE WHEN starts_with(y, 'extraordinari') THEN 'extraordinaria' WHEN starts_with(y, 'ordinari') THEN 'ordinaria' WHEN starts_with(y, 'especia') THEN 'especial' WHEN regexp_matches(y, '^sole[mn]') THEN 'solemne' ELSE y END, '') AS kind,
  CASE WHEN x IN ('f', 'mujer', 'mulher', 'femenino', 'feminino') THEN 'F' WHEN x IN ('m', 'h', 'hombre', 'homem', 'masculino') THEN 'M' END AS sex FROM k"""


def standardize(spark, d):
    """All turns under other column names, brought back to the canonical form."""
    raw = turns(spark, d, "*").withColumnsRenamed({"speaker_raw": "orador", "text": "texto", "session_number": "numero"}).withColumn("date", F.col("date").cast("string"))
    out = O.standardize(raw, {"speaker_raw": ["orador", "interviniente"], "text": ["texto"], "session_number": ["numero"]}, "XX")
    return out.select("id_int", "session_number", "session_type", "sex", "date", "speaker_name", "new_order")


def name_parts(spark, d):
    raw = table(spark, d, "deputies").where("speaker_name IS NOT NULL").select("speaker_name").distinct()
    return raw.withColumn("p", O.name_parts(F.col("speaker_name"))).select("speaker_name", "p.given", "p.surnames")


def presidency(spark, d):
    return O.presidency(turns(spark, d, "id_session", "country", "speaker_raw", "text"), table(spark, d, "deputies"))


def without_chair(spark, d):
    return O.without_chair(turns(spark, d, "id_session", "speaker_raw"))


def explained_gaps(spark, d):
    """Gaps of the numbered turns that have text, explained by those without."""
    from ..operators.sequence import order_gaps

    rows = turns(spark, d, "id_session", "intervention_order", "text")
    kept, removed = rows.where("trim(text) <> ''"), rows.where("coalesce(trim(text), '') = ''")
    return O.explained_gaps(order_gaps(kept), removed)


_GAPS_SQL = f"""WITH {TURNS}, n AS (SELECT DISTINCT id_session, intervention_order AS o FROM t WHERE trim(text, ' ') <> '' AND intervention_order > 0), g AS (SELECT id_session, o AS after, lead(o) OVER (PARTITION BY id_session ORDER BY o) AS before FROM n),
h AS (SELECT *, before - after - 1 AS missing FROM g WHERE before > after + 1), x AS (SELECT DISTINCT id_session, intervention_order AS o FROM t WHERE coalesce(trim(text, ' '), '') = '' AND intervention_order IS NOT NULL),
y AS (SELECT h.id_session, after, before, missing, count(x.o) AS explained FROM h LEFT JOIN x ON h.id_session = x.id_session AND x.o > after AND x.o < before GROUP BY ALL)
SELECT *, missing - explained AS orphan FROM y"""


def number_tail(spark, d):
    s = sessions(spark, d).withColumn("number", F.when(F.md5("id_session") < "9", F.expr("try_cast(session_number AS int)")))
    return O.number_tail(s.select("id_session", "country", "legislature", "number")).select("id_session", "imputed")


def regroup_days(spark, d):
    return O.regroup_days(turns(spark, d, "country", "date", "id_session", "intervention_order"))


def mode_per_key(spark, d):
    return O.mode_per_key(turns(spark, d, "id_dep", "party"), "id_dep", "party")


def linkage_by_words(spark, d):
    rows = turns(spark, d, "country", "dm_speech", "id_dep", "speaker_raw", "n_words")
    nobody = F.coalesce(F.col("speaker_raw").rlike(r"(?iu)^\W*(una voz|um? senhor|varios|vários|voces|vozes|\(sin|la presidencia|a presidência|mesa|comisi|comiss)"), F.lit(False))
    guest = F.coalesce(F.col("speaker_raw").rlike(r"(?iu)^\W*(invitad|convidad|el ministro|la ministra|o ministro|a ministra)"), F.lit(False))
    return O.linkage(rows, guest, nobody)


def edge_losses(spark, d):
    return O.edge_losses(turns(spark, d, "text"))


_LINES = "l AS (SELECT id_int, unnest(string_split(lower(text), chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM t WHERE text IS NOT NULL), w AS (SELECT id_int, n, regexp_extract_all(line, '\\p{L}+') AS w FROM l), v AS (SELECT * FROM w WHERE len(w) > 0)"
_EDGE_SQL = f"""WITH {TURNS}, {_LINES}, i AS (SELECT word FROM (SELECT unnest(w[2:len(w) - 1]) AS word FROM v) GROUP BY 1 HAVING count(*) >= 3),
f AS (SELECT w[1] AS word, lag(w[-1]) OVER (PARTITION BY id_int ORDER BY n) || w[1] AS joined FROM v)
SELECT CASE WHEN word IN (SELECT word FROM i) THEN 'word' WHEN joined IN (SELECT word FROM i) THEN 'split' ELSE 'cut' END AS kind, count(*) AS n FROM f WHERE joined IS NOT NULL GROUP BY 1"""

_TAIL_SQL = f"""WITH {TURNS}, {SESSIONS}, k AS (SELECT id_session, country, legislature, CASE WHEN md5(id_session) < '9' THEN try_cast(session_number AS INT) END AS number FROM s),
r AS (SELECT *, row_number() OVER w AS rn FROM k WINDOW w AS (PARTITION BY country, legislature ORDER BY id_session)),
a AS (SELECT *, last_value(number IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_n, first_value(number IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_n,
  max(CASE WHEN number IS NOT NULL THEN rn END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS at_n FROM r WINDOW w AS (PARTITION BY country, legislature ORDER BY id_session))
SELECT id_session, coalesce(number, CASE WHEN next_n IS NULL THEN last_n + (rn - at_n) END)::INT AS imputed FROM a"""
_DOC_LINE = "^\\s*(?:(?:Art[íi]culo|Artigo|Art\\.)\\s*\\d+|\\d+[.)º°-]\\s|[\\p{Lu}\\s]{8,}$)"
_READ_SQL = f"""WITH {TURNS}, l AS (SELECT id_int, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT - 1 AS pos FROM t WHERE text IS NOT NULL),
d AS (SELECT id_int, pos FROM l WHERE regexp_matches(line, '{_DOC_LINE}')), n AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY id_int ORDER BY pos) <= 2 THEN 0 ELSE 1 END AS fresh FROM d),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY id_int ORDER BY pos)::INT AS block FROM n)
SELECT id_int, block, min(pos)::INT AS begins, max(pos)::INT AS ends, count(*) AS lines FROM b GROUP BY 1, 2 HAVING count(*) >= 2"""
_SHAPE = "trim(line, ' ')"
for _a, _b in (("\\p{Lu}+", "A"), ("[\\p{Ll}\\p{Lo}\\p{Lt}\\p{Lm}]+", "a"), ("\\d+", "9"), ("\\s+", " "), ("(?:[Aa]+ ){2,}", "w ")):
    _SHAPE = f"regexp_replace({_SHAPE}, '{_a}', '{_b}', 'g')"
_SHAPES_SQL = f"WITH {TURNS}, l AS (SELECT id_session, unnest(string_split(text, chr(10))) AS line FROM t WHERE text IS NOT NULL), s AS (SELECT id_session, left({_SHAPE}, 40) AS shape FROM l WHERE trim(line, ' ') <> '') SELECT shape, count(*) AS lines, count(DISTINCT id_session) AS sessions FROM s GROUP BY 1 HAVING count(*) >= 3"
_KEYED = "array_to_string(list_sort(list_filter(string_split_regex(trim(strip_accents(lower({0}))), '[^\\p{{L}}]+'), lambda x: length(x) > 2)), ' ')"
_PRESIDE_SQL = f"""WITH {TURNS}, p AS (SELECT DISTINCT country, id_dep, unnest([{_KEYED.format('speaker_name')}, {_KEYED.format('last_name')}]) AS k FROM deputies WHERE speaker_name IS NOT NULL),
u AS (SELECT country, k, min(id_dep) AS chair_id FROM p WHERE k <> '' GROUP BY 1, 2 HAVING count(DISTINCT id_dep) = 1),
n AS (SELECT id_int, id_session, country, coalesce(CASE WHEN regexp_matches(speaker_raw, '{CHAIR.replace('(?iu)', '(?i)')}') AND NOT regexp_matches(speaker_raw, '{NOT_CHAIR.replace('(?iu)', '(?i)')}') THEN nullif(trim(regexp_extract(speaker_raw, '\\(([^)]{{3,}})\\)', 1), ' '), '') END,
  nullif(trim(regexp_extract(coalesce(text, ''), '{O.DECLARED.replace('(?iu)', '(?i)').replace("'", "''")}', 1), ' '), '')) AS named FROM t),
j AS (SELECT id_int, id_session, named, chair_id FROM (SELECT *, {_KEYED.format('named')} AS k FROM n) LEFT JOIN u USING (country, k)),
h AS (SELECT id_int, id_session, last_value(CASE WHEN named IS NOT NULL THEN {{'n': named, 'c': chair_id}} END IGNORE NULLS) OVER (PARTITION BY id_session ORDER BY id_int ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h FROM j)
SELECT id_int, id_session, upper(h.n) AS chair, h.c AS chair_id FROM h WHERE h IS NOT NULL"""
_STANDARD_SQL = f"""{_FORMS_SQL.split(')' + chr(10) + 'SELECT id_int')[0].replace('SELECT id_int,', 'SELECT id_int, date, id_session, intervention_order, speaker_name,')})
SELECT id_int, {_FORMS_SQL.split('SELECT id_int, ', 2)[2].replace(' AS number', ' AS session_number').replace(' AS kind', ' AS session_type').rsplit(' FROM k', 1)[0]}, date, CASE WHEN trim(speaker_name) <> '' THEN upper(trim(speaker_name, ' ')) END AS speaker_name,
  row_number() OVER (PARTITION BY id_session ORDER BY intervention_order NULLS LAST, id_int)::INT AS new_order FROM k"""

_NAMES = """word_lexicon word_network word_themes theme_statistics party_words mention_list mention_network speaker_parts marker_scores embedded_turns roll_calls attendance line_shapes read_documents session_headers
match_cascade match_rate match_present session_numbers standardize name_parts presidency without_chair explained_gaps number_tail regroup_days mode_per_key linkage_by_words edge_losses""".split()
QUERIES = {name: globals()[name] for name in _NAMES}
SQL = {
    "word_lexicon": _LEXICON_SQL + " SELECT rank, fold, n, n_rest, round(g2, 2) AS g2 FROM v",
    "word_network": _NETWORK_SQL,
    "party_words": _PARTY_SQL,
    "speaker_parts": _PARTS_SQL,
    "marker_scores": _MARK_SQL,
    "embedded_turns": _EMBED_SQL,
    "roll_calls": _ROLL_SQL,
    "attendance": f"WITH {TURNS}, k AS (SELECT id_int, try_cast(nullif(regexp_extract(text, '(?i)(?:^|[^\\p{{L}}])presentes\\s*:?\\s*(\\d+)', 1), '') AS INT) AS present, try_cast(nullif(regexp_extract(text, '(?i)(?:^|[^\\p{{L}}])ausentes\\s*:?\\s*(\\d+)', 1), '') AS INT) AS absent FROM t) SELECT * FROM k WHERE present IS NOT NULL OR absent IS NOT NULL",
    "match_cascade": _CASCADE_SQL,
    "match_rate": f"WITH {TURNS} SELECT country, count(*) AS n_rows, count(*) FILTER (trim(speaker_raw) <> '') AS with_speaker, count(*) FILTER (trim(speaker_raw) <> '' AND {_SAFE_ID} IS NOT NULL) AS matched, round(count(*) FILTER (trim(speaker_raw) <> '' AND {_SAFE_ID} IS NOT NULL) * 100.0::DOUBLE / nullif(count(*) FILTER (trim(speaker_raw) <> ''), 0), 2) AS pct FROM t GROUP BY 1",
    "match_present": _PRESENT_SQL,
    "session_numbers": _FORMS_SQL,
    "without_chair": f"WITH {TURNS} SELECT id_session, count(*) AS turns FROM t GROUP BY 1 HAVING count(*) FILTER (coalesce(regexp_matches(speaker_raw, '(?i)presid|vicepresid') AND NOT regexp_matches(speaker_raw, '(?i)rep[uú]blica|gobierno|governo|conselho de ministros|consejo de ministros|constitucional'), false)) = 0",
    "explained_gaps": _GAPS_SQL,
    "regroup_days": f"WITH {TURNS} SELECT id_int, row_number() OVER (PARTITION BY country, date ORDER BY id_session, intervention_order NULLS LAST, id_int)::INT AS day_order FROM t WHERE date IS NOT NULL",
    "mode_per_key": f"WITH {TURNS}, n AS (SELECT id_dep, party, count(*) AS n FROM t WHERE id_dep IS NOT NULL AND party IS NOT NULL GROUP BY 1, 2) SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id_dep ORDER BY n DESC, party) = 1",
    "linkage_by_words": f"""WITH {TURNS}, g AS (SELECT country, coalesce(sum(n_words) FILTER (dm_speech = 1), 0)::BIGINT AS words, coalesce(sum(n_words) FILTER (dm_speech = 1 AND id_dep IS NOT NULL), 0)::BIGINT AS linked_words,
  coalesce(sum(n_words) FILTER (dm_speech = 1 AND {_GUEST_SQL}), 0)::BIGINT AS guest_words, coalesce(sum(n_words) FILTER (dm_speech = 1 AND NOT {_GUEST_SQL} AND {_NOBODY_SQL}), 0)::BIGINT AS nobody_words FROM t GROUP BY 1)
SELECT *, round(linked_words * 100.0::DOUBLE / nullif(words - guest_words - nobody_words, 0), 2) AS pct FROM g""",
    "edge_losses": _EDGE_SQL,
    "number_tail": _TAIL_SQL,
    "read_documents": _READ_SQL,
    "line_shapes": _SHAPES_SQL,
    "presidency": _PRESIDE_SQL,
    "standardize": _STANDARD_SQL,
}
