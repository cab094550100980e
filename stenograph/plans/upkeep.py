"""Queries of page cleaning, named subsets and publishing over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.terms import Selection, since, speeches
from ..operators import libraries as L
from ..operators import networks as N
from ..functions import text as T
from ..operators import pages as P
from ..operators import parsing as G
from ..operators import register as R
from ..operators import rosters as O
from ..session import scratch_path
from ..sources import publishing as B
from ..sources.tables import table
from .common import TERMS, TURNS, terms, turns, uses
from .pipeline import _SKEL


def _texts(spark, d):
    return turns(spark, d, "text").select(F.col("id_int").alias("id"), "text")


def unpaged_furniture(spark, d):
    return P.unpaged_furniture(_texts(spark, d), 2)


def folio_lines(spark, d):
    return P.folio_lines(turns(spark, d, "date", "text"))


_FOLIO = "(?i)^\\W*(?:p[áa]g(?:ina)?\\.?\\s*)?\\d{1,5}\\W*$"
_FOLIO_SQL = f"""WITH {TURNS}, l AS (SELECT id_int, date, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT - 1 AS pos FROM t WHERE text IS NOT NULL),
m AS (SELECT id_int, pos, regexp_matches(trim(line, ' '), '{_FOLIO}') AS folio, coalesce(abs(date_diff('day', date, try_strptime(regexp_extract(line, '(\\d{{2}}/\\d{{2}}/\\d{{4}})', 1), '%d/%m/%Y')::DATE)) <= 3 AND length(trim(line, ' ')) <= 70, false) AS near FROM l),
c AS (SELECT *, coalesce(lag(folio OR near) OVER w, false) OR coalesce(lead(folio OR near) OVER w, false) AS company FROM m WINDOW w AS (PARTITION BY id_int ORDER BY pos))
SELECT id_int, pos::INT AS at, CASE WHEN folio THEN 'folio' ELSE 'dated' END AS kind FROM c WHERE folio OR (near AND company)"""


def cut_words(spark, d):
    return P.cut_words(_texts(spark, d))


_HALVES = "(\\p{L}+)[-‐¬\\x{AD}][ \\t]*\\n[ \\t]*(\\p{L}+)"
_CUT_SQL = f"""WITH {TURNS}, b AS (SELECT lower(text) AS t FROM t WHERE text IS NOT NULL), c AS (SELECT unnest(regexp_extract_all(t, '{_HALVES}')) AS c FROM b),
h AS (SELECT regexp_extract(c, '{_HALVES}', 1) AS head, regexp_extract(c, '{_HALVES}', 2) AS tail, count(*) AS n FROM c GROUP BY 1, 2),
w AS (SELECT w, count(*) AS k FROM (SELECT unnest(regexp_extract_all(regexp_replace(t, '{_HALVES}', ' ', 'g'), '\\p{{L}}+(?:-\\p{{L}}+)*')) AS w FROM b) GROUP BY 1),
j AS (SELECT head, tail, n, coalesce(x.k, 0) AS joined_n, coalesce(y.k, 0) AS hyphened_n, coalesce(z.k, 0) AS head_n FROM h LEFT JOIN w x ON x.w = head || tail LEFT JOIN w y ON y.w = head || '-' || tail LEFT JOIN w z ON z.w = head)
SELECT head, tail, n, joined_n, hyphened_n, joined_n >= hyphened_n AND joined_n >= least(30, greatest(1, head_n // 10)) AS joins FROM j""".replace("{{L}}", "{L}")


def joined_words(spark, d):
    texts = _texts(spark, d)
    return P.join_cut_words(texts, P.cut_words(texts)).select("id", F.md5("text").alias("text_md5"), F.length("text").alias("n"))


def cleaned_lines(spark, d):
    """Each text without leaders and junk lines, reflowed, its titles joined; its box width and its notes."""
    t = _texts(spark, d)
    return t.select(
        "id", F.md5(P.reflow(P.drop_junk(P.trim_leaders(F.col("text"))))).alias("clean_md5"), F.length(P.join_titles(F.col("text"))).alias("n"), P.box_width(F.col("text")).alias("width"), F.size(P.commentary(F.col("text"))["notes"]).alias("notes")
    )


_LEADERS = "regexp_replace(text, '(?m)[ \\t]*(?:\\.[ \\t]*){4,}\\d*[ \\t]*$', '', 'g')"
_JUNK = f"array_to_string(list_filter(string_split({_LEADERS}, chr(10)), lambda x: length(trim(x, ' ')) < 4 OR length(regexp_replace(x, '[^\\p{{L}}\\p{{N}}]', '', 'g')) >= length(trim(x, ' ')) * 0.4::DOUBLE), chr(10))"
_FLOW = "regexp_replace({0}, '([^.!?…:\\n])[ \\t]*\\n[ \\t]*(\\p{{Ll}})', '\\1 \\2', 'g')"
_CLEAN_SQL = f"""WITH {TURNS}, k AS (SELECT id_int AS id, text, list_sort(list_transform(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> ''), lambda x: length(x))) AS w FROM t)
SELECT id, md5({_FLOW.format(_FLOW.format(_JUNK))}) AS clean_md5, length(regexp_replace(text, '(?m)^([\\p{{Lu}} ]{{6,}})\\n([\\p{{Lu}} ]{{3,}})$', '\\1 \\2', 'g'))::INT AS n, w[ceil(len(w) * 0.9::DOUBLE)::INT]::INT AS width, len(regexp_extract_all(text, '\\([^()]*\\)'))::INT AS notes FROM k"""


def repetitions(spark, d):
    return P.repetitions(turns(spark, d, "id_session", "text"), 40)


# --- subsets and results ---
def subset_by_country(spark, d):
    """Hospitals everywhere, but in Portugal taxes, and in Brazil only around an event."""
    rows = turns(spark, d, "country", "date", "dm_speech", "text")
    own = {"PT": {"variants": ["imposto"]}, "BR": {"variants": ["hospital"], "event": ("2015-06-15", 400, 400)}}
    return L.create_by_country(rows, {"variants": ["hospital"], "selection": Selection(speeches())}, own).select("id_int", "country", "occ")


def subset_from_query(spark, d):
    rows = turns(spark, d, "country", "n_words", "text")
    sql = "SELECT id_int FROM turns WHERE n_words > 100"
    return L.create_from_query(spark, sql, rows, {"turns": rows.select("id_int", "n_words")}).select("id_int", "country")


def subset_listing(spark, d):
    """Two subsets kept, a third kept and deleted again, and the list of what is there."""
    rows, store = turns(spark, d, "country", "date", "dm_speech", "text"), scratch_path(spark, "subsets")
    for name, word in (("health", "hospital"), ("schools", "escuela"), ("gone", "deuda")):
        L.save(L.create(rows, [word], Selection(speeches(), since("2000"))), store, name, {"terms": [word]})
    L.delete(spark, store, "gone")
    return L.listing(spark, store).select("name", "turns", F.size("countries").alias("countries"), "definition")


def subset_notes(spark, d):
    rows = turns(spark, d, "country", "id_session", "id_dep", "dm_speech", "n_words", "sex", "speaker_raw", "date", "text")
    return L.notes(L.describe(L.create(rows, ["hospital"], Selection(speeches())), rows))


def whitelisted(spark, d):
    """Turns of the sexes that count as known, and what else is written there."""
    rows = turns(spark, d, "sex")
    kept, rest = B.whitelist(rows, "sex", spark.createDataFrame([("F",), ("M",)], "sex string"))
    return kept.groupBy("sex").agg(F.count("*").alias("n")).withColumn("listed", F.lit(True)).unionByName(rest.withColumn("listed", F.lit(False)))


def published(spark, d):
    """All turns written through the checks and read back; a table with repeated keys is refused and leaves them as they are."""
    path = scratch_path(spark, "published")
    rows = turns(spark, d, "country")
    B.publish(rows, path, "id_int")
    try:
        B.publish(rows.unionByName(rows), path, "id_int")
    except B.BadTable:
        pass
    return spark.read.parquet(path).groupBy("country").agg(F.count("*").alias("n"))


def sql_functions(spark, d):
    B.register_functions(spark)
    turns(spark, d, "text").createOrReplaceTempView("st_turns")
    return spark.sql("SELECT id_int, st_count_words(text) AS n_words, size(st_words(text)) AS n_folded, md5(st_fold(text)) AS fold_md5 FROM st_turns")


def exported_network(spark, d):
    """The co-mention network written as tables and GraphML, and its edges read back."""
    from .relations import ENTITIES

    folder = scratch_path(spark, "network")
    rows = turns(spark, d, "dm_speech", "text").where("dm_speech = 1")
    edges = N.pair_network(N.entity_presence(rows, ENTITIES), rows.count(), 2, -1.0).select(F.col("a").alias("source"), F.col("b").alias("target"), F.col("co").alias("weight"))
    nodes = edges.select(F.col("source").alias("id")).union(edges.select("target")).distinct()
    B.export_network(nodes, edges, folder)
    return spark.read.option("header", True).csv(f"{folder}/edges").select("source", "target", F.col("weight").cast("bigint").alias("weight"))


def ambiguity_alerts(spark, d):
    from .relations import ENTITIES

    rows = turns(spark, d, "dm_speech", "text").where("dm_speech = 1")
    named = [*ENTITIES, ("ley", "ley"), ("que", "que")]
    return B.ambiguity_alerts(N.entity_presence(rows, named), rows, named)


def imported_folder(spark, d):
    """Two chambers exported as CSV files, imported from their folder, and indexed."""
    folder = scratch_path(spark, "csv-folder")
    rows = turns(spark, d, "*")
    for country in ("PT", "UY"):
        one = rows.where(F.col("country") == country).drop("country")
        _single_csv(spark, one, f"{folder}/{country}_turns.csv")
    target = scratch_path(spark, "imported")
    B.import_folder(spark, folder, target)
    got = spark.read.parquet(target)
    out = scratch_path(spark, "indexes")
    B.reindex(got, table(spark, d, "datasets"), out)
    return spark.read.parquet(f"{out}/unigrams").groupBy("country", "year").agg(F.sum("n").alias("n"))


def _single_csv(spark, df, path):
    """One CSV file at ``path``, as a chamber delivers it."""
    import uuid

    beside = f"{path}-{uuid.uuid4().hex[:6]}.parts"
    df.coalesce(1).write.option("header", True).option("quote", '"').option("escape", '"').csv(beside)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(beside)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("part-"))
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(path))
    fs.delete(where, True)


def narrated_turns(spark, d):
    return G.narrated_turns(turns(spark, d, "text"))


_NARRATED = G.NARRATED.replace("'", "''")
_NARRATED_SQL = f"""WITH {TURNS}, e AS (SELECT id_int, unnest(regexp_extract_all(text, '{_NARRATED}')) AS m, generate_subscripts(regexp_extract_all(text, '{_NARRATED}'), 1)::INT AS place FROM t WHERE text IS NOT NULL)
SELECT id_int, place, regexp_extract(m, '{_NARRATED}', 1) AS speaker, trim(regexp_extract(m, '{_NARRATED}', 2), ' ') AS text FROM e"""


def front_of_sittings(spark, d):
    return G.front_of_sittings(turns(spark, d, "id_session", "text"))


_FRONT = "(?s)^(.*?)(?:\\n|[.!?…»)\\]]\\s)\\s*(?:" + G.EMBEDDED.replace("'", "''") + ")"
_FRONT_SQL = f"""WITH {TURNS}, f AS (SELECT id_session, first(id_int ORDER BY id_int) AS id_int, first(text ORDER BY id_int) AS text FROM t WHERE text IS NOT NULL GROUP BY 1),
p AS (SELECT id_session, id_int, text, regexp_extract(text, '{_FRONT}', 1) AS front FROM f),
q AS (SELECT id_session, id_int, 0 AS part, trim(front, ' ') AS text FROM p UNION ALL SELECT id_session, id_int, 1, trim(substring(text, length(front) + 1), ' ') FROM p)
SELECT * FROM q WHERE text <> ''"""


def review_sheet(spark, d):
    return R.review_sheet(turns(spark, d, "country", "speaker_raw"), "country", "id_int", 20).select("country", "id_int", "place")


def citations(spark, d):
    rows = turns(spark, d, "country", "speaker_name", "party", "date")
    return rows.select("id_int", T.citation(F.col("speaker_name"), F.col("party"), F.col("country"), F.col("date")).alias("cited"), T.slug("speaker_name").alias("slug"))


def trimmed_network(spark, d):
    from .relations import pair_network

    return N.trim_nodes(pair_network(spark, d), "co", 5).select("a", "b", "co")


def match_by_name(spark, d):
    return O.match_names(turns(spark, d, "country", "date", "speaker_raw", "id_dep"), terms(spark, d))


def mended_names(spark, d):
    return O.mend_names(turns(spark, d, "country", "speaker_raw"), table(spark, d, "deputies"))


_MEND_SQL = f"""WITH {TURNS}, k AS (SELECT DISTINCT country, unnest(list_filter(string_split_regex(trim(strip_accents(lower(last_name))), '[^\\p{{L}}]+'), lambda w: length(w) >= 4)) AS w FROM deputies),
r AS (SELECT DISTINCT country, speaker_raw FROM t WHERE speaker_raw IS NOT NULL), x AS (SELECT *, regexp_extract_all(speaker_raw, '\\p{{L}}+') AS t FROM r),
p AS (SELECT country, speaker_raw, n AS at_n, t[n] AS a, t[n + 1] AS b FROM (SELECT *, unnest(range(1, len(t))) AS n FROM x)),
f AS (SELECT *, strip_accents(lower(a)) AS fa, strip_accents(lower(b)) AS fb FROM p),
g AS (SELECT f.* FROM f JOIN k ON f.country = k.country AND fa || fb = k.w WHERE NOT EXISTS (SELECT 1 FROM k z WHERE z.country = f.country AND z.w IN (fa, fb))),
m AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY country, speaker_raw ORDER BY at_n) = 1)
SELECT country, speaker_raw, regexp_replace(speaker_raw, a || '[ ]+' || b, a || b, 'g') AS mended FROM m"""
_NAME_SQL = f"""WITH {TURNS}, {TERMS}, n AS (SELECT DISTINCT country, id_dep, {_SKEL.format('speaker_name')} AS k, start_date, coalesce(end_date, DATE '2999-12-31') AS until FROM r WHERE start_date IS NOT NULL),
a AS (SELECT id_int, country, date, {_SKEL.format('speaker_raw')} AS k FROM t WHERE id_dep IS NULL AND date IS NOT NULL)
SELECT id_int, min(n.id_dep) AS id_dep FROM a JOIN n ON a.country = n.country AND a.k = n.k AND a.k <> '' AND date BETWEEN start_date AND until GROUP BY 1 HAVING count(DISTINCT n.id_dep) = 1"""

_NAMES = """unpaged_furniture folio_lines cut_words joined_words cleaned_lines repetitions subset_by_country subset_from_query subset_listing subset_notes whitelisted published sql_functions exported_network
ambiguity_alerts imported_folder narrated_turns front_of_sittings review_sheet citations trimmed_network match_by_name mended_names""".split()
QUERIES = {name: globals()[name] for name in _NAMES}
_HITS = f"{uses('text', ' hospital ')}"
SQL = {
    "match_by_name": _NAME_SQL,
    "mended_names": _MEND_SQL,
    "narrated_turns": _NARRATED_SQL,
    "front_of_sittings": _FRONT_SQL,
    "review_sheet": f"WITH {TURNS} SELECT country, id_int, row_number() OVER (PARTITION BY country ORDER BY md5(id_int || 'review'), id_int)::INT AS place FROM t QUALIFY place <= 20",
    "citations": f"""WITH {TURNS}, k AS (SELECT id_int, coalesce(nullif(trim(speaker_name, ' '), ''), '?') || coalesce(' (' || nullif(trim(party, ' '), '') || ')', '') AS n, nullif(trim(country, ' '), '') AS c, day(date) || '/' || month(date) || '/' || year(date) AS d, speaker_name FROM t)
SELECT id_int, concat_ws(', ', n, c, d) AS cited, regexp_replace(regexp_replace(trim(strip_accents(lower(speaker_name))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM k""",
    "unpaged_furniture": f"WITH {TURNS}, l AS (SELECT id_int AS id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM t) SELECT id, regexp_replace(lower(line), '\\d+', '9', 'g') AS form, count(*) AS n FROM l WHERE length(line) BETWEEN 3 AND 80 AND NOT regexp_matches(line, '[.!?…;,]$') GROUP BY 1, 2 HAVING count(*) >= 2",
    "folio_lines": _FOLIO_SQL,
    "cut_words": _CUT_SQL,
    "cleaned_lines": _CLEAN_SQL,
    "repetitions": f"WITH {TURNS}, k AS (SELECT id_session, md5(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS k, count(*) AS n FROM t WHERE length(text) >= 40 GROUP BY 1, 2 HAVING count(*) > 1) SELECT id_session, count(*) AS texts, sum(n - 1)::BIGINT AS extra FROM k GROUP BY 1",
    "subset_by_country": f"""WITH {TURNS}, k AS (SELECT id_int, country, CASE WHEN country = 'PT' THEN {uses('text', ' imposto ')} ELSE {_HITS} END::INT AS occ FROM t WHERE dm_speech = 1 AND (country <> 'BR' OR date BETWEEN DATE '2015-06-15' - 400 AND DATE '2015-06-15' + 400))
SELECT * FROM k WHERE occ > 0""",
    "subset_from_query": f"WITH {TURNS} SELECT id_int, country FROM t WHERE n_words > 100",
    "subset_listing": f"""WITH {TURNS}, k AS (SELECT country, {_HITS} AS h, {uses('text', ' escuela ')} AS e FROM t WHERE dm_speech = 1 AND date >= DATE '2000-01-01')
SELECT 'health' AS name, count(*) AS turns, count(DISTINCT country)::INT AS countries, '{{"terms": ["hospital"]}}' AS definition FROM k WHERE h > 0 UNION ALL SELECT 'schools', count(*), count(DISTINCT country)::INT, '{{"terms": ["escuela"]}}' FROM k WHERE e > 0""",
    "whitelisted": f"WITH {TURNS} SELECT sex, count(*) AS n, coalesce(sex IN ('F', 'M'), false) AS listed FROM t GROUP BY 1",
    "published": f"WITH {TURNS} SELECT country, count(*) AS n FROM t GROUP BY 1",
    "sql_functions": f"WITH {TURNS} SELECT id_int, coalesce(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')), 0)::INT AS n_words, len(regexp_extract_all(trim(strip_accents(lower(text))), '[\\p{{L}}\\p{{N}}]+'))::INT AS n_folded, md5(trim(strip_accents(lower(text)))) AS fold_md5 FROM t",
    "imported_folder": f"WITH {TURNS}, w AS (SELECT country, year(date)::SMALLINT AS year, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+')) AS w FROM t WHERE dm_speech = 1 AND date IS NOT NULL AND country IN ('PT', 'UY')) SELECT country, year, count(*) AS n FROM w GROUP BY 1, 2",
}
from .relations import _PAIR_SQL  # noqa: E402

SQL["exported_network"] = f"WITH q AS ({_PAIR_SQL}) SELECT a AS source, b AS target, co AS weight FROM q"
SQL["trimmed_network"] = f"""WITH q AS ({_PAIR_SQL}), n AS (SELECT node, sum(co) AS s FROM (SELECT unnest([a, b]) AS node, co FROM q) GROUP BY 1), k AS (SELECT node FROM n QUALIFY row_number() OVER (ORDER BY s DESC, node) <= 5)
SELECT a, b, co FROM q WHERE a IN (SELECT node FROM k) AND b IN (SELECT node FROM k)"""
