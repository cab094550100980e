"""Problem 3: how distinctive a term is of its record (probabilistic relevance weighting)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import one_per_key
from .terms import speech_rows, with_counts

K1 = 1.2
B = 0.75


def weigh(terms: DataFrame, frequencies: DataFrame, n_records: int, average: float, k1: float = K1, b: float = B) -> DataFrame:
    """Score rows of (``value``, ``tf``, ``length``) by BM25 against collection frequencies.

    score = ln(1 + (N - df + 0.5) / (df + 0.5)) * tf (k1 + 1) / (tf + k1 (1 - b + b length / average)).
    The saturating tf keeps one repeated word from winning by repetition alone; the length term
    keeps long records from winning by size. ``average`` = 0 (no words at all) counts as 1.
    """
    idf = F.log1p((F.lit(n_records) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("length") / F.lit(average or 1.0))
    return terms.join(frequencies, "value").withColumn("score", idf * F.col("tf") * F.lit(k1 + 1) / (F.col("tf") + norm))


def distinctive_terms(
    records: DataFrame,
    key: str = "id_int",
    version: str = "row_n",
    text: str = "text",
    value_fields: tuple[str, ...] = ("party", "sex"),
    least_tf: int = 1,
    text_one_in: int = 1,
    value_one_in: int = 1,
    least_df: int = 1,
) -> DataFrame:
    """(key, field, value, tf, df, score) of the words of ``text`` and of the values of ``value_fields``.

    Copies of a key count once (the lowest ``version``). A word needs ``least_tf`` uses in the record
    and ``least_df`` to N / ``text_one_in`` records; a value (as stored, blanks left out) ``least_df``
    to N / ``value_one_in``. Null and empty texts give no words but count in N. A null key gives no
    row. Empty tables give an empty result.

    Copies are found from the keys alone, so no texts or counts of unique keys are shuffled, and document
    frequencies are combined map-side, so a hot word costs one row per task.
    """
    rows = one_per_key(records.select(key, version, text, *value_fields), key, version, [key, text, *value_fields], payload=True)
    base = materialize(with_counts(rows, text), "term-counts")
    totals = base.agg(F.count("*").alias("n"), F.avg("length").alias("average")).first()
    n, average = totals["n"], totals["average"] or 1.0

    def frequent(df: DataFrame, one_in: int) -> DataFrame:
        return df.groupBy("value").agg(F.count("*").alias("df")).where((F.col("df") >= least_df) & (F.col("df") * one_in <= n))

    exploded = base.select(key, "length", F.explode("terms").alias("t")).select(key, "length", F.col("t.word").alias("value"), F.col("t.tf").alias("tf"))
    repeated = base.select(key, "length", F.explode(F.filter("terms", lambda t: t["tf"] >= least_tf)).alias("t")).select(key, "length", F.col("t.word").alias("value"), F.col("t.tf").alias("tf"))
    out = weigh(repeated, frequent(exploded.select("value"), text_one_in), n, average).select(key, F.lit("text").alias("field"), "value", "tf", "df", "score")
    for field in value_fields:
        values = base.where(F.trim(F.col(field)) != "").select(key, F.lit(1).alias("length"), F.col(field).alias("value"), F.lit(1).alias("tf"))
        scored = weigh(values, frequent(values.select("value"), value_one_in), n, 1.0)
        out = out.unionByName(scored.select(key, F.lit(field).alias("field"), "value", "tf", "df", "score"))
    return out


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Words used 3 times in a row and in 2 to N/200 rows; party and sex values held by 2 to N/1000."""
    rows = speech_rows(spark, folder, ["row_n", "text", "party", "sex"])
    scored = distinctive_terms(rows, least_tf=3, text_one_in=200, value_one_in=1000, least_df=2).where(F.col("score") > 0)
    return scored.select("id_int", "field", "value")


def p3_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every word and value of every speech row with its score."""
    return distinctive_terms(speech_rows(spark, folder, ["row_n", "text", "party", "sex"]))


_WORDS_SQL = r"""
WITH rows AS (
  SELECT DISTINCT ON (id_int) id_int, text, party, sex FROM interventions WHERE dm_speech = 1 ORDER BY id_int, row_n),
size AS (SELECT count(*) AS n FROM rows),
w AS (
  SELECT id_int, unnest(regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+')) AS value FROM rows),
t AS (
  SELECT id_int, value, count(*) AS tf FROM w WHERE length(value) >= 4 AND regexp_full_match(value, '\p{L}+') GROUP BY ALL)
"""
P3_FOUND_SQL = (
    _WORDS_SQL
    + """,
d AS (SELECT value, count(*) AS df FROM t GROUP BY 1),
p AS (SELECT party AS value, count(*) AS df FROM rows WHERE trim(party) <> '' GROUP BY 1),
s AS (SELECT sex AS value, count(*) AS df FROM rows WHERE trim(sex) <> '' GROUP BY 1)
SELECT id_int, 'text' AS field, value FROM t JOIN d USING (value), size WHERE tf >= 3 AND df >= 2 AND df * 200 <= n
UNION ALL SELECT id_int, 'party', party FROM rows JOIN p ON party = p.value, size WHERE df >= 2 AND df * 1000 <= n
UNION ALL SELECT id_int, 'sex', sex FROM rows JOIN s ON sex = s.value, size WHERE df >= 2 AND df * 1000 <= n
"""
)
P3_SCORES_SQL = (
    _WORDS_SQL
    + """,
l AS (SELECT id_int, sum(tf) AS length FROM t GROUP BY 1),
a AS (SELECT coalesce(sum(length), 0) / max(n) AS average FROM l, size),
d AS (SELECT value, count(*) AS df FROM t GROUP BY 1),
v AS (
  SELECT id_int, 'party' AS field, party AS value FROM rows WHERE trim(party) <> ''
  UNION ALL SELECT id_int, 'sex', sex FROM rows WHERE trim(sex) <> ''),
vd AS (SELECT field, value, count(*) AS df FROM v GROUP BY ALL)
SELECT id_int, 'text' AS field, value, tf::INT AS tf, df, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average)) AS score
FROM t JOIN d USING (value) JOIN l USING (id_int), size, a
UNION ALL
SELECT id_int, field, value, 1, df, ln(1 + (n - df + 0.5) / (df + 0.5)) * 2.2 / 2.2 FROM v JOIN vd USING (field, value), size
"""
)

QUERIES = {"p3_found": p3_found, "p3_scores": p3_scores}
SQL = {"p3_found": P3_FOUND_SQL, "p3_scores": P3_SCORES_SQL}
