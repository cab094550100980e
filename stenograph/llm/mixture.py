"""Problem 9: mixing sources to target weights (weighted sampling without replacement, whole epochs first)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import spread, table
from .tokens import token_counts

#: Slices of the key range within a source; bounds the largest group that is sorted in one task.
SLICES = 512


def source_name(name: Column) -> Column:
    """Trimmed, lower case, ``-`` as ``_``."""
    return F.lower(F.trim(F.translate(name, "-", "_")))


def quality(text: Column) -> Column:
    """A document's weight in (0, 1]: the share of letters, digits and blanks in its text, at least 0.05."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}\s]", ""))
    return F.greatest(F.lit(0.05), plain / F.greatest(F.length(text), F.lit(1)))


def exponential_key(identity: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u drawn from a digest of id and seed, so a retried task, and any engine, draws the same."""
    drawn = F.conv(F.substring(F.md5(F.concat(identity.cast("string"), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("bigint")
    u = (drawn + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 17, slices: int = SLICES) -> DataFrame:
    """(doc_id, source, n_tokens, times) of the chosen documents.

    ``documents``: doc_id, source (clean), n_tokens, weight. ``targets``: source (clean, unique),
    target_share, max_repeats. Shares are divided by their sum over the sources that have tokens, a
    positive share and a positive cap; other sources are left out. Without ``total_tokens`` the total
    is the largest at which every source reaches its share under its cap; with a larger one, capped
    sources fall short, which the report shows.

    A source's budget is met by whole epochs of all its documents, then by part of one more: documents
    in order of their Efraimidis-Spirakis key (so a document of higher weight tends to come first),
    taken while at least half of the document still fits into the rest, so a share is met to within half
    a document. Documents without tokens aren't chosen.

    Running sums are formed in two levels: per slice of the key range, then within a slice, so a source
    with a third of all documents is spread over ``slices`` groups. Ties in the key go by doc_id. A null
    weight counts 0.05; other columns of either table are ignored; empty tables give no rows.
    """
    spark = documents.sparkSession
    sized = documents.select("doc_id", "source", "n_tokens", F.greatest(F.coalesce("weight", F.lit(0.05)), F.lit(1e-9)).alias("weight")).where(F.col("n_tokens") > 0).withColumn("key", exponential_key(F.col("doc_id"), F.col("weight"), seed))
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    plan = targets.select("source", "target_share", "max_repeats").join(have, "source").where((F.col("target_share") > 0) & (F.col("max_repeats") > 0)).collect()
    whole = sum(r["target_share"] for r in plan)
    if not plan:
        return spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint, times int")
    if total_tokens is None:
        total_tokens = min(r["available"] * r["max_repeats"] * whole / r["target_share"] for r in plan)
    budgets = []
    for r in plan:
        budget = min(total_tokens * r["target_share"] / whole, r["available"] * r["max_repeats"])
        epochs = int((budget + 1e-6) // r["available"])
        budgets.append((r["source"], epochs, max(0, int(budget + 1e-6) - epochs * r["available"])))
    goal = F.broadcast(spark.createDataFrame(budgets, "source string, epochs int, rest bigint"))  # one row per target
    keyed = sized.join(goal, "source").withColumn("slice", F.least(F.floor((1 - F.exp(-F.col("key"))) * slices), F.lit(slices - 1)))
    per_slice = keyed.groupBy("source", "slice").agg(F.sum("n_tokens").alias("in_slice"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select("source", "slice", F.coalesce(F.sum("in_slice").over(running), F.lit(0)).alias("before"))  # targets x slices rows
    inside = Window.partitionBy("source", "slice").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.withColumn("within", F.sum("n_tokens").over(inside)).join(F.broadcast(before), ["source", "slice"])
    # A source at its cap has no rest, so the extra use never passes max_repeats.
    times = F.col("epochs") + F.when(F.col("before") + F.col("within") - F.col("n_tokens") / 2 <= F.col("rest"), F.when(F.col("rest") > 0, 1).otherwise(0)).otherwise(0)
    return placed.select("doc_id", "source", "n_tokens", times.cast("int").alias("times")).where(F.col("times") > 0)


def report(chosen: DataFrame, targets: DataFrame, documents: DataFrame) -> DataFrame:
    """Per target: wanted and reached share, tokens available and used, most uses of one document."""
    used = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("used_tokens"), F.max("times").alias("most_times"), F.count("*").alias("documents"))
    have = documents.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    every = Window.partitionBy(F.lit(0))  # one row per target
    return targets.join(used, "source", "left").join(have, "source", "left").select(
        "source",
        "target_share",
        "max_repeats",
        F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"),
        F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("most_times", F.lit(0)).alias("most_times"),
        (F.coalesce("used_tokens", F.lit(0)) / F.sum("used_tokens").over(every)).alias("reached_share"),
    )


def clean_targets(targets: DataFrame) -> DataFrame:
    """One target per clean source name: shares of repeated names are summed, the smallest cap holds."""
    named = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").where(F.col("source") != "")
    return named.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))


def sized_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, clean source, weight and tokens of the documents whose source has a target; stored."""
    targets = clean_targets(table(spark, folder, "mixture_targets"))
    named = spread(table(spark, folder, "documents").select("doc_id", source_name(F.col("source")).alias("source"), "text")).join(targets.select("source"), "source", "left_semi")
    weighed = named.withColumn("weight", F.coalesce(quality(F.col("text")), F.lit(0.05)))
    return materialize(token_counts(weighed), "document-sizes")


def p9_selection(spark: SparkSession, folder: str) -> DataFrame:
    """The documents chosen, each with how often it is used."""
    return mixture(sized_documents(spark, folder), clean_targets(table(spark, folder, "mixture_targets")))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares really reached, by source."""
    documents, targets = sized_documents(spark, folder), clean_targets(table(spark, folder, "mixture_targets"))
    return report(mixture(documents, targets), targets, documents)


def p9_by_length(spark: SparkSession, folder: str) -> DataFrame:
    """The selection with sizes in characters instead of tokens, which SQL can check row by row."""
    targets = clean_targets(table(spark, folder, "mixture_targets"))
    named = spread(table(spark, folder, "documents").select("doc_id", source_name(F.col("source")).alias("source"), "text")).join(targets.select("source"), "source", "left_semi")
    sized = named.select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_tokens"), F.coalesce(quality(F.col("text")), F.lit(0.05)).alias("weight"))
    return mixture(materialize(sized, "document-lengths"), targets).withColumnRenamed("n_tokens", "n_chars")


_LENGTH_SQL = r"""
WITH t AS (
  SELECT lower(trim(replace(source, '-', '_'))) AS source, sum(target_share) AS share, min(max_repeats) AS cap FROM mixture_targets
  WHERE source <> '' GROUP BY 1),
d AS (
  SELECT doc_id, lower(trim(replace(source, '-', '_'))) AS source, length(text) AS n,
    greatest(0.05, length(regexp_replace(text, '[^\p{L}\p{M}\p{N}\s]', '', 'g')) / length(text)) AS weight
  FROM documents WHERE length(text) > 0),
h AS (SELECT source, sum(n)::BIGINT AS available FROM d GROUP BY 1),
p AS (SELECT * FROM t JOIN h USING (source) WHERE share > 0 AND cap > 0),
w AS (SELECT sum(share) AS whole FROM p),
a AS (SELECT min(available * cap * whole / share) AS total FROM p, w),
b AS (SELECT source, available, least(total * share / whole, available * cap) + 1e-6 AS budget FROM p, w, a),
g AS (SELECT source, floor(budget / available)::BIGINT AS epochs, greatest(0, floor(budget)::BIGINT - floor(budget / available)::BIGINT * available) AS rest FROM b),
k AS (SELECT d.*, epochs, rest, -ln((('0x' || substr(md5(doc_id || ':17'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / weight AS key FROM d JOIN g USING (source)),
s AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k),
x AS (SELECT doc_id, source, n, (epochs + CASE WHEN rest > 0 AND upto - n / 2 <= rest THEN 1 ELSE 0 END)::INT AS times FROM s)
SELECT doc_id, source, n AS n_chars, times FROM x WHERE times > 0
"""
QUERIES = {"p9_selection": p9_selection, "p9_shares": p9_shares, "p9_by_length": p9_by_length}
SQL: dict[str, str] = {"p9_by_length": _LENGTH_SQL}
