"""Operators on the order of turns and sittings: windows, imputation, segments, gaps, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.terms import is_chair


def renumber(rows: DataFrame) -> DataFrame:
    """Drop rows with empty text and number the rest 1..n in their sitting; order 0 stays 0."""
    kept = rows.where(F.trim("text") != "")
    front = F.coalesce(F.col("intervention_order") == 0, F.lit(False))
    w = Window.partitionBy("id_session", front).orderBy(F.col("intervention_order").asc_nulls_last(), "id_int")
    return kept.withColumn("new_order", F.when(front, 0).otherwise(F.row_number().over(w)))


def around(rows: DataFrame, id_int: str, context: int) -> DataFrame:
    """A turn with the ``context`` turns before and after it in its sitting."""
    place = F.row_number().over(Window.partitionBy("id_session").orderBy("id_int"))
    target = rows.where(F.col("id_int") == id_int).select("id_session").distinct()
    ranked = rows.join(target, "id_session", "left_semi").withColumn("place", place)
    at = ranked.where(F.col("id_int") == id_int).select(F.col("place").alias("at"), F.col("id_session").alias("_s"))
    return ranked.join(at, F.col("id_session") == F.col("_s")).where(F.abs(F.col("place") - F.col("at")) <= context).drop("_s", "at")


def order_gaps(rows: DataFrame) -> DataFrame:
    """(id_session, after, before, missing): holes in a sitting's distinct order numbers."""
    n = rows.where(F.col("intervention_order") > 0).select("id_session", F.col("intervention_order").alias("o")).distinct()
    gaps = n.withColumn("nxt", F.lead("o").over(Window.partitionBy("id_session").orderBy("o"))).where(F.col("nxt") > F.col("o") + 1)
    return gaps.select("id_session", F.col("o").alias("after"), F.col("nxt").alias("before"), (F.col("nxt") - F.col("o") - 1).alias("missing"))


def impute_by_date(sessions: DataFrame, value: str, most_days: int = 120) -> DataFrame:
    """Fill a sitting's missing value from the nearest dated sitting of the country, at most ``most_days`` away; on a tie the earlier one wins."""
    back = Window.partitionBy("country").orderBy("date", "id_session").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("country").orderBy("date", "id_session").rowsBetween(1, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct("date", value))
    w = sessions.where(F.col("date").isNotNull()).withColumn("p", F.last(known, True).over(back)).withColumn("n", F.first(known, True).over(ahead))
    dp, dn = F.datediff("date", "p.date"), F.datediff("n.date", "date")
    fill = F.when((dp <= most_days) & (dn.isNull() | (dp <= dn)), F.col(f"p.{value}")).when(dn <= most_days, F.col(f"n.{value}")).when(dp <= most_days, F.col(f"p.{value}"))
    return w.select("id_session", "country", "date", value, F.coalesce(F.col(value), fill).alias("imputed"))


def impute_gap_of_two(sessions: DataFrame) -> DataFrame:
    """A missing sitting number between two known ones that differ by two."""
    w = Window.partitionBy("country", "legislature").orderBy("id_session")
    gap = F.col("number").isNull() & (F.lead("number").over(w) - F.lag("number").over(w) == 2)
    return sessions.withColumn("imputed", F.coalesce("number", F.when(gap, F.lag("number").over(w) + 1)))


def natural_key(c: Column) -> tuple[Column, Column]:
    """Leading number, then the whole string: 12 < 12B < 13."""
    return F.expr("1") * F.regexp_extract(c, r"^\s*(\d+)", 1).try_cast("int"), c


def dense_ids(sessions: DataFrame) -> DataFrame:
    """Identifiers from dense ranks: country, legislature by first day (3 digits), sitting by day and number (4)."""
    first = sessions.groupBy("country", "legislature").agg(F.min("date").alias("opens"))
    leg = first.withColumn("leg_n", F.dense_rank().over(Window.partitionBy("country").orderBy(F.col("opens").asc_nulls_last(), "legislature"))).drop("opens")
    number, text = natural_key(F.col("session_number"))
    w = Window.partitionBy("country", "legislature").orderBy(F.col("date").asc_nulls_last(), number.asc_nulls_last(), text.asc_nulls_last())
    ranked = sessions.join(leg, ["country", "legislature"]).withColumn("sit_n", F.dense_rank().over(w))
    return ranked.select("id_session", "country", "legislature", F.concat("country", F.lpad(F.col("leg_n").cast("string"), 3, "0"), F.lpad(F.col("sit_n").cast("string"), 4, "0")).alias("new_id"))


def chair_segments(rows: DataFrame) -> DataFrame:
    """(id_session, segment, chair, first_id, turns): stretches under one chair.

    A chair's name typed in brackets after the office opens a stretch; turns before the first belong to none.
    """
    named = F.when(is_chair(F.col("speaker_raw")), F.nullif(F.upper(F.trim(F.regexp_extract("speaker_raw", r"\(([^)]{3,})\)", 1))), F.lit("")))
    w = Window.partitionBy("id_session").orderBy("id_int")
    held = rows.select("id_session", "id_int", named.alias("named")).withColumn("chair", F.last("named", True).over(w))
    change = F.when(F.col("chair").isNotNull() & ~F.col("chair").eqNullSafe(F.lag("chair").over(w)), 1).otherwise(0)
    seg = held.withColumn("change", change).withColumn("segment", F.sum("change").over(w)).where(F.col("chair").isNotNull())
    return seg.groupBy("id_session", "segment", "chair").agg(F.min("id_int").alias("first_id"), F.count("*").alias("turns"))


def vocative_sex(rows: DataFrame) -> DataFrame:
    """(id_int, called): how the chair of a turn is addressed in it or the nearest of two turns around."""
    said = F.when(F.col("text").rlike(r"(?iu)señora presidenta|senhora presidenta"), "F").when(F.col("text").rlike(r"(?iu)señor presidente|senhor presidente"), "M")
    w = Window.partitionBy("id_session").orderBy("id_int")
    v = rows.select("id_session", "id_int", said.alias("v"))
    near = F.coalesce("v", F.lag("v", 1).over(w), F.lead("v", 1).over(w), F.lag("v", 2).over(w), F.lead("v", 2).over(w))
    return v.select("id_int", near.alias("called")).where(F.col("called").isNotNull())


def date_plausibility(sessions: DataFrame) -> DataFrame:
    """Sittings dated before the one before them or after the one behind them in their legislature's numbering."""
    w = Window.partitionBy("country", "legislature").orderBy("id_session")
    j = sessions.withColumn("previous", F.lag("date").over(w)).withColumn("next", F.lead("date").over(w))
    return j.where((F.col("date") < F.col("previous")) | (F.col("date") > F.col("next")))


def normal_text(c: Column) -> Column:
    """Letters and digits only, lower case, one blank between words."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def doubled_sessions(rows: DataFrame, least_chars: int = 80, least_repeated: int = 20, least_twice: float = 0.7, least_share: float = 0.25) -> DataFrame:
    """Sittings in which many long texts stand exactly twice: (id_session, n_rows, repeated, twice).

    A sitting is doubled if ``least_repeated`` different whole texts stand several times in it, ``least_twice`` of them
    exactly twice, and the copies beyond the first are ``least_share`` of all its rows; ``n_rows`` counts the long ones.
    """
    key = F.when(F.length("text") >= least_chars, F.md5(normal_text(F.col("text"))))
    per = rows.select("id_session", key.alias("k")).groupBy("id_session", "k").agg(F.count("*").alias("n"))
    long = F.col("k").isNotNull()
    s = per.groupBy("id_session").agg(
        F.sum(F.when(long, F.col("n"))).alias("n_rows"), F.count_if(long & (F.col("n") > 1)).alias("repeated"), F.count_if(long & (F.col("n") == 2)).alias("twice"),
        F.sum(F.when(long, F.col("n") - 1)).alias("extra"), F.sum("n").alias("every"),
    )
    kept = (F.col("repeated") >= least_repeated) & (F.col("twice") >= F.col("repeated") * least_twice) & (F.col("extra") >= F.col("every") * least_share)
    return s.where(kept).drop("extra", "every")


def keep_best(rows: DataFrame, least_chars: int = 80) -> DataFrame:
    """One of the rows of a sitting with equal normalised long text: with an id first, then the longest, then the lowest id. Short texts all stay."""
    key = F.when(F.length("text") >= least_chars, F.md5(normal_text(F.col("text")))).otherwise(F.concat(F.lit("row:"), F.col("id_int")))
    w = Window.partitionBy("id_session", "k").orderBy(F.col("id_dep").isNull(), F.desc(F.length("text")), "id_int")
    return rows.withColumn("k", key).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("k", "rn")


def exact_repeats(rows: DataFrame, least_chars: int = 400) -> DataFrame:
    """Long texts that stand several times under one speaker and day: key hash, copies, first id."""
    long = rows.where(F.length("text") > least_chars)
    return long.groupBy("legislature", "date", "speaker_raw", F.md5("text").alias("text_md5")).agg(F.count("*").alias("copies"), F.min("id_int").alias("first_id")).where("copies > 1").select("text_md5", "copies", "first_id")


def same_day_duplicates(rows: DataFrame, least: float = 0.35, least_chars: int = 40) -> DataFrame:
    """(keeper, redundant, jaccard, reason): two records of one sitting among those of a country and day.

    The same session number on a day is a duplicate (``number``); without two numbers to compare, an overlap of the
    sets of long texts of ``least`` is (``texts``); different numbers tell sittings apart whatever their texts. The
    record with more texts is kept, the first id on a tie. Texts meet only where they are shared, and the numbers of a
    day are as many as its sittings.
    """
    t = rows.where(F.col("date").isNotNull() & (F.length("text") >= least_chars)).select("country", "date", "id_session", F.md5(normal_text(F.col("text"))).alias("k")).distinct()
    size = t.groupBy("id_session").agg(F.count("*").alias("n"))
    b = t.select("country", "date", "k", F.col("id_session").alias("b"))
    shared = t.withColumnRenamed("id_session", "a").join(b, ["country", "date", "k"]).where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count("*").alias("both"))
    met = rows.where(F.col("date").isNotNull()).groupBy("country", "date", "id_session").agg(F.min(F.nullif(F.trim("session_number"), F.lit(""))).alias("number"))
    other = met.select("country", "date", F.col("id_session").alias("b"), F.col("number").alias("nb"))
    pairs = met.withColumnsRenamed({"id_session": "a", "number": "na"}).join(other, ["country", "date"]).where(F.col("a") < F.col("b")).select("a", "b", (F.col("na") == F.col("nb")).alias("same"))
    sizes = lambda c, n: size.select(F.col("id_session").alias(c), F.col("n").alias(n))
    j = pairs.join(shared, ["a", "b"], "left").join(sizes("a", "n_a"), "a", "left").join(sizes("b", "n_b"), "b", "left").na.fill(0, ["n_a", "n_b"])
    j = j.withColumn("jaccard", F.coalesce(F.round(F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both")), 6), F.lit(0.0)))
    same = F.coalesce("same", F.lit(False))
    hit = j.where(same | ((F.col("jaccard") >= least) & F.col("same").isNull()))
    first = F.col("n_a") >= F.col("n_b")
    return hit.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("keeper"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("redundant"), "jaccard", F.when(same, "number").otherwise("texts").alias("reason"))


def seeded_sample(rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """``n`` rows in the order of md5(key and seed): the same on every engine and every run."""
    return rows.withColumn("_h", F.md5(F.concat(F.col(key), F.lit(seed)))).orderBy("_h", key).limit(n).drop("_h")


def round_robin(rows: DataFrame, stratum: str, key: str, seed: str, n: int) -> DataFrame:
    """``n`` varied rows: the first of every stratum, then the second, and so on (sampling operator)."""
    h = F.md5(F.concat(F.col(key), F.lit(seed)))
    w = Window.partitionBy(stratum).orderBy(h, key)
    # No stratum gives more than n; Spark then keeps the n first of each within every task, before the shuffle.
    return rows.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= n).orderBy("turn", stratum).limit(n)


def proportional(rows: DataFrame, stratum: str, key: str, seed: str, n: int) -> DataFrame:
    """``n`` rows shared among strata in proportion to size, largest remainders first (sampling operator)."""
    counts = sorted((r[0], r[1]) for r in rows.where(F.col(stratum).isNotNull()).groupBy(stratum).count().collect())  # one row per stratum
    total = sum(c for _, c in counts) or 1
    quota = {s: n * c // total for s, c in counts}
    for s, c in sorted(counts, key=lambda x: (-(n * x[1] % total), x[0]))[: n - sum(quota.values())]:
        quota[s] += 1
    plan = rows.sparkSession.createDataFrame([(s, int(q)) for s, q in quota.items()] or [("", 0)], f"`{stratum}` string, quota int")
    h = F.md5(F.concat(F.col(key), F.lit(seed)))
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy(stratum).orderBy(h, key))).where(F.col("rn") <= n)
    return ranked.join(F.broadcast(plan), stratum).where(F.col("rn") <= F.col("quota")).drop("rn", "quota")
