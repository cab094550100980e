"""Counting terms over time and groups, and comparing groups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.terms import Selection, is_chair, occurrences, parse_terms, search_pattern
from ..functions.text import fold_str
from ..sources.tables import one_per_key
from .spotting import token_lists

#: Below these a yearly value rests on too little text.
LOW_WORDS, LOW_SESSIONS = 250_000, 10


def year_spine(years: DataFrame, group: list[str]) -> DataFrame:
    """Every year between a group's first and last, so that gaps become rows."""
    span = years.groupBy(*group).agg(F.min("year").alias("a"), F.max("year").alias("b"))
    return span.select(*group, F.explode(F.sequence("a", "b")).alias("year"))


def denominators(rows: DataFrame, group: list[str]) -> DataFrame:
    """Words, turns and sittings of each group and year."""
    return rows.where(F.col("date").isNotNull()).groupBy(*group, F.year("date").alias("year")).agg(
        F.sum("n_words").cast("bigint").alias("words"), F.count("*").alias("turns"), F.countDistinct("id_session").alias("sessions")
    )


def counted_turns(rows: DataFrame, filters: Selection, columns: Sequence[str], counts: Sequence[Column], version: str | None) -> DataFrame:
    """The filtered turns with their counts, texts left behind.

    With ``version`` the rows may hold copies of an ``id_int``: the lowest version is kept. Counting comes first,
    so that only ids, a few columns and numbers are shuffled to bring copies together, never texts.
    """
    keep = list(dict.fromkeys(columns))
    if version is None:
        return filters.apply(rows).select(*keep, *counts)
    marked = rows.select("id_int", version, *[c for c in keep if c != "id_int"], filters.where().alias("_kept"), *counts)
    names = [c for c in marked.columns if c not in ("id_int", version)]
    single = one_per_key(marked, "id_int", version, ["id_int", *names]).where("_kept").drop("_kept")
    return filters.join(single)


def ngram_series(rows: DataFrame, terms: str, filters: Selection, by_country: bool = False, measure: str = "per_million", smoothing: int = 0, version: str | None = None) -> DataFrame:
    """(series, [country], year, count, value, words, turns, sessions, low_base) of each term series.

    ``value`` is per million words, the count, or the share of turns that use the term. Years without
    text stay in the series with a null value; smoothing averages the unrounded values of the years
    around that have one. Undated rows are left out.
    """
    group = ["country"] if by_country else []
    series = parse_terms(terms)
    uses = [occurrences("text", v).alias(f"s{k}") for k, (_, v) in enumerate(series)]
    counted = counted_turns(rows, filters, [*group, "date", "id_session", "n_words"], uses, version).where(F.col("date").isNotNull()).withColumn("year", F.year("date"))
    sums = counted.groupBy(*group, "year").agg(
        F.sum("n_words").cast("bigint").alias("words"),
        F.count("*").alias("turns"),
        F.countDistinct("id_session").alias("sessions"),
        *[F.sum(f"s{k}").cast("bigint").alias(f"c{k}") for k in range(len(series))],
        *[F.count_if(F.col(f"s{k}") > 0).alias(f"t{k}") for k in range(len(series))],
    )
    full = year_spine(sums, group).join(sums, [*group, "year"], "left")
    stacked = full.select(
        *group, "year", "words", "turns", "sessions",
        F.explode(F.array(*[F.struct(F.lit(label).alias("series"), F.col(f"c{k}").alias("count"), F.col(f"t{k}").alias("users")) for k, (label, _) in enumerate(series)])).alias("s"),
    ).select(*group, "year", "words", "turns", "sessions", "s.*")
    value = {"per_million": F.col("count") * 1e6 / F.col("words"), "count": F.col("count").cast("double"), "interventions_pct": F.col("users") * 100.0 / F.col("turns")}[measure]
    raw = F.when(F.col("words") > 0, value)
    around = Window.partitionBy("series", *group).orderBy("year").rowsBetween(-smoothing, smoothing)
    smooth = F.when(raw.isNotNull(), F.avg(raw).over(around)) if smoothing else raw
    low = F.coalesce((F.col("words") < LOW_WORDS) | (F.col("sessions") < LOW_SESSIONS), F.lit(True))
    return stacked.select("series", *group, "year", "count", F.round(smooth, 3).alias("value"), "words", "turns", "sessions", low.alias("low_base"))


def ngram_from_unigrams(unigrams: DataFrame, word: str, filters: Selection) -> DataFrame:
    """(year, count, words) of one word, case and accents ignored, from the yearly word counts, without any text."""
    if not filters.answered_yearly([word]):
        raise ValueError("the yearly word counts can't answer this selection")
    hit = F.when(F.col("fold") == fold_str(word), F.col("n")).otherwise(0)
    return unigrams.where(filters.yearly()).groupBy(F.col("year").cast("int").alias("year")).agg(F.sum(hit).cast("bigint").alias("count"), F.sum("n").cast("bigint").alias("words"))


def ngram_counts(rows: DataFrame, unigrams: DataFrame | None, terms: str, filters: Selection, version: str | None = None) -> DataFrame:
    """(series, year, count, words): from the yearly word counts where they can answer, else from the texts.

    Both ways count the same folded words of the same turns; undated turns are in neither.
    """
    series = parse_terms(terms)
    if unigrams is None or not filters.answered_yearly([v for _, variants in series for v in variants]):
        return ngram_series(rows, terms, filters, version=version).where(F.col("words").isNotNull()).select("series", "year", "count", "words")
    hits = [F.sum(F.when(F.col("fold").isin([fold_str(v) for v in variants]), F.col("n")).otherwise(0)).cast("bigint") for _, variants in series]
    sums = unigrams.where(filters.yearly()).groupBy(F.col("year").cast("int").alias("year")).agg(F.sum("n").cast("bigint").alias("words"), *[h.alias(f"c{k}") for k, h in enumerate(hits)])
    stacked = F.explode(F.array(*[F.struct(F.lit(label).alias("series"), F.col(f"c{k}").alias("count")) for k, (label, _) in enumerate(series)]))
    return sums.select("year", "words", stacked.alias("s")).select("s.series", "year", "s.count", "words")


def term_counter(rows: DataFrame, variants: Sequence[str], filters: Selection, version: str | None = None) -> DataFrame:
    """Per country: uses, turns, sittings, speakers, share linked, first and last use."""
    counted = counted_turns(rows, filters, ["id_int", "country", "id_session", "id_dep", "date"], [occurrences("text", variants).alias("occ")], version).where(F.col("occ") > 0)
    return counted.groupBy("country").agg(
        F.sum("occ").cast("bigint").alias("uses"),
        F.count("*").alias("turns"),
        F.countDistinct("id_session").alias("sessions"),
        F.countDistinct("id_dep").alias("speakers"),
        F.count("id_dep").alias("linked"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min_by("id_int", F.struct(F.col("date").isNull(), "date", "id_int")).alias("first_id"),
    )


def term_frequency(rows: DataFrame, variants: Sequence[str], by: Column, filters: Selection, version: str | None = None) -> DataFrame:
    """(grp, uses, turns, words, per_million) by any grouping expression; rows without text are left out."""
    parts = [by.alias("grp"), occurrences("text", variants).alias("occ"), F.col("text").isNotNull().alias("_text")]
    g = counted_turns(rows, filters, ["n_words"], parts, version).where("_text").groupBy("grp")
    out = g.agg(F.sum("occ").cast("bigint").alias("uses"), F.count_if(F.col("occ") > 0).alias("turns"), F.sum("n_words").cast("bigint").alias("words"))
    return out.withColumn("per_million", F.round(F.col("uses") * 1e6 / F.nullif("words", F.lit(0)), 2))


def top_groups(rows: DataFrame, variants: Sequence[str], filters: Selection, group: str, k: int, version: str | None = None) -> DataFrame:
    """The ``k`` values of ``group`` with most uses in each country; ties by value."""
    counted = counted_turns(rows, filters, ["country", group], [occurrences("text", variants).alias("occ")], version).where((F.col("occ") > 0) & F.col(group).isNotNull())
    sums = counted.groupBy("country", group).agg(F.sum("occ").cast("bigint").alias("uses"))
    rank = F.row_number().over(Window.partitionBy("country").orderBy(F.desc("uses"), group))
    return sums.withColumn("rank", rank).where(F.col("rank") <= k)


def share_of_voice(rows: DataFrame, register: DataFrame, filters: Selection, by: str = "sex") -> DataFrame:
    """(country, year, grp, words, share_words, members, share_members, ratio).

    Members are the persons whose term overlaps the year (interval join, blocked by country and year);
    a person counts once a year, under the group of the earliest overlapping start, then by name.
    ``register``: country, id_dep, ``by``, start_date, end_date (dates; a null end is open).
    """
    spoken = filters.apply(rows).where(F.col("date").isNotNull() & F.col(by).isNotNull()).groupBy("country", F.year("date").alias("year"), F.col(by).alias("grp")).agg(F.sum("n_words").cast("bigint").alias("words"))
    years = spoken.select("country", "year").distinct()
    first = Window.partitionBy("country", "year", "id_dep").orderBy("start_date", by)
    held = (
        register.where(F.col("start_date").isNotNull() & F.col(by).isNotNull())
        .join(years, "country")
        .where((F.year("start_date") <= F.col("year")) & (F.coalesce(F.year("end_date"), F.lit(2999)) >= F.col("year")))
        .withColumn("k", F.row_number().over(first)).where("k = 1")
        .groupBy("country", "year", F.col(by).alias("grp")).agg(F.count("*").alias("members"))
    )
    total = Window.partitionBy("country", "year")
    both = spoken.join(held, ["country", "year", "grp"], "full").na.fill(0, ["words", "members"])
    share = both.withColumn("share_words", F.col("words") / F.sum("words").over(total)).withColumn("share_members", F.col("members") / F.nullif(F.sum("members").over(total), F.lit(0)))
    return share.select(
        "country", "year", "grp", "words", F.round("share_words", 6).alias("share_words"), "members", F.round("share_members", 6).alias("share_members"),
        F.round(F.col("share_words") / F.nullif("share_members", F.lit(0.0)), 4).alias("ratio"),
    )


def coverage(rows: DataFrame, by: Column) -> DataFrame:
    """Per country and period: what there is, how much is speech, linked, of known sex, in long turns."""
    speech = F.col("dm_speech") == 1
    return rows.groupBy("country", by.alias("period")).agg(
        F.countDistinct("id_session").alias("sessions"),
        F.count("*").alias("n_rows"),
        F.count_if(speech).alias("speech_rows"),
        F.coalesce(F.sum(F.when(speech, F.col("n_words"))), F.lit(0)).cast("bigint").alias("speech_words"),
        F.round(F.count_if(speech & F.col("id_dep").isNotNull()) * 100.0 / F.nullif(F.count_if(speech), F.lit(0)), 2).alias("linked_pct"),
        F.round(F.count_if(speech & F.col("sex").isNotNull()) * 100.0 / F.nullif(F.count_if(speech), F.lit(0)), 2).alias("sex_known_pct"),
        F.count_if(F.col("text").isNull()).alias("without_text"),
        F.count_if(F.col("date").isNull()).alias("undated"),
        F.count_if(speech & is_chair(F.col("speaker_raw"))).alias("chair_rows"),
    )


def missing_years(rows: DataFrame) -> DataFrame:
    """Years inside a country's span without any row."""
    years = rows.where(F.col("date").isNotNull()).select("country", F.year("date").alias("year")).distinct()
    return year_spine(years, ["country"]).join(years, ["country", "year"], "left_anti")


def distinctive_words(counts: DataFrame, side: Column, min_count: int = 20, prior: float = 1000.0) -> DataFrame:
    """(word, ya, yb, z): weighted log-odds of words between two sides, with an informative prior.

    ``counts``: fold, n. ``side`` is "a", "b" or null. With ya, yb the uses, na, nb the sums over all
    words and alpha = prior (ya + yb) / (na + nb): z is the difference of ln((y + alpha) / (n + prior - y
    - alpha)) over its standard error sqrt(1 / (ya + alpha) + 1 / (yb + alpha)).
    """
    use = lambda s: F.sum(F.when(side == s, F.col("n")).otherwise(0)).cast("double")
    sums = counts.groupBy(F.col("fold").alias("word")).agg(use("a").alias("ya"), use("b").alias("yb"))
    total = sums.agg(F.sum("ya").alias("na"), F.sum("yb").alias("nb")).first()
    na, nb = F.lit(total["na"] or 0.0), F.lit(total["nb"] or 0.0)
    alpha = F.lit(prior) * (F.col("ya") + F.col("yb")) / (na + nb)
    odds = lambda y, n: F.log((F.col(y) + alpha) / (n + F.lit(prior) - F.col(y) - alpha))
    z = (odds("ya", na) - odds("yb", nb)) / F.sqrt(1 / (F.col("ya") + alpha) + 1 / (F.col("yb") + alpha))
    kept = sums.where((F.col("ya") + F.col("yb") >= min_count) & (F.length("word") >= 2) & ~F.col("word").rlike(r"^\p{N}+$"))
    return kept.select("word", F.col("ya").cast("bigint").alias("ya"), F.col("yb").cast("bigint").alias("yb"), F.round(z, 5).alias("z"))


def extremes(scores: DataFrame, score: str, label: str, k: int) -> DataFrame:
    """The ``k`` highest and ``k`` lowest rows by ``score``; ties by ``label``. Sorted limits, no full sort."""
    top = scores.orderBy(F.desc(score), label).limit(k).withColumn("end", F.lit("high"))
    return top.unionByName(scores.orderBy(F.asc(score), label).limit(k).withColumn("end", F.lit("low")))


def _near_hits(tokens: DataFrame, word: str, window: int) -> DataFrame:
    """(term, near, far): uses of each word within ``window`` tokens of ``word`` and beyond, counted per batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("w")
            flat, parent = lists.flatten().dictionary_encode(), pc.list_parent_indices(lists).to_numpy()
            names, code = flat.dictionary, flat.indices.to_numpy()
            hit = np.flatnonzero(code == names.index(word).as_py()) if word in names.to_pylist() else np.zeros(0, dtype=np.int64)
            near = np.zeros(len(code), dtype=bool)
            for step in range(-window, window + 1):
                at = hit + step
                ok = (at >= 0) & (at < len(code))
                at, own = at[ok], parent[hit[ok]]
                near[at[parent[at] == own]] = True
            a = np.bincount(code[near], minlength=len(names))
            b = np.bincount(code[~near], minlength=len(names))
            yield pa.RecordBatch.from_arrays([names, pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["term", "near", "far"])

    return tokens.mapInArrow(run, "term string, near bigint, far bigint")


def collocations(rows: DataFrame, word: str, window: int = 5, min_count: int = 5) -> DataFrame:
    """(word, near, far, g2): words that stand within ``window`` tokens of ``word`` more often than expected.

    Tokens are marked and counted within Arrow batches, so the shuffle carries counted words; the work is linear
    in the tokens. The score sums the two cells near and far only.
    """
    # Turns that can't hold the word are left out before theirs are taken apart.
    tokens = token_lists(rows.where(F.col("text").rlike(search_pattern(word))).select("text")).where(F.array_contains("w", word))
    flagged = _near_hits(tokens, word, window)
    counted = flagged.where((F.col("term") != word) & (F.length("term") > 1) & ~F.col("term").rlike(r"^\p{N}+$"))
    sums = counted.groupBy("term").agg(F.sum("near").alias("a"), F.sum("far").alias("b"))
    t = sums.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    ta, tb = float(t["a"] or 0), float(t["b"] or 0)
    ea = (F.col("a") + F.col("b")) * (ta / (ta + tb or 1.0))
    eb = (F.col("a") + F.col("b")) * (tb / (ta + tb or 1.0))
    part = lambda o, e: F.when(F.col(o) > 0, F.col(o) * F.log(F.col(o) / e)).otherwise(0.0)
    kept = sums.where((F.col("a") >= min_count) & (F.col("a") > ea))
    return kept.select(F.col("term").alias("word"), F.col("a").alias("near"), F.col("b").alias("far"), F.round(2 * (part("a", ea) + part("b", eb)), 4).alias("g2"))


def keyness(counts: DataFrame, reference: DataFrame, min_freq: int = 5, threshold: float = 10.83) -> DataFrame:
    """(fold, a, b, g2, log_ratio): words over-used in ``counts`` against ``reference`` (both fold, n).

    Signed log-likelihood of the full 2 x 2 table, each cell as 2 (o log1p((o - e) / e)); the log ratio
    corrects a zero by 0.5. ``reference`` holds the other texts only.
    """
    own = counts.groupBy("fold").agg(F.sum("n").alias("a"))
    other = reference.groupBy("fold").agg(F.sum("n").alias("b"))
    c = float(own.agg(F.sum("a")).first()[0] or 0)
    d = float(other.agg(F.sum("b")).first()[0] or 0)
    j = own.where(F.col("a") >= min_freq).join(other, "fold", "left").na.fill(0, ["b"])
    n = c + d or 1.0
    s = F.col("a") + F.col("b")

    def cell(o: Column, e: Column) -> Column:
        return F.when(o > 0, o * F.log1p((o - e) / e)).otherwise(0.0)

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    g2 = 2 * (cell(a, s * (c / n)) + cell(b, s * (d / n)) + cell(F.lit(c) - a, (F.lit(n) - s) * (c / n)) + cell(F.lit(d) - b, (F.lit(n) - s) * (d / n)))
    signed = F.when(a / c >= b / (d or 1.0), g2).otherwise(-g2)
    ratio = F.log2((a / c) / (F.greatest(b, F.lit(0.5)) / (d or 1.0)))
    out = j.select("fold", F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"), F.round(signed, 4).alias("g2"), F.round(ratio, 4).alias("log_ratio"))
    return out.where(F.col("g2") >= threshold)
