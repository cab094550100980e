"""Named subsets of turns: create, combine, exclude, rebuild across editions, describe, export."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import Selection, is_chair, occurrences, search_pattern
from ..functions.terms import LONG_TURN


class StaleEdition(ValueError):
    """The subset was built on another edition of the data."""


def create(rows: DataFrame, variants: list[str], filters: Selection, min_occurrences: int = 1) -> DataFrame:
    """(id_int, country, occ, text_md5) of turns that use the variants often enough.

    A cheap accent-tolerant search picks candidates; the exact count decides. A definition without a
    term, date, person or party would take whole chambers and is refused.
    """
    if not variants and not filters.narrows:
        raise ValueError("a subset needs a term, a date, a person, a party or a sex")
    kept = filters.apply(rows)
    if variants:
        any_hit = F.lit(False)
        for v in variants:
            any_hit = any_hit | F.col("text").rlike(search_pattern(v, whole_word=True))
        kept = kept.where(any_hit).withColumn("occ", occurrences("text", variants)).where(F.col("occ") >= min_occurrences)
    else:
        kept = kept.withColumn("occ", F.lit(0))
    return kept.select("id_int", "country", F.col("occ").cast("int").alias("occ"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def combine(a: DataFrame, b: DataFrame, op: str) -> DataFrame:
    """Union, intersection or difference of two subsets by id; notes come from the first that has one."""
    ids = {"union": a.select("id_int").union(b.select("id_int")).distinct(), "intersection": a.select("id_int").intersect(b.select("id_int")), "difference": a.select("id_int").subtract(b.select("id_int"))}[op]
    first, second = a.select("id_int", F.col("note").alias("_a")), b.select("id_int", F.col("note").alias("_b"))
    return ids.join(first, "id_int", "left").join(second, "id_int", "left").select("id_int", F.coalesce("_a", "_b").alias("note"))


def add(items: DataFrame, new: DataFrame, excluded: DataFrame) -> DataFrame:
    """Append ids that are neither there nor excluded; adding twice changes nothing."""
    fresh = new.select("id_int").distinct().join(items, "id_int", "left_anti").join(excluded.select("id_int"), "id_int", "left_anti")
    return items.unionByName(fresh, allowMissingColumns=True)


def remove(items: DataFrame, excluded: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop ids and remember them, so that a rebuild doesn't bring them back."""
    return items.join(ids.select("id_int"), "id_int", "left_anti"), excluded.select("id_int").union(ids.select("id_int")).distinct()


def rebuild(items: DataFrame, rows: DataFrame) -> DataFrame:
    """(old_id, id_int, status) of every item in a new edition: the same id with the same text is kept; else
    the lowest id of the country with the same text is taken (moved); else it is lost."""
    now = rows.select("id_int", "country", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))
    same = items.alias("o").join(now.select("id_int", F.col("text_md5").alias("m")), "id_int", "left")
    by_text = now.groupBy("country", "text_md5").agg(F.min("id_int").alias("new_id"))
    j = same.join(by_text, ["country", "text_md5"], "left")
    kept = F.col("m") == F.col("text_md5")
    return j.select(F.col("id_int").alias("old_id"), F.when(kept, F.col("id_int")).otherwise(F.col("new_id")).alias("id_int"), F.when(kept, "kept").when(F.col("new_id").isNotNull(), "moved").otherwise("lost").alias("status"))


def resolve(edition: dict[str, str], catalog: DataFrame) -> None:
    """Raise unless every country's edition is the one loaded."""
    loaded = {r["country"]: r["version"] for r in catalog.select("country", "version").collect()}  # one row per country
    stale = {c: v for c, v in edition.items() if loaded.get(c) != v}
    if stale:
        raise StaleEdition(f"built on another edition: {stale}")


def describe(items: DataFrame, rows: DataFrame) -> DataFrame:
    """Per country: turns, sittings, speakers, words, women's share of words, chair and long turns, span."""
    j = rows.join(items.select("id_int").distinct(), "id_int", "left_semi")
    words = F.col("n_words")
    return j.groupBy("country").agg(
        F.count("*").alias("turns"),
        F.countDistinct("id_session").alias("sessions"),
        F.countDistinct("id_dep").alias("speakers"),
        F.sum(words).cast("bigint").alias("words"),
        F.round(F.sum(F.when(F.col("sex") == "F", words).otherwise(0)) * 100.0 / F.nullif(F.sum(words), F.lit(0)), 2).alias("women_pct"),
        F.round(F.sum(F.when(is_chair(F.col("speaker_raw")), words).otherwise(0)) * 100.0 / F.nullif(F.sum(words), F.lit(0)), 2).alias("chair_pct"),
        F.count_if(words > LONG_TURN).alias("long_turns"),
        F.count_if(F.col("date").isNull()).alias("undated"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def _checksum() -> Column:
    """A checksum of ids that needs neither order nor a list: two sums of their hashes, and their number."""
    part = lambda seed: F.hex(F.sum(F.shiftright(F.xxhash64("id_int", F.lit(seed)), 24)))
    return F.concat_ws("-", F.count("*").cast("string"), part(1), part(2))


def export(items: DataFrame, rows: DataFrame, folder: str, definition: dict) -> None:
    """Write a subset as JSON by country, with an index of its definition and a checksum of its ids, whatever their order."""
    j = rows.join(items, "id_int", "left_semi").select("country", "id_int", "date", "speaker_raw", "text")
    j.write.mode("error").partitionBy("country").json(f"{folder}/items")
    digest = j.groupBy("country").agg(F.count("*").alias("n"), _checksum().alias("checksum"))
    digest.withColumn("definition", F.lit(json.dumps(definition, sort_keys=True))).write.mode("error").json(f"{folder}/index")


def load(spark: SparkSession, folder: str) -> DataFrame:
    """Read an exported subset; a file whose ids don't match the index raises."""
    items = spark.read.json(f"{folder}/items")
    index = spark.read.json(f"{folder}/index")
    now = items.groupBy("country").agg(_checksum().alias("now"))
    bad = index.join(now, "country", "left").where(~F.col("checksum").eqNullSafe(F.col("now"))).limit(1).collect()
    if bad:
        raise ValueError(f"checksum of {bad[0]['country']} differs")
    return items


def save(items: DataFrame, store: str, name: str, definition: dict) -> None:
    """Keep a subset under a name; a name that is taken is refused."""
    if not name or "/" in name or "=" in name:
        raise ValueError(f"no name for a subset: {name!r}")
    items.withColumn("definition", F.lit(json.dumps(definition, sort_keys=True))).write.mode("error").parquet(f"{store}/name={name}")


def listing(spark: SparkSession, store: str) -> DataFrame:
    """(name, turns, countries, definition) of every subset that is kept."""
    kept = spark.read.option("basePath", store).parquet(f"{store}/*")
    return kept.groupBy("name").agg(F.count("*").alias("turns"), F.sort_array(F.collect_set("country")).alias("countries"), F.min("definition").alias("definition"))


def delete(spark: SparkSession, store: str, name: str) -> bool:
    """Remove a subset; whether it was there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/name={name}")
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True))


def create_by_country(rows: DataFrame, shared: dict, overrides: dict[str, dict] | None = None) -> DataFrame:
    """A subset whose definition may differ by country: ``variants``, ``selection``, ``min_occurrences`` and ``event`` (day, before, after).

    ``overrides`` replaces parts of ``shared`` for a country; countries without any get the shared definition.
    """
    from ..functions.dates import event_window

    def one(part: DataFrame, d: dict) -> DataFrame:
        if d.get("event"):
            part = part.where(event_window(F.col("date"), *d["event"]))
        return create(part, d.get("variants", []), d.get("selection", Selection()), d.get("min_occurrences", 1))

    overrides = overrides or {}
    out = one(rows.where(~F.col("country").isin(*overrides, "")), shared)
    for country, own in overrides.items():
        out = out.unionByName(one(rows.where(F.col("country") == country), {**shared, **own}))
    return out


def create_from_query(spark: SparkSession, sql: str, rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """A subset of the turns whose ``id_int`` a guarded query returns."""
    from ..sources.corpus import guarded_sql

    ids, cut = guarded_sql(spark, sql, tables, max_rows=(1 << 31) - 2)
    if "id_int" not in ids.columns:
        raise ValueError("the query must return id_int")
    return rows.join(ids.select("id_int").distinct(), "id_int", "left_semi").select("id_int", "country", F.lit(0).alias("occ"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def notes(described: DataFrame) -> DataFrame:
    """(country, note): what to mind when a subset's countries are compared, from ``describe``."""
    both = described.agg(F.max("turns").alias("most"), F.min("first_date").alias("a"), F.max("last_date").alias("b")).first()
    rules = [
        (F.col("turns") * 10 <= F.lit(both["most"] or 0), "ten times fewer turns than the largest"),
        (F.col("long_turns") > F.col("turns") * 0.2, "over 20 % long turns"),
        (F.col("chair_pct") > 25, "over 25 % of the words from the chair"),
        (F.col("undated") > 0, "undated turns"),
        ((F.year("first_date") != F.lit(both["a"].year if both["a"] else 0)) | (F.year("last_date") != F.lit(both["b"].year if both["b"] else 0)), "another span of years"),
    ]
    listed = F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in rules]), lambda x: x.isNotNull())
    return described.select("country", F.explode(listed).alias("note"))
