"""Checks and repairs of a prepared corpus: fingerprint, conformity, validation, speaker variants, neighbours, meta data."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import written_date
from ..functions.text import fold
from .asof import flexible_date
from .spotting import token_lists
from .texts import indel_ratio


def fingerprint(rows: DataFrame) -> DataFrame:
    """(measure, value): magnitudes of a corpus that a rerun of its pipeline should keep."""
    lines = F.split("text", "\n")
    digits = F.size(F.filter(lines, lambda x: x.rlike(r"^\W*\d+\W*$")))
    cut = F.size(F.filter(lines, lambda x: x.rlike(r"[\p{L}][-­‐¬]\s*$")))
    a = rows.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"),
        F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"),
        F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("empty"),
        F.count("id_dep").alias("linked"),
        F.count_if(F.col("date").isNull()).alias("undated"),
        F.countDistinct("id_session").alias("sessions"),
        F.countDistinct("id_dep").alias("persons"),
        F.countDistinct("speaker_raw").alias("speakers"),
        F.count_if(F.col("speaker_raw").isNull()).alias("unnamed"),
        F.count_if(F.col("n_words") > 10_000).alias("long_turns"),
        F.count_if(F.col("n_words") < 5).alias("short_turns"),
        F.countDistinct(F.year("date")).alias("years"),
        F.coalesce(F.max(F.length("text")), F.lit(0)).alias("longest"),
        F.coalesce(F.sum(F.when(F.col("text").isNotNull(), digits)), F.lit(0)).alias("digit_lines"),
        F.coalesce(F.sum(F.when(F.col("text").isNotNull(), cut)), F.lit(0)).alias("cut_lines"),
    )
    single = rows.where(F.col("speaker_raw").isNotNull()).groupBy("country", "speaker_raw").count().where("count = 1").agg(F.count("*").alias("hapax_speakers"))
    pairs = lambda df: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("value")) for c in df.columns])).alias("s")).select("s.*")
    return pairs(a).unionByName(pairs(single))


def fingerprint_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Measures that differ between two fingerprints."""
    b = before.withColumnRenamed("value", "before")
    return b.join(after.withColumnRenamed("value", "after"), "measure", "full").where(~F.col("before").eqNullSafe(F.col("after")))


def conformity(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(rule, broken): rows that break each rule of the published form; 0 is good."""
    ids = F.col("id_int").rlike(r"^[A-Z]{2}\d{12}$")
    one = rows.agg(
        F.count_if(~F.coalesce(ids, F.lit(False))).alias("id_form"),
        F.count_if(~F.coalesce(F.substring("id_int", 1, 9) == F.col("id_session"), F.lit(False))).alias("id_prefix"),
        F.count_if(~F.coalesce(F.col("sex").isin("F", "M"), F.lit(True))).alias("sex_value"),
        F.count_if(~F.coalesce(F.col("dm_speech").isin(0, 1), F.lit(False))).alias("speech_flag"),
        F.count_if(F.col("intervention_order") < 0).alias("order_negative"),
        F.count_if(F.col("text").rlike(r"<[a-zA-Z/][^>]*>")).alias("markup"),
        F.count_if(F.col("id_dep").isNotNull() & (F.substring("id_dep", 1, 2) != F.col("country"))).alias("foreign_id"),
        F.count_if(F.col("date").isNull()).alias("date_missing"),
        F.count_if((F.col("dm_speech") == 1) & (F.coalesce(F.trim("text"), F.lit("")) == "")).alias("speech_without_text"),
        F.count_if((F.col("dm_speech") == 1) & (F.coalesce(F.trim("speaker_raw"), F.lit("")) == "")).alias("speech_without_speaker"),
        F.count_if(F.col("id_dep").isNotNull() & (F.coalesce(F.trim("party"), F.lit("")) == "")).alias("person_without_party"),
        F.count_if(F.coalesce(F.trim("legislature"), F.lit("")) == "").alias("legislature_missing"),
    )
    unknown = rows.where(F.col("id_dep").isNotNull()).join(register.select("id_dep").distinct(), "id_dep", "left_anti").agg(F.count("*").alias("unknown_id"))
    orders = rows.where(F.col("intervention_order") > 0).groupBy("id_session", "intervention_order").count().where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("order_repeated"))
    days = rows.where(F.col("date").isNotNull()).groupBy("id_session").agg(F.countDistinct("date").alias("d")).where("d > 1").agg(F.count("*").alias("session_days"))
    out = None
    for df in (one, unknown, orders, days):
        part = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(c).cast("bigint").alias("broken")) for c in df.columns])).alias("s")).select("s.*")
        out = part if out is None else out.unionByName(part)
    return out


def verdicts(rows: DataFrame, least_linked: float = 0.5, most_giant: float = 0.02) -> DataFrame:
    """(id_session, verdict, reasons): PASS, or FLAG with reasons: few linked turns, giant turns, leftover markers, no text."""
    speech = F.col("dm_speech") == 1
    median = rows.where(speech).groupBy("id_session").agg(F.median("n_words").alias("m"))
    marker = F.col("text").rlike(r"(?u)\n\s*(?:El señor|La señora|O SR\.|A SRA\.) \p{Lu}")
    g = rows.join(median, "id_session", "left").groupBy("id_session").agg(
        F.count_if(speech).alias("n"),
        F.count_if(speech & F.col("id_dep").isNotNull()).alias("linked"),
        F.count_if(speech & (F.col("n_words") > 20 * F.col("m")) & (F.col("n_words") > 400)).alias("giant"),
        F.count_if(speech & marker).alias("markers"),
    )
    reasons = F.filter(
        F.array(
            F.when(F.col("n") == 0, "no speech"),
            F.when(F.col("linked") < F.col("n") * least_linked, "few linked"),
            F.when(F.col("giant") > F.col("n") * most_giant, "giant turns"),
            F.when(F.col("markers") > 0, "markers left"),
        ),
        lambda x: x.isNotNull(),
    )
    return g.select("id_session", F.when(F.size(reasons) == 0, "PASS").otherwise("FLAG").alias("verdict"), F.array_join(reasons, "; ").alias("reasons"))


def confidence(scores: DataFrame, group: list[str], score: str) -> DataFrame:
    """Mean, minimum and harmonic mean (of positive scores) by group, with a level: AUTO from .85, FLAG from .65, else HALT."""
    positive = F.when(F.col(score) > 0, F.col(score))
    g = scores.groupBy(*group).agg(F.avg(score).alias("mean"), F.min(score).alias("least"), (F.count(positive) / F.sum(1 / positive)).alias("harmonic"))
    return g.withColumn("level", F.when(F.col("mean") >= 0.85, "AUTO").when(F.col("mean") >= 0.65, "FLAG").otherwise("HALT"))


def skeleton(c: Column) -> Column:
    """Letters of a typed name, folded, without titles and marks."""
    plain = F.regexp_replace(fold(c), r"^\W*(?:(?:el|la|o|a)\s+)?(?:sr|sra|senor|senora|senhor|senhora|dip|dep|diputad[oa]|deputad[oa])\b\.?", "")
    return F.regexp_replace(F.regexp_replace(plain, r"\([^)]*\)", ""), r"[^\p{L}]", "")


def usual_spelling(rows: DataFrame) -> DataFrame:
    """(country, speaker_raw, usual): the commonest typed form of each letter skeleton; ties to the first in the alphabet."""
    n = rows.where(F.col("speaker_raw").isNotNull()).groupBy("country", "speaker_raw").agg(F.count("*").alias("n")).withColumn("k", skeleton(F.col("speaker_raw"))).where("k <> ''")
    best = n.groupBy("country", "k").agg(F.min_by("speaker_raw", F.struct(-F.col("n"), "speaker_raw")).alias("usual"))
    return n.join(best, ["country", "k"]).select("country", "speaker_raw", "usual")


def rare_to_frequent(rows: DataFrame, rare: int = 3, frequent: int = 10, most: int = 2) -> DataFrame:
    """(country, rare, frequent, d): rare skeletons that are a few letters from one frequent skeleton alone.

    Skeletons meet through a shared third of their letters (blocking): with two edits one third stays intact.
    """
    n = rows.where(F.col("speaker_raw").isNotNull()).select("country", skeleton(F.col("speaker_raw")).alias("k")).where(F.length("k") >= 9).groupBy("country", "k").agg(F.count("*").alias("n"))
    third = F.ceil(F.length("k") / 3)
    pieces = [F.substring(F.col("k"), F.lit(1), third), F.substring(F.col("k"), third + 1, third), F.substring(F.col("k"), 2 * third + 1, F.length("k"))]
    blocks = n.where(F.col("n") >= frequent).select("country", F.col("k").alias("f"), F.posexplode(F.array(*pieces)).alias("place", "block"))
    size = F.length("k")
    # The intact third stands in the rare form too; the frequent form may be up to ``most`` letters longer or shorter.
    sizes = F.sequence(size - most, size + most)
    lengths = F.array_distinct(F.concat(F.transform(sizes, lambda m: F.ceil(m / 3)), F.transform(sizes, lambda m: m - 2 * F.ceil(m / 3))))
    every = F.flatten(F.transform(lengths, lambda L: F.transform(F.sequence(F.lit(1), F.greatest(size - L + 1, F.lit(1))), lambda i: F.substring(F.col("k"), i, L))))
    cuts = n.where(F.col("n") <= rare).select("country", F.col("k"), F.explode(F.array_distinct(every)).alias("block"))
    pairs = cuts.join(blocks, ["country", "block"]).where(F.col("k") != F.col("f")).select("country", "k", "f").distinct().withColumn("d", F.levenshtein("k", "f")).where(F.col("d") <= most)
    alone = F.count("*").over(Window.partitionBy("country", "k"))
    return pairs.withColumn("c", alone).where("c = 1").select("country", F.col("k").alias("rare"), F.col("f").alias("frequent"), "d")


#: Shares of the letters in Spanish and Portuguese names, per mille; others are rarer.
_SHARES = dict(a=140, e=100, o=90, r=85, n=75, i=75, l=60, s=60, d=50, c=40, t=35, u=35, m=35, b=25, z=20, p=20, g=18, v=15, f=10, h=10, j=8, q=5, y=5, x=3)


def _rarest_first(k: str) -> list[str]:
    """The letters of a skeleton, each with its number among its equals, those first that few skeletons have."""
    seen: dict[str, int] = {}
    items = []
    for c in k:
        n = seen[c] = seen.get(c, 0) + 1
        mean = _SHARES.get(c, 1) / 50
        items.append((mean**n / math.factorial(min(n, 100)), c, n))
    return [f"{c}{n}" for _, c, n in sorted(items)]


def variants_of_frequent(rows: DataFrame, frequent: int = 20, similarity: float = 92, margin: float = 6) -> DataFrame:
    """(country, rare, frequent, d): every skeleton below ``frequent`` uses that is like one skeleton with as many uses or more.

    The likest one counts if its indel ratio is at least ``similarity`` and ``margin`` above any other frequent
    skeleton. Short names can't reach the ratio with one edit: if none reaches it, ``rare_to_frequent`` decides,
    for names of 9 letters and more; shorter ones go by the ratio alone.

    Blocking loses no pair above ``similarity - margin``: for lengths a and m such a pair has at least c letters in
    common, so the a - c + 1 first and the m - c + 1 first letters of the two, in one order of all letters, share one.
    """
    low = similarity - margin
    n = rows.where(F.col("speaker_raw").isNotNull()).select("country", skeleton(F.col("speaker_raw")).alias("k")).where("k <> ''").groupBy("country", "k").agg(F.count("*").alias("n"))

    def keys(rare: bool):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                country, name, key = [], [], []
                for c, k in zip(b.column("country").to_pylist(), b.column("k").to_pylist()):
                    a, items = len(k), _rarest_first(k)
                    for m in range(math.floor(a * low / (200 - low)), math.ceil(a * (200 - low) / low) + 1):
                        least = max(1, math.ceil(low * (a + m) / 200 - 1e-9))
                        if least <= min(a, m):
                            found = [f"{a} {m} {x}" if rare else f"{m} {a} {x}" for x in items[: a - least + 1]]
                            country += [c] * len(found)
                            name += [k] * len(found)
                            key += found
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (country, name, key)], names=["country", "k", "key"])

        return run

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [indel_ratio(x, y) for x, y in zip(b.column("k").to_pylist(), b.column("f").to_pylist())]
            out = pa.RecordBatch.from_arrays([b.column("country"), b.column("k"), b.column("f"), pa.array(s, pa.float64())], names=["country", "k", "f", "s"])
            yield out.filter(pa.array([x > low for x in s], pa.bool_()))

    form = "country string, k string, key string"
    odd = n.where(F.col("n") < frequent).select("country", "k").mapInArrow(keys(True), form)
    usual = n.where(F.col("n") >= frequent).select("country", "k").mapInArrow(keys(False), form).withColumnRenamed("k", "f")
    pairs = odd.join(usual, ["country", "key"]).select("country", "k", "f")
    scored = pairs.mapInArrow(score, "country string, k string, f string, s double").distinct()
    w = Window.partitionBy("country", "k").orderBy(F.desc("s"), "f")
    best = scored.withColumn("place", F.row_number().over(w)).withColumn("second", F.lead("s").over(w)).where((F.col("place") == 1) & (F.col("s") >= similarity))
    clear = F.coalesce("second", F.lit(0.0)) <= F.col("s") - margin
    like = best.select("country", F.col("k").alias("rare"), F.col("f").alias("frequent"), F.levenshtein("k", "f").alias("d"), clear.alias("clear"))
    edited = rare_to_frequent(rows, frequent - 1, frequent).join(like.select("country", "rare"), ["country", "rare"], "left_anti")
    return like.where("clear").drop("clear").unionByName(edited)


def register_duplicates(register: DataFrame) -> DataFrame:
    """(country, a, b, name): different ids whose names have the same three or more tokens, whatever their order."""
    key = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(fold("speaker_name"), F.lit(r"[\p{L}]{3,}"), F.lit(0)))), " ")
    p = register.where(F.col("speaker_name").isNotNull()).select("country", "id_dep", key.alias("name")).where(F.size(F.split("name", " ")) >= 3).distinct()
    first = p.groupBy("country", "name").agg(F.min("id_dep").alias("a"), F.count("*").alias("n")).where("n > 1")
    return p.join(first, ["country", "name"]).where("id_dep <> a").select("country", "a", F.col("id_dep").alias("b"), "name")


_SHORT = dict(ma="maria", jo="jose", fco="francisco", fca="francisca", ant="antonio", ml="manuel", mnl="manuel", gmo="guillermo", fdo="fernando", dgo="domingo", mgl="miguel", rfl="rafael", edo="eduardo", alb="alberto", jn="juan")
_PARTICLES = "de del la las los y vda viuda da do dos das e".split()


def register_variants(register: DataFrame, contiguous: int = 730) -> DataFrame:
    """(country, a, b, kind): different ids whose names share the first three tokens of their core but differ beyond.

    The core is the name without particles, abbreviations written out. ``married``: one name alone has "de" or "vda"
    before a name, and the cores differ; else ``abbreviation``, also if only written-out abbreviations make the cores
    equal. Two national ids in the notes that differ tell persons apart, and so do terms more than ``contiguous`` days apart.
    """
    national = F.nullif(F.regexp_extract("notes", r"\b(\d{3}-\d{7}-\d|\d{7,11})\b", 1), F.lit(""))
    first = lambda c: F.min(F.when(c.isNotNull(), F.struct(F.col("reg_n"), c.alias("v"))))["v"]
    g = register.where(F.col("id_dep").isNotNull()).groupBy("country", "id_dep").agg(
        first(F.nullif(F.trim("speaker_name"), F.lit(""))).alias("name"), first(national).alias("national"),
        F.min(flexible_date(F.col("start_date"))).alias("opens"), F.max(flexible_date(F.col("end_date"))).alias("ends"),
    )
    tokens = F.filter(F.split(F.regexp_replace(fold("name"), r"[^a-z\s]", " "), r"\s+"), lambda t: t != "")
    short = F.create_map(*[F.lit(x) for kv in _SHORT.items() for x in kv])
    p = g.withColumn("tokens", tokens).withColumn("plain", F.filter("tokens", lambda t: ~t.isin(_PARTICLES)))
    p = p.withColumn("core", F.filter(F.transform("tokens", lambda t: F.coalesce(F.try_element_at(short, t), t)), lambda t: ~t.isin(_PARTICLES)))
    p = p.withColumn("marked", F.col("name").rlike(r"(?iu)(?<![\p{L}\p{N}_])(?:de|del|vda\.?|viuda)\s+[a-záéíóúñ]")).withColumn("ends", F.coalesce("ends", "opens"))
    p = p.where(F.size("core") >= 3).withColumn("key", F.array_join(F.slice("core", 1, 3), " ")).withColumn("tokens", F.array_sort(F.array_distinct("tokens")))
    a, b = [p.select("country", "key", F.struct("id_dep", "national", "opens", "ends", "tokens", "plain", "core", "marked").alias(x)) for x in "ab"]
    away = F.least(F.abs(F.datediff("b.opens", "a.ends")), F.abs(F.datediff("a.opens", "b.ends")))
    apart = ((F.col("a.ends") < F.col("b.opens")) | (F.col("b.ends") < F.col("a.opens"))) & (away > contiguous)
    j = a.join(b, ["country", "key"]).where((F.col("a.id_dep") < F.col("b.id_dep")) & (F.col("a.plain") != F.col("b.plain")))
    j = j.where(~F.coalesce(F.col("a.national") != F.col("b.national"), F.lit(False)) & ~F.coalesce(apart, F.lit(False)))
    married = (F.col("a.marked") != F.col("b.marked")) & (F.col("a.core") != F.col("b.core"))
    kind = F.when(married, "married").when(F.col("a.tokens") != F.col("b.tokens"), "abbreviation")
    return j.select("country", F.col("a.id_dep").alias("a"), F.col("b.id_dep").alias("b"), kind.alias("kind")).where("kind IS NOT NULL")


def adopt_neighbour(rows: DataFrame, within: int = 10) -> DataFrame:
    """(id_int, id_dep): unlinked turns whose letter skeleton is that of exactly one linked speaker at most ``within`` places away in the sitting.

    Turns are keyed by (sitting, skeleton), so only equal names meet.
    """
    place = F.row_number().over(Window.partitionBy("id_session").orderBy("id_int"))
    k = rows.withColumn("place", place).withColumn("k", skeleton(F.col("speaker_raw"))).where(F.length("k") >= 6).select("id_session", "id_int", "id_dep", "place", "k")
    linked = k.where("id_dep IS NOT NULL").select("id_session", "k", F.col("id_dep").alias("d"), F.col("place").alias("p"))
    j = k.where("id_dep IS NULL").join(linked, ["id_session", "k"]).where(F.abs(F.col("place") - F.col("p")) <= within)
    return j.groupBy("id_int").agg(F.countDistinct("d").alias("n"), F.min("d").alias("id_dep")).where("n = 1").drop("n")


def no_person(speaker: Column) -> Column:
    """Why a typed speaker is no person: office, voices, unknown, blank; null for a person."""
    f = fold(speaker)
    return (
        F.when(F.coalesce(F.trim(speaker), F.lit("")) == "", "blank")
        .when(f.rlike(r"^\W*(una voz|um senhor|uma voz|varios|vozes|voces|senhores|senores)"), "voices")
        .when(f.rlike(r"^\W*\(?(sin identificar|nao identificad|no identificad)"), "unknown")
        .when(f.rlike(r"^\W*(?:el |la |o |a )?(?:sr\.? |sra\.? |senor |senora |senhor )?(?:president[ea]|presidencia|secretari[oa]|mesa|comision|comissao|ministr[oa]|relator)(?:\W*$| d[aeo] | diret| direct)"), "office")
    )


def header_dates(rows: DataFrame) -> DataFrame:
    """(id_session, date, printed, verdict): the sitting's date against the dates printed in its page headers.

    OK if the commonest printed date is the date (ties to the earliest), DIFFERENT if not, NONE without any.
    """
    every = F.regexp_extract_all("text", F.lit(r"(?m)^.{0,40}?(\d{2}/\d{2}/\d{4})"), F.lit(1))
    found = rows.select("id_session", F.explode(every).alias("found")).groupBy("id_session", "found").agg(F.count("*").alias("n"))
    seen = found.withColumn("printed", written_date(F.col("found"))).where(F.col("printed").isNotNull())
    usual = seen.groupBy("id_session").agg(F.min_by("printed", F.struct(-F.col("n"), "printed")).alias("printed"))
    s = rows.groupBy("id_session").agg(F.min("date").alias("date"))
    verdict = F.when(F.col("printed").isNull(), "NONE").when(F.col("printed").eqNullSafe(F.col("date")), "OK").otherwise("DIFFERENT")
    return s.join(usual, "id_session", "left").select("id_session", "date", "printed", verdict.alias("verdict"))


def theme_dominance(rows: DataFrame, themes: DataFrame, least_terms: int = 2) -> DataFrame:
    """(id_int, theme, share): the theme that a turn names most of, by share of the theme's terms; ties give none.

    ``themes``: theme, term (folded words), a dictionary of bounded size.
    """
    size = themes.groupBy("theme").agg(F.countDistinct("term").alias("size"))
    hit = token_lists(rows, "id_int").select("id_int", F.explode(F.array_distinct("w")).alias("term")).join(themes, "term").groupBy("id_int", "theme").agg(F.count("*").alias("n")).where(F.col("n") >= least_terms)
    scored = hit.join(size, "theme").withColumn("share", F.col("n") / F.col("size"))
    w = Window.partitionBy("id_int").orderBy(F.desc("share"), "theme")
    ranked = scored.withColumn("k", F.row_number().over(w)).withColumn("second", F.lead("share").over(w))
    return ranked.where((F.col("k") == 1) & (F.coalesce("second", F.lit(0.0)) < F.col("share"))).select("id_int", "theme", F.round("share", 6).alias("share"))
