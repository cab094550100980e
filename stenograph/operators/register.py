"""Joins between turns and registers of persons: cascades, covering and nearest terms, propagation, checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import flexible_date


def filled(c: Column) -> Column:
    """A value, or null where it is blank or a written-out missing value."""
    t = F.trim(c.cast("string"))
    return F.when((t != "") & ~F.lower(t).isin("nan", "none", "null"), t)


def typed_terms(deputies: DataFrame) -> DataFrame:
    """One row per register row with real dates; a null or blank end is open."""
    one = deputies.groupBy("reg_n").agg(F.first(F.struct("country", "id_dep", "speaker_name", "party", "district", "sex", "legislature", "start_date", "end_date", "recorded_on")).alias("r")).select("reg_n", "r.*")
    return one.withColumns({c: flexible_date(F.col(c)) for c in ("start_date", "end_date", "recorded_on")})


def close_open_terms(terms: DataFrame) -> DataFrame:
    """Give open terms an end: the day before the next legislature's first start in the country; the last stays open (2999-12-31)."""
    starts = terms.where(F.col("start_date").isNotNull()).groupBy("country", "legislature").agg(F.min("start_date").alias("opens"))
    following = starts.withColumn("next_opens", F.lead("opens").over(Window.partitionBy("country").orderBy("opens", "legislature")))
    end = F.coalesce("end_date", F.date_sub("next_opens", 1), F.lit("2999-12-31").cast("date"))
    return terms.join(following.drop("opens"), ["country", "legislature"], "left").withColumn("closed_end", end).drop("next_opens")


def covering_term(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Each (id_int, id_dep, date) with one register row: a term covering the date, else the nearest by days.

    Ties go to the later start, then the higher ``reg_n``. ``distance`` is 0 inside a term. Distinct
    (person, date) pairs are resolved once and joined back, so busy persons cost no more than others.
    """
    asked = rows.where(F.col("id_dep").isNotNull() & F.col("date").isNotNull()).select("id_dep", "date").distinct()
    far = F.greatest(F.datediff("start_date", "date"), F.coalesce(F.datediff("date", "end_date"), F.lit(0)), F.lit(0))
    near = asked.join(terms.where(F.col("start_date").isNotNull()), "id_dep").withColumn("distance", far)
    best = near.groupBy("id_dep", "date").agg(F.min_by(F.struct("reg_n", "party", "distance"), F.struct("distance", -F.unix_date("start_date"), -F.col("reg_n"))).alias("b"))
    return rows.join(best, ["id_dep", "date"], "left").select("id_int", "id_dep", "date", F.col("b.reg_n").alias("reg_n"), F.col("b.party").alias("term_party"), F.col("b.distance").alias("distance"))


def in_office(terms: DataFrame, day: str) -> DataFrame:
    """Persons whose term covers a day."""
    d = F.lit(day).cast("date")
    return terms.where((F.col("start_date") <= d) & (F.coalesce("end_date", F.lit("2999-12-31").cast("date")) >= d)).select("country", "id_dep").distinct()


def finest_key(rows: Sequence[str], table: Sequence[str], key: str, others: Sequence[str]) -> list[str]:
    """The most precise join key two schemas share: ``key`` with the first of ``others`` both have, else alone."""
    for o in others:
        if o in rows and o in table:
            return [key, o]
    return [key]


def merge_ids(rows: DataFrame, matches: DataFrame, key: str = "speaker_raw", finer: Sequence[str] = ("date", "legislature")) -> DataFrame:
    """Fill ``id_dep`` from a matching table on the finest key both sides have; ids already there win.

    The table is brought down to one id per key first (keys with several ids are left out), so the join
    never multiplies rows. Rows without a key stay.
    """
    on = finest_key(rows.columns, matches.columns, key, finer)
    single = matches.where(filled(F.col("id_dep")).isNotNull()).groupBy(*on).agg(F.countDistinct("id_dep").alias("n"), F.min("id_dep").alias("matched_id")).where("n = 1").drop("n")
    joined = rows.join(single, on, "left")
    return joined.withColumn("id_dep", F.coalesce(filled(F.col("id_dep")), "matched_id")).drop("matched_id")


def override_ids(rows: DataFrame, overrides: DataFrame, on: Sequence[str]) -> DataFrame:
    """Replace ids by an override table, except where the row's ``match_method`` is manual."""
    o = overrides.select(*on, F.col("id_dep").alias("_id")).dropDuplicates(list(on))
    take = F.col("_id").isNotNull() & ~F.coalesce(F.col("match_method") == "manual", F.lit(False))
    return rows.join(o, list(on), "left").withColumn("id_dep", F.when(take, F.col("_id")).otherwise(F.col("id_dep"))).drop("_id")


def require_overlap(a: DataFrame, b: DataFrame, on: Sequence[str]) -> None:
    """Raise if two tables share no key, before an expensive join gives nothing."""
    if a.select(*on).join(b.select(*on), list(on), "left_semi").limit(1).count() == 0:
        raise ValueError(f"no common key in {list(on)}")


def legislature_key(c: Column) -> Column:
    """Marks such as º or . stripped, a two-letter prefix too if only digits follow."""
    plain = F.regexp_replace(F.trim(c), "[º°ª.]", "")
    return F.regexp_replace(plain, r"^[A-Za-z]{2}(?=\d+$)", "")


def propagate_single_valued(rows: DataFrame, person: str, attribute: str) -> DataFrame:
    """Fill a person's missing attribute from the other rows if these agree on one value."""
    value = filled(F.col(attribute))
    known = rows.where(F.col(person).isNotNull() & value.isNotNull()).groupBy(person).agg(F.countDistinct(value).alias("n"), F.min(value).alias("_v")).where("n = 1").drop("n")
    return rows.join(known, person, "left").withColumn(attribute, F.coalesce(value, "_v")).drop("_v")


def clip_overlaps(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pairs of spells of one key that overlap (strictly), clipped to their common span.

    ``left`` and ``right``: key, a label, start, end as (key, l_label, l_start, l_end) and (key, r_label, r_start, r_end).
    """
    j = left.join(right, key).where((F.col("l_start") < F.col("r_end")) & (F.col("l_end") > F.col("r_start")))
    return j.select(key, "l_label", "r_label", F.greatest("l_start", "r_start").alias("start"), F.least("l_end", "r_end").alias("end"))


def unknown_ids(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(id_dep, turns) of ids that the register lacks."""
    return rows.where(F.col("id_dep").isNotNull()).join(register.select("id_dep").distinct(), "id_dep", "left_anti").groupBy("id_dep").agg(F.count("*").alias("turns"))


def ambiguous_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys linked to more than one person."""
    g = rows.where(F.col(key).isNotNull() & F.col("id_dep").isNotNull()).groupBy("country", key).agg(F.countDistinct("id_dep").alias("persons"), F.count("*").alias("turns"))
    return g.where(F.col("persons") > 1)


def impose_frozen(rows: DataFrame, frozen: DataFrame, key: str) -> DataFrame:
    """Overwrite ids from frozen decisions; keys with several decisions are left alone."""
    single = frozen.groupBy("country", key).agg(F.countDistinct("id_dep").alias("n"), F.min("id_dep").alias("_f")).where("n = 1").drop("n")
    return rows.join(single, ["country", key], "left").withColumn("id_dep", F.coalesce("_f", "id_dep")).drop("_f")


def sex_cascade(rows: DataFrame, register: DataFrame, manual: DataFrame | None = None, agree: float = 0.9) -> DataFrame:
    """(id_dep, sex, sex_source) by falling authority; null where nothing tells.

    ``manual`` decisions (id_dep, sex), the register, a note ("sexo: F"), the honorific typed before the name (``agree``
    of the person's), the given name if two or more persons of the register have it and all of one sex (``name``) or
    one has (``rare``), and at last the ending of the first given name, a or o (``ending``).
    """
    clean = lambda c: F.when(F.upper(F.trim(c)).isin("F", "M"), F.upper(F.trim(c)))
    one = lambda df, c, name: df.where(c.isNotNull()).groupBy("id_dep").agg(F.countDistinct(c).alias("n"), F.min(c).alias(name)).where("n = 1").drop("n")
    reg = one(register, clean(F.col("sex")), "registered")
    noted = one(register, clean(F.nullif(F.regexp_extract("notes", r"(?iu)sexo\s*:\s*([FM])(?!\p{L})", 1), F.lit(""))), "noted") if "notes" in register.columns else reg.limit(0).withColumnRenamed("registered", "noted")
    told = one(manual, clean(F.col("sex")), "decided") if manual is not None else reg.limit(0).withColumnRenamed("registered", "decided")
    title = F.when(F.col("speaker_raw").rlike(r"(?iu)^\W*(la|a)\s+(sra|señora|senhora|diputada|deputada)|^\W*(sra|diputada|deputada)\b"), "F").when(
        F.col("speaker_raw").rlike(r"(?iu)^\W*(el|o)\s+(sr|señor|senhor|diputado|deputado)\b|^\W*(sr|diputado|deputado)\b"), "M"
    )
    typed = rows.where(F.col("id_dep").isNotNull()).select("id_dep", title.alias("t")).where(F.col("t").isNotNull())
    honor = typed.groupBy("id_dep").agg(F.count("*").alias("n"), F.count_if(F.col("t") == "F").alias("f"))
    honor = honor.select("id_dep", F.when(F.col("f") >= F.col("n") * agree, "F").when(F.col("f") <= F.col("n") * (1 - agree), "M").alias("honorific"))
    given = F.lower(F.split(F.trim("speaker_name"), r"\s+")[0])
    people = register.where(F.col("speaker_name").isNotNull()).groupBy("id_dep").agg(F.min(given).alias("given"))
    names = people.join(reg, "id_dep").groupBy("given").agg(F.count("*").alias("n"), F.countDistinct("registered").alias("k"), F.min("registered").alias("s")).where("k = 1")
    learned = names.select("given", F.when(F.col("n") >= 2, F.col("s")).alias("by_name"), F.when(F.col("n") == 1, F.col("s")).alias("by_rare"))
    out = people.join(told, "id_dep", "left").join(reg, "id_dep", "left").join(noted, "id_dep", "left").join(honor, "id_dep", "left").join(learned, "given", "left")
    ending = F.when(F.col("given").endswith("a"), "F").when(F.col("given").endswith("o"), "M")
    sources = {"manual": F.col("decided"), "register": F.col("registered"), "note": F.col("noted"), "honorific": F.col("honorific"), "name": F.col("by_name"), "rare": F.col("by_rare"), "ending": ending}
    return out.select("id_dep", F.coalesce(*sources.values()).alias("sex"), F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in sources.items()]).alias("sex_source"))


def review_sheet(rows: DataFrame, stratum: str, key: str, per_stratum: int, seed: str = "review") -> DataFrame:
    """``per_stratum`` rows of each stratum for people to check, in the order of md5(key and seed) (a sampling operator)."""
    w = Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.col(key), F.lit(seed))), key)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= per_stratum)


def apply_review(rows: DataFrame, sheet: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with the values people decided: of the sheet only rows whose ``source`` is ``manual`` count; keys decided twice don't."""
    decided = sheet.where((F.col("source") == "manual") & filled(F.col(value)).isNotNull()).groupBy(key).agg(F.countDistinct(value).alias("n"), F.min(value).alias("_v")).where("n = 1").drop("n")
    return rows.join(decided, key, "left").withColumn(value, F.coalesce("_v", value)).drop("_v")


def seats_check(terms: DataFrame, factor: float = 1.4) -> DataFrame:
    """Legislatures with more persons than ``factor`` times the country's median."""
    n = terms.where(F.col("legislature").isNotNull()).groupBy("country", "legislature").agg(F.countDistinct("id_dep").alias("persons"))
    m = n.groupBy("country").agg(F.median("persons").alias("usual"))
    return n.join(m, "country").where(F.col("persons") > F.col("usual") * factor)


def bound_terms(terms: DataFrame, rows: DataFrame) -> DataFrame:
    """Terms clipped to the days their legislature really met: (reg_n, start, end); empty ones are left out."""
    met = rows.where(F.col("date").isNotNull()).groupBy("country", "legislature").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    j = terms.where(F.col("start_date").isNotNull()).join(met, ["country", "legislature"])
    clipped = j.select("reg_n", F.greatest("start_date", "a").alias("start"), F.least(F.coalesce("end_date", "b"), "b").alias("end"))
    return clipped.where(F.col("start") <= F.col("end"))
