"""Persons and sittings brought into the published form: matching cascades, standard columns, names, presidency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.terms import is_chair
from ..functions.text import fold
from ..sources.corpus import CANONICAL, resolve_aliases
from .quality import skeleton
from .register import filled
from .sequence import impute_by_date


def match_cascade(rows: DataFrame, table: DataFrame, levels: Sequence[Sequence[str]], value: str = "id_dep") -> DataFrame:
    """``rows`` with ``value`` filled from ``table``, and ``match_level``: the number of the key that gave it, 0 if it was there.

    Keys are tried from the first to the last; at each level only keys with one value in the table count, so no join
    multiplies rows and a coarser key never overrules a finer one. Blank and written-out missing values are none.
    """
    out = rows.withColumn(value, filled(F.col(value))).withColumn("match_level", F.when(F.col(value).isNotNull(), 0))
    known = table.where(filled(F.col(value)).isNotNull())
    for n, keys in enumerate(levels, 1):
        single = known.dropna(subset=list(keys)).groupBy(*keys).agg(F.countDistinct(value).alias("_n"), F.min(value).alias("_v")).where("_n = 1").drop("_n")
        out = out.join(single, list(keys), "left").withColumn("match_level", F.coalesce("match_level", F.when(F.col("_v").isNotNull(), n))).withColumn(value, F.coalesce(value, "_v")).drop("_v")
    return out


def match_rate(rows: DataFrame, group: str) -> DataFrame:
    """(group, rows, with_speaker, matched, pct): ids over rows that have a speaker."""
    g = rows.groupBy(group).agg(F.count("*").alias("n_rows"), F.count_if(F.trim("speaker_raw") != "").alias("with_speaker"), F.count_if((F.trim("speaker_raw") != "") & filled(F.col("id_dep")).isNotNull()).alias("matched"))
    return g.withColumn("pct", F.round(F.col("matched") * 100.0 / F.nullif("with_speaker", F.lit(0)), 2))


def match_present(rows: DataFrame, present: DataFrame, least: int = 4) -> DataFrame:
    """(id_int, id_dep): unlinked turns whose letters are the name, or end in it, of exactly one person present in the sitting.

    ``present``: id_session, id_dep, name. Names of fewer than ``least`` letters aren't used. Names and turns meet by sitting
    and by the letters themselves: every ending of a turn's letters is looked up among those of the sitting.
    """
    who = present.select("id_session", "id_dep", skeleton(F.col("name")).alias("k")).where(F.length("k") >= least).distinct()
    asked = rows.where(F.col("id_dep").isNull()).select("id_session", "id_int", skeleton(F.col("speaker_raw")).alias("s")).where(F.length("s") >= least)
    endings = F.transform(F.sequence(F.lit(1), F.length("s") - least + 1), lambda k: F.substring(F.col("s"), k, F.length("s")))
    tried = asked.select("id_session", "id_int", F.explode(endings).alias("k"))
    hit = tried.join(who, ["id_session", "k"]).groupBy("id_int").agg(F.countDistinct("id_dep").alias("n"), F.min("id_dep").alias("id_dep"))
    return hit.where("n = 1").drop("n")


def match_names(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(id_int, id_dep): unlinked turns whose letters are exactly the name under which one member of the country sits, on a day in office.

    ``rows``: id_int, country, date, speaker_raw, id_dep. ``register``: typed terms; names are compared by ``skeleton``. A date
    outside every term of the member, or a name that two members in office share, gives nothing.
    """
    names = register.select("country", "id_dep", skeleton(F.col("speaker_name")).alias("k"), "start_date", F.coalesce("end_date", F.lit("2999-12-31").cast("date")).alias("until")).where("k <> '' AND start_date IS NOT NULL").distinct()
    asked = rows.where(F.col("id_dep").isNull() & F.col("date").isNotNull()).select("id_int", "country", "date", skeleton(F.col("speaker_raw")).alias("k")).where("k <> ''")
    hit = asked.join(names, ["country", "k"]).where((F.col("date") >= F.col("start_date")) & (F.col("date") <= F.col("until")))
    return hit.groupBy("id_int").agg(F.countDistinct("id_dep").alias("n"), F.min("id_dep").alias("id_dep")).where("n = 1").drop("n")


def mend_names(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(speaker_raw, mended): typed names in which a blank cuts a surname of the country's register in two, with the blank taken out.

    Two neighbouring words are one if joined they are a surname and neither is one alone. One cut is mended in a name, the
    first. Distinct names are looked at once.
    """
    words = F.filter(F.split(fold(F.col("last_name")), r"[^\p{L}]+"), lambda w: F.length(w) >= 4)
    known = register.select("country", F.explode(words).alias("w")).distinct()
    typed = rows.where(F.col("speaker_raw").isNotNull()).select("country", "speaker_raw").distinct()
    tokens = F.regexp_extract_all("speaker_raw", F.lit(r"\p{L}+"), F.lit(0))
    pairs = typed.withColumn("t", tokens).where(F.size("t") > 1).select("country", "speaker_raw", F.explode(F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda k: F.struct(k.alias("at"), F.get("t", k - 1).alias("a"), F.get("t", k).alias("b")))).alias("p")).select("country", "speaker_raw", "p.*")
    whole = pairs.withColumn("w", fold(F.concat("a", "b"))).join(known, ["country", "w"])
    alone = whole.select("country", "speaker_raw", "at", "a", "b", F.explode(F.array(fold("a"), fold("b"))).alias("w")).join(known, ["country", "w"]).select("country", "speaker_raw", "at").distinct()
    first = whole.join(alone, ["country", "speaker_raw", "at"], "left_anti").groupBy("country", "speaker_raw").agg(F.min(F.struct("at", "a", "b")).alias("m"))
    return first.select("country", "speaker_raw", F.expr("regexp_replace(speaker_raw, concat(m.a, '[ ]+', m.b), concat(m.a, m.b))").alias("mended"))


# --- columns ---
def valid_number(c: Column) -> Column:
    """A session number in its one form: digits without leading zeros, with letters and one hyphen; ``12.0`` is 12; else null."""
    t = F.regexp_replace(F.trim(c), r"\.0+$", "")
    return F.when(t.rlike(r"^\d+$"), F.regexp_replace(t, r"^0+(?=\d)", "")).when(t.rlike(r"^[\p{L}\d]*\d[\p{L}\d]*(?:-[\p{L}\d]+)?$"), F.regexp_replace(F.upper(t), r"^0+(?=\d)", ""))


def valid_day(c: Column, first: str = "1800-01-01", last: str = "2100-12-31") -> Column:
    """An ISO date within bounds, else null."""
    d = F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd")).cast("date"))
    return F.when(d.between(F.lit(first).cast("date"), F.lit(last).cast("date")), d)


def session_type_form(c: Column) -> Column:
    """Session types in lower case, Portuguese and feminine spellings brought together; blanks are null."""
    t = fold(c)
    return F.nullif(F.when(t.startswith("extraordinari"), "extraordinaria").when(t.startswith("ordinari"), "ordinaria").when(t.startswith("especia"), "especial").when(t.rlike("^sole[mn]"), "solemne").otherwise(t), F.lit(""))


def sex_form(c: Column) -> Column:
    """F or M from the writings in use: f, F , Mujer, Mulher; m, H, Hombre, Homem; else null."""
    t = fold(c)
    return F.when(t.isin("f", "mujer", "mulher", "femenino", "feminino"), "F").when(t.isin("m", "h", "hombre", "homem", "masculino"), "M")


class EmptyRegister(ValueError):
    """Ids are there, but no row has any of the columns that come from the register."""


def standardize(raw: DataFrame, aliases: dict[str, list[str]], country: str) -> DataFrame:
    """Any chamber's table in the canonical columns: the fullest alias of each, typed and checked, names in capitals.

    Numbers and dates that fail their check become null; a missing legislature is taken from the nearest dated sitting;
    rows keep the order of sitting and place in ``new_order``. A table with ids but without party, district and name in any
    row is refused, since then the join with the register failed.
    """
    named = resolve_aliases(raw, aliases)
    col = lambda c: F.col(c) if c in named.columns else F.lit(None).cast("string")
    forms = {
        "session_number": valid_number(col("session_number").cast("string")), "date": valid_day(col("date").cast("string")), "session_type": session_type_form(col("session_type").cast("string")), "sex": sex_form(col("sex").cast("string")),
        "speaker_name": F.upper(filled(col("speaker_name"))), "intervention_order": col("intervention_order").try_cast("int"), "dm_speech": col("dm_speech").try_cast("tinyint"),
    }
    out = named.select(F.lit(country).alias("country"), *[forms.get(c, filled(col(c)) if c != "text" else col(c)).alias(c) for c in CANONICAL])
    facts = out.agg(F.count("id_dep").alias("ids"), *[F.count(c).alias(c) for c in ("party", "district", "speaker_name")]).first()
    if facts["ids"] and not (facts["party"] or facts["district"] or facts["speaker_name"]):
        raise EmptyRegister("ids without any party, district or name")
    sittings = out.groupBy("id_session").agg(F.min("country").alias("country"), F.min("date").alias("date"), F.min("legislature").alias("known"))
    filled_in = impute_by_date(sittings.where(F.col("id_session").isNotNull()), "known").select("id_session", "imputed")
    joined = out.join(filled_in, "id_session", "left").withColumn("legislature", F.coalesce("legislature", "imputed")).drop("imputed")
    order = F.row_number().over(Window.partitionBy("id_session").orderBy(F.col("intervention_order").asc_nulls_last(), "id_int"))
    return joined.withColumn("new_order", order).select("country", *CANONICAL, "new_order")


def legislatures_of_notes(register: DataFrame, key: str = "legislaturas") -> DataFrame:
    """(id_dep, legislature): one row for each legislature a note lists: ``legislaturas: X, XI y XII`` or ``56 | 57``."""
    listed = F.regexp_extract("notes", rf"(?iu){key}?\s*:\s*([IVXLCDM\d][IVXLCDM\d\s,;|y]*)", 1)
    each = F.split(listed, r"\s*(?:[,;|]|\sy\s)\s*")
    return register.where(F.col("notes").isNotNull()).select("id_dep", F.explode(each).alias("legislature")).select("id_dep", F.trim("legislature").alias("legislature")).where(F.col("legislature") != "").distinct()


def name_parts(name: Column) -> Column:
    """struct(given, surnames) of a full name: "Surname, Given", else by position.

    Without a comma a name of two words is one of each; of three, one given name; of four or more, the last two words are
    surnames. Particles stay with the word behind them. Blank names give nulls.
    """
    clean = F.trim(F.regexp_replace(name, r"\s+", " "))
    tied = F.regexp_replace(clean, r"(?iu)(?<=^|\s)(de) (?=(?:la|los|las) )", "$1\u0001")
    glued = F.split(F.regexp_replace(tied, "(?iu)(?<=^|\\s)(de\u0001(?:la|los|las)|de|del|da|do|dos|das|la|van|von) (?=\\S)", "$1\u0001"), " ")
    cut = F.when(F.size(glued) >= 4, F.size(glued) - 2).otherwise(F.least(F.lit(1), F.size(glued)))
    comma = clean.contains(",")
    given = F.when(comma, F.trim(F.regexp_extract(clean, r"^[^,]*,(.*)$", 1))).otherwise(F.array_join(F.slice(glued, F.lit(1), cut), " "))
    last = F.when(comma, F.trim(F.regexp_extract(clean, r"^([^,]*),", 1))).otherwise(F.array_join(F.slice(glued, cut + 1, F.greatest(F.size(glued) - cut, F.lit(0))), " "))
    plain = lambda c: F.nullif(F.translate(c, "\u0001", " "), F.lit(""))
    return F.struct(plain(given).alias("given"), plain(last).alias("surnames"))


# --- the chair ---
DECLARED = r"(?iu)(?:asume|ocupa|assume|ocupou)\s+(?:interinamente\s+)?(?:la|a)\s+presid[eê]nci?a?\w*\s+(?:(?:el|la|o|a)\s+)?(?:(?:se[ñn]ora?|senhora?|sra?\.?|dip\w*\.?|dep\w*\.?)\s+)?(\p{L}[\p{L}'’.-]*(?:\s+\p{L}[\p{L}'’-]*){0,4})"


def declared_chairs(rows: DataFrame) -> DataFrame:
    """(id_int, id_session, declared): turns whose text says who takes the chair ("asume la presidencia el señor X")."""
    return rows.select("id_int", "id_session", F.nullif(F.trim(F.regexp_extract("text", DECLARED, 1)), F.lit("")).alias("declared")).where("declared IS NOT NULL")


def presidency(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(id_int, id_session, chair, chair_id): who is in the chair at each turn.

    Known from the name behind the office ("PRESIDENTE (X)") or a declaration, and carried on through the sitting. A name
    that is no member's, or several members', closes the stretch: the turns behind it have the name but no id.
    """
    typed = F.when(is_chair(F.col("speaker_raw")), F.nullif(F.trim(F.regexp_extract("speaker_raw", r"\(([^)]{3,})\)", 1)), F.lit("")))
    stated = F.nullif(F.trim(F.regexp_extract(F.coalesce("text", F.lit("")), DECLARED, 1)), F.lit(""))
    key = lambda c: F.array_join(F.array_sort(F.filter(F.split(fold(c), r"[^\p{L}]+"), lambda t: F.length(t) > 2)), " ")
    people = register.where(F.col("speaker_name").isNotNull()).select("country", "id_dep", F.explode(F.array(key(F.col("speaker_name")), key(F.col("last_name")))).alias("k")).where("k <> ''").distinct()
    single = people.groupBy("country", "k").agg(F.countDistinct("id_dep").alias("n"), F.min("id_dep").alias("chair_id")).where("n = 1").drop("n")
    named = rows.select("id_int", "id_session", "country", F.coalesce(typed, stated).alias("named")).withColumn("k", key(F.col("named")))
    known = named.join(single, ["country", "k"], "left")
    w = Window.partitionBy("id_session").orderBy("id_int")
    held = F.last(F.when(F.col("named").isNotNull(), F.struct("named", "chair_id")), True).over(w)
    return known.withColumn("h", held).where(F.col("h").isNotNull()).select("id_int", "id_session", F.upper("h.named").alias("chair"), F.col("h.chair_id").alias("chair_id"))


def without_chair(rows: DataFrame) -> DataFrame:
    """(id_session, turns): sittings in which nobody is named in the chair."""
    g = rows.groupBy("id_session").agg(F.count("*").alias("turns"), F.count_if(is_chair(F.col("speaker_raw"))).alias("c"))
    return g.where("c = 0").drop("c")


# --- order ---
def explained_gaps(gaps: DataFrame, removed: DataFrame) -> DataFrame:
    """Order gaps with ``explained``: how many of their missing numbers are those of removed rows (id_session, intervention_order), and ``orphan``: the rest."""
    j = gaps.join(removed.select(F.col("id_session").alias("_s"), F.col("intervention_order").alias("_o")).distinct(), (F.col("id_session") == F.col("_s")) & (F.col("_o") > F.col("after")) & (F.col("_o") < F.col("before")), "left")
    g = j.groupBy("id_session", "after", "before", "missing").agg(F.count("_o").alias("explained"))
    return g.withColumn("orphan", F.col("missing") - F.col("explained"))


def number_tail(sessions: DataFrame) -> DataFrame:
    """Sittings behind the last numbered one of their legislature go on counting from it; ``number`` in, ``imputed`` out."""
    w = Window.partitionBy("country", "legislature").orderBy("id_session")
    n = sessions.withColumn("_last", F.last("number", True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_next", F.first("number", True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    steps = F.row_number().over(w) - F.max(F.when(F.col("number").isNotNull(), F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    n = n.withColumn("_rn", F.row_number().over(w))
    return n.withColumn("_steps", steps).withColumn("imputed", F.coalesce("number", F.when(F.col("_next").isNull(), F.col("_last") + F.col("_steps")))).drop("_last", "_next", "_rn", "_steps")


def regroup_days(rows: DataFrame) -> DataFrame:
    """(id_int, day_order): turns of all sittings of a country's day in one numbering, sittings in the order of their ids."""
    w = Window.partitionBy("country", "date").orderBy("id_session", F.col("intervention_order").asc_nulls_last(), "id_int")
    return rows.where(F.col("date").isNotNull()).withColumn("day_order", F.row_number().over(w)).select("id_int", "day_order")


def mode_per_key(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): the commonest value of each key; ties to the first in order."""
    n = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), value)).alias("b")).select(key, F.col(f"b.{value}").alias(value), F.col("b.n").alias("n"))


def linkage(rows: DataFrame, guest: Column, nobody: Column) -> DataFrame:
    """Per country: turns of speech by words, those linked, and the share among what can be linked at all.

    Weighted by words, so that a lost long speech counts more than a lost interjection; ``guest`` and ``nobody`` mark
    unlinked turns of people without a seat and of no person.
    """
    speech, linked = F.col("dm_speech") == 1, F.col("id_dep").isNotNull()
    w = lambda c: F.coalesce(F.sum(F.when(c, F.col("n_words"))), F.lit(0)).cast("bigint")
    g = rows.groupBy("country").agg(w(speech).alias("words"), w(speech & linked).alias("linked_words"), w(speech & ~linked & guest).alias("guest_words"), w(speech & ~linked & ~guest & nobody).alias("nobody_words"))
    base = F.col("words") - F.col("guest_words") - F.col("nobody_words")
    return g.withColumn("pct", F.round(F.col("linked_words") * 100.0 / F.nullif(base, F.lit(0)), 2))


def edge_losses(rows: DataFrame, least: int = 3) -> DataFrame:
    """(kind, n): what the first words of lines are: a word of the corpus, a part of one split from the line before, or cut off.

    A word counts if the corpus has it ``least`` times away from line edges. A first word that is none is ``split`` if it
    makes one with the last word of the line before, else ``cut``.
    """
    lines = rows.where(F.col("text").isNotNull()).select("id_int", F.posexplode(F.split(F.lower("text"), "\n")).alias("at", "line"))
    tokens = lines.withColumn("w", F.regexp_extract_all("line", F.lit(r"\p{L}+"), F.lit(0))).where(F.size("w") > 0)
    inner = tokens.select(F.explode(F.slice("w", F.lit(2), F.greatest(F.size("w") - 2, F.lit(0)))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word")
    before = F.lag(F.element_at("w", -1)).over(Window.partitionBy("id_int").orderBy("at"))
    first = tokens.withColumn("last", before).where(F.col("last").isNotNull()).select(F.element_at("w", 1).alias("word"), F.concat("last", F.element_at("w", 1)).alias("joined"))
    known = inner.withColumn("is_word", F.lit(True))
    j = first.join(known, "word", "left").join(known.select(F.col("word").alias("joined"), F.col("is_word").alias("is_joined")), "joined", "left")
    kind = F.when(F.col("is_word").isNotNull(), "word").when(F.col("is_joined").isNotNull(), "split").otherwise("cut")
    return j.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
