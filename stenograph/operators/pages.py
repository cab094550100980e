"""Printed pages as text: furniture, cut words, lines and paragraphs. Columns where one text suffices, else joins."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Marks at which a word may be cut at a line's end.
CUT = "[-‐¬­]"


def masked(line: Column) -> Column:
    """A line's form: trimmed, lower case, runs of digits as one 9."""
    return F.regexp_replace(F.lower(F.trim(line)), r"\d+", "9")


# --- furniture ---
def paged_furniture(pages: DataFrame, edge: int = 3, recurrence: float = 0.3, least_pages: int = 4, most: float = 0.35) -> DataFrame:
    """(id, page, at, line): lines at the edges of pages that recur, digits aside, on many pages of their document.

    ``pages``: id, page, text. A line counts if it is among the first or last ``edge`` lines with text and its form stands
    on ``recurrence`` of the document's pages, of which there are ``least_pages``. Nothing is taken from a document
    that would lose more than ``most`` of its lines.
    """
    lines = pages.where(F.col("text").isNotNull()).select("id", "page", F.posexplode(F.split("text", "\n")).alias("at", "line")).where(F.trim("line") != "")
    w = Window.partitionBy("id", "page")
    placed = lines.withColumn("top", F.row_number().over(w.orderBy("at"))).withColumn("bottom", F.row_number().over(w.orderBy(F.desc("at")))).withColumn("form", masked(F.col("line")))
    size = lines.groupBy("id").agg(F.countDistinct("page").alias("pages"), F.count("*").alias("lines"))
    edges = placed.where((F.col("top") <= edge) | (F.col("bottom") <= edge))
    often = edges.groupBy("id", "form").agg(F.countDistinct("page").alias("n")).join(size, "id").where((F.col("pages") >= least_pages) & (F.col("n") >= F.col("pages") * recurrence))
    found = edges.join(often.select("id", "form", "lines"), ["id", "form"])
    few = found.groupBy("id").agg(F.count("*").alias("c"), F.max("lines").alias("l")).where(F.col("c") <= F.col("l") * most).select("id")
    return found.join(few, "id", "left_semi").select("id", "page", "at", F.trim("line").alias("line"))


def unpaged_furniture(texts: DataFrame, least: int = 3, longest: int = 80) -> DataFrame:
    """(id, form, n): short lines that recur in one text, digits aside, and aren't prose (no full stop at their end)."""
    lines = texts.where(F.col("text").isNotNull()).select("id", F.explode(F.split("text", "\n")).alias("line"))
    short = lines.where((F.length(F.trim("line")) >= 3) & (F.length(F.trim("line")) <= longest) & ~F.trim("line").rlike(r"[.!?…;,]$"))
    return short.groupBy("id", masked(F.col("line")).alias("form")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def folio_lines(rows: DataFrame, days: int = 3) -> DataFrame:
    """(id_int, at, kind): lines of a turn that are a page's folio, and lines with the sitting's date beside one.

    ``folio``: digits alone, with dashes or a page word. ``dated``: a short line with a date within ``days`` of the turn's,
    which needs company: a folio or another such line directly above or below it.
    """
    lines = rows.where(F.col("text").isNotNull()).select("id_int", "date", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    folio = F.trim("line").rlike(r"(?i)^\W*(?:p[áa]g(?:ina)?\.?\s*)?\d{1,5}\W*$")
    printed = F.try_to_timestamp(F.regexp_extract("line", r"(\d{2}/\d{2}/\d{4})", 1), F.lit("dd/MM/yyyy")).cast("date")
    near = F.coalesce((F.abs(F.datediff(printed, F.col("date"))) <= days) & (F.length(F.trim("line")) <= 70), F.lit(False))
    w = Window.partitionBy("id_int").orderBy("at")
    marked = lines.select("id_int", "at", folio.alias("folio"), near.alias("near"))
    mark = F.col("folio") | F.col("near")
    company = F.coalesce(F.lag(mark).over(w), F.lit(False)) | F.coalesce(F.lead(mark).over(w), F.lit(False))
    return marked.withColumn("company", company).where(F.col("folio") | (F.col("near") & F.col("company"))).select("id_int", "at", F.when(F.col("folio"), "folio").otherwise("dated").alias("kind"))


def strip_patterns(text: Column, prefixes: Iterable[str] = (), lines: Iterable[str] = (), anywhere: Iterable[str] = ()) -> Column:
    """A text without a chamber's own furniture: patterns at its start, whole lines, and anything that matches."""
    for p in prefixes:
        text = F.regexp_replace(text, rf"\A(?:{p})", "")
    for p in lines:
        text = F.regexp_replace(text, rf"(?m)^[ \t]*(?:{p})[ \t]*$\n?", "")
    for p in anywhere:
        text = F.regexp_replace(text, p, "")
    return text


# --- words cut at line ends ---
_CUT_WORD = re.compile(r"([^\W\d_]+)[-‐¬­][ \t]*\n[ \t]*([^\W\d_]+)")


def cut_words(texts: DataFrame, most: int = 30) -> DataFrame:
    """(head, tail, n, joined_n, hyphened_n, joins): the words cut at line ends and what the corpus says of them.

    They belong together if the joined word is as frequent as the hyphenated one, and frequent at all: its uses must reach
    a share of its parts' own, ``most`` uses being enough for any.
    """
    body = texts.where(F.col("text").isNotNull()).select(F.lower("text").alias("t"))
    halves = rf"(\p{{L}}+){CUT}[ \t]*\n[ \t]*(\p{{L}}+)"
    cuts = body.select(F.explode(F.regexp_extract_all("t", F.lit(halves), F.lit(0))).alias("c"))
    cuts = cuts.select(F.regexp_extract("c", halves, 1).alias("head"), F.regexp_extract("c", halves, 2).alias("tail")).groupBy("head", "tail").agg(F.count("*").alias("n"))
    words = body.select(F.explode(F.regexp_extract_all(F.regexp_replace("t", halves, " "), F.lit(r"\p{L}+(?:-\p{L}+)*"), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("k"))
    of = lambda c, name: words.select(F.col("w").alias(c), F.col("k").alias(name))
    j = cuts.withColumn("joined", F.concat("head", "tail")).withColumn("hyphened", F.concat_ws("-", "head", "tail"))
    j = j.join(of("joined", "joined_n"), "joined", "left").join(of("hyphened", "hyphened_n"), "hyphened", "left").join(of("head", "head_n"), "head", "left").na.fill(0, ["joined_n", "hyphened_n", "head_n"])
    bar = F.least(F.lit(most), F.greatest(F.lit(1), F.floor(F.col("head_n") / 10)))
    return j.select("head", "tail", "n", "joined_n", "hyphened_n", ((F.col("joined_n") >= F.col("hyphened_n")) & (F.col("joined_n") >= bar)).alias("joins"))


def join_cut_words(texts: DataFrame, decisions: DataFrame) -> DataFrame:
    """``texts`` (id, text) with the words joined that ``cut_words`` says belong together; others keep their hyphen, without the break."""
    cuts = texts.where(F.col("text").isNotNull()).select("id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"\p{{L}}+{CUT}[ \t]*\n[ \t]*\p{{L}}+"), F.lit(0)))).alias("c"))
    halves = cuts.select("id", F.regexp_extract("c", r"^(\p{L}+)", 1).alias("head"), F.regexp_extract("c", r"(\p{L}+)$", 1).alias("tail"))
    told = halves.join(decisions.where("joins").select("head", "tail"), ["head", "tail"]).groupBy("id").agg(F.collect_set(F.concat_ws(" ", "head", "tail")).alias("_joins"))  # a text's own cuts

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, joins in zip(batch.column("text").to_pylist(), batch.column("_joins").to_pylist()):
                known = set(joins or ())
                out.append(None if text is None else _CUT_WORD.sub(lambda m: m[1] + ("" if f"{m[1].lower()} {m[2].lower()}" in known else "-") + m[2], text))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=["id", "text"])

    return texts.select("id", "text").join(told, "id", "left").mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, text string")


# --- lines and paragraphs ---
def trim_leaders(text: Column) -> Column:
    """Without the rows of dots that lead to a page number at a line's end."""
    return F.regexp_replace(text, r"(?m)[ \t]*(?:\.[ \t]*){4,}\d*[ \t]*$", "")


def drop_junk(text: Column, least: float = 0.4) -> Column:
    """Without lines of four characters or more of which fewer than ``least`` are letters or digits."""
    good = lambda x: (F.length(F.trim(x)) < 4) | (F.length(F.regexp_replace(x, r"[^\p{L}\p{N}]", "")) >= F.length(F.trim(x)) * least)
    return F.array_join(F.filter(F.split(text, "\n"), good), "\n")


def reflow(text: Column) -> Column:
    """Lines joined where the sentence goes on: the first ends in no stop and the next begins in lower case."""
    return F.regexp_replace(F.regexp_replace(text, r"([^.!?…:\n])[ \t]*\n[ \t]*(\p{Ll})", "$1 $2"), r"([^.!?…:\n])[ \t]*\n[ \t]*(\p{Ll})", "$1 $2")


def join_titles(text: Column) -> Column:
    """Titles in capitals that run over two lines, brought to one; lines with digits (rolls, tables) stay."""
    return F.regexp_replace(text, r"(?m)^([\p{Lu} ]{6,})\n([\p{Lu} ]{3,})$", "$1 $2")


def box_width(text: Column) -> Column:
    """The width nine tenths of a text's lines keep within, in characters; null without lines."""
    widths = F.array_sort(F.transform(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), lambda x: F.length(x)))
    return F.get(widths, F.ceil(F.size(widths) * 0.9).cast("int") - 1)


def commentary(text: Column) -> Column:
    """struct(text, notes): a turn without the remarks in round brackets, and these in order."""
    notes = F.regexp_extract_all(text, F.lit(r"\(([^()]*)\)"), F.lit(1))
    return F.struct(F.trim(F.regexp_replace(F.regexp_replace(text, r"\([^()]*\)", ""), r"[ \t]{2,}", " ")).alias("text"), F.transform(notes, lambda n: F.trim(n)).alias("notes"))


def front_matter(documents: DataFrame, rows: DataFrame, anchor: int = 220) -> DataFrame:
    """(id, id_session, chars): how much of a document stands before its sitting's first turn.

    ``documents``: id, date, text. They meet by date; a sitting's first turn is looked for by its first ``anchor``
    letters and digits, case and marks aside (the anchor places the turn; whole texts are read). ``chars`` counts letters and digits.
    """
    plain = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    first = rows.where(F.col("date").isNotNull() & (F.length(plain(F.col("text"))) >= 20)).groupBy("id_session", "date").agg(F.min_by("text", "id_int").alias("first"))
    j = documents.where(F.col("text").isNotNull()).select("id", "date", plain(F.col("text")).alias("whole")).join(first.select("id_session", "date", F.left(plain(F.col("first")), F.lit(anchor)).alias("head")), "date")
    at = F.expr("instr(whole, head)")
    return j.select("id", "id_session", (at - 1).alias("chars")).where("chars > 0")


def repetitions(rows: DataFrame, least_chars: int = 80) -> DataFrame:
    """(id_session, texts, extra): long texts that stand more than once in a sitting, and the rows beyond the first."""
    from .sequence import normal_text

    k = rows.where(F.length("text") >= least_chars).groupBy("id_session", F.md5(normal_text(F.col("text"))).alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    return k.groupBy("id_session").agg(F.count("*").alias("texts"), F.sum(F.col("n") - 1).alias("extra"))
