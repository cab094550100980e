"""From prepared text to rows: tagged blocks, scored markers, embedded labels, session headers, roll calls."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import CARDINALS, any_date
from ..functions.text import fold

# --- tagged blocks ---
_INLINE = re.compile(r'<int speaker="([^"]*)">(.*?)</int>', re.DOTALL)
_BARE = re.compile(r"<int>([^<]*)</int>")
_PAGE_MARK = re.compile(r"\[\[p(?:ag)?[:.]?\s*\d+\]\]", re.IGNORECASE)


def tagged_blocks(texts: DataFrame, form: str = "auto", least_chars: int = 10, gaps: bool = False) -> DataFrame:
    """(id, place, speaker_raw, party_raw, text): the turns of texts whose speakers are tagged.

    ``texts``: id, text. ``inline``: ``<int speaker="NAME">turn</int>``. ``bare``: ``<int>NAME</int>`` before the turn,
    or ``<int>NAME (PARTY): turn</int>``. ``auto`` takes the form that comes first. Turns of fewer than ``least_chars``
    characters are left out; with ``gaps`` the text between inline tags (more than 20 characters) comes as rows
    without a speaker. Inline names stay as they are; bare ones that ``speaker_parts`` refuses open no turn. Null texts give no row.
    """

    def blocks(text: str) -> Iterator[tuple[str, str, bool]]:
        inline, bare = _INLINE.search(text), _BARE.search(text)
        kind = form if form != "auto" else "bare" if bare and (not inline or bare.start() < inline.start()) else "inline"
        if kind == "inline":
            at = 0
            for m in _INLINE.finditer(text):
                if gaps:
                    yield "", text[at : m.start()], False
                yield m[1], m[2], False
                at = m.end()
            if gaps:
                yield "", text[at:], False
            return
        tags = list(_BARE.finditer(text))
        for k, m in enumerate(tags):
            name, said = _split_tag(m[1])
            rest = text[m.end() : tags[k + 1].start() if k + 1 < len(tags) else len(text)].strip()
            yield name, f"{said} {rest}", True

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for identity, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                place = 0
                for speaker, said, bare in blocks(text or ""):
                    clean = _PAGE_MARK.sub("", said).strip()
                    if len(clean) >= (least_chars if speaker else max(least_chars, 21)):
                        place += 1
                        for c, v in zip(out, (identity, place, speaker.strip(), bare, clean)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.string()))], names=["id", "place", "raw", "bare", "text"])

    cut = texts.select(F.col("id").cast("string").alias("id"), "text").mapInArrow(run, "id string, place int, raw string, bare boolean, text string")
    parts = F.when(F.col("bare"), speaker_parts(F.col("raw"))).otherwise(F.struct(F.col("raw").alias("speaker"), F.lit(None).cast("string").alias("party")))
    named = cut.withColumn("_p", parts).where(F.col("_p.speaker").isNotNull())
    number = F.row_number().over(Window.partitionBy("id").orderBy("place"))
    return named.select("id", number.cast("int").alias("place"), F.coalesce("_p.speaker", F.lit("")).alias("speaker_raw"), F.coalesce("_p.party", F.lit("")).alias("party_raw"), "text")


_TAG_END = re.compile(r"^(.{2,}?\)?)\s*(?::\s*[.\-–—]*|\s[—–-]+)\s+(.*)$", re.DOTALL)


def _split_tag(content: str) -> tuple[str, str]:
    m = _TAG_END.match(content.strip())
    return (m[1], m[2]) if m else (content.strip(), "")


def speaker_parts(raw: Column) -> Column:
    """struct(speaker, party) of a typed speaker; both null if it is no name.

    A party in brackets at the end is taken off, glued names are parted at their capitals, end marks go. No name: fewer
    than three characters, a phrase in lower case, capitals of six characters or fewer (a party), or a change of
    speaker within ("X (PS) — Muito bem! O Sr. Y").
    """
    letter = r"\p{Lu}"
    s = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^ª\s+", ""), rf"^[ao]\s+(?={letter})", "")
    party = F.nullif(F.trim(F.regexp_extract(s, r"\(([^()]+)\)[)\s]*[.:,;–—-]*\s*$", 1)), F.lit(""))
    bare = F.trim(F.regexp_replace(s, r"\s*\([^()]*\)[)\s]*[.:,;–—-]*\s*$", ""))
    parted = F.regexp_replace(bare, rf"(?<=\p{{Ll}})(?={letter})", " ")
    name = F.trim(F.regexp_replace(parted, "[\\s\\-–—!;:.,'\"]+$", ""))
    code = (F.length(s) <= 6) & s.rlike(r"\p{L}") & ~s.rlike(r"\p{Ll}")
    change = s.rlike(r"[!?.…]\s+(?:O|A|El|La)\s+(?:Sr|Se[ñn])")
    ok = (F.length(s) >= 3) & ~s.rlike(r"^\p{Ll}") & ~code & ~change & (F.length(name) >= 3)
    return F.struct(F.when(ok, name).alias("speaker"), F.when(ok, party).alias("party"))


# --- scored markers ---
STRICT = r"^(?:El|La|O|A|EL|LA)\s+(?:[Ss]e[ñn]ora?|[Ss]enhora?|SE[ÑN]ORA?|SENHORA?|[Ss]ra?\.?|SRA?\.?)\s+([\p{Lu}][\p{Lu}\s.'’-]+?)(?:\s*\([^)]*\))?\s*(?::|\.\s*[-–—]+)"
LOOSE = r"^((?:(?:\p{Lu}\.|\p{Lu}[\p{L}'’]*(?:[.-][\p{L}'’]+)*)\s*){1,6})(\([^)]*\))?"


def marker_scores(lines: DataFrame, surnames: DataFrame | None = None, tag_from: float = 0.6, unsure_from: float = 0.4) -> DataFrame:
    """(id, line, name, kind, score): lines that may open a turn. ``lines``: id, line (its number), text.

    ``strict`` markers have a title, a name in capitals and an end mark. Any other line that begins with capitalised words
    is scored: end mark .55 (dot and dash), .40 (dash, dot or colon) or .15 (none); speech behind it +.20, a vocative
    or running sentence -.30; brackets behind the name +.10; one to four words of 2 to 20 letters +.10, else -.20; a
    word of ``surnames`` (fold) +.30. From ``tag_from`` it is ``likely``, from ``unsure_from`` ``unsure``.
    """
    text = F.trim("text")
    name = F.trim(F.regexp_extract(text, LOOSE, 1))
    rest = F.substring(text, F.length(F.regexp_extract(text, LOOSE, 0)) + 1, F.length(text))
    ends = F.when(rest.rlike(r"^\s*\.\s*[-–—]"), 0.55).when(rest.rlike(r"^\s*[-–—.:]"), 0.40).otherwise(0.15)
    said = F.when(rest.rlike(r"^\s*,|^\s+\p{Ll}"), -0.30).when(rest.rlike(r"^\s*[.:\-–—]*\s*[¿¡«\"“]?\p{Lu}"), 0.20).otherwise(0.0)
    bracket = F.when(F.regexp_extract(text, LOOSE, 2) != "", 0.10).otherwise(0.0)
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    plain = F.when((F.size(words) <= 4) & F.forall(words, lambda w: (F.length(w) >= 2) & (F.length(w) <= 20)), 0.10).otherwise(-0.20)
    strict = text.rlike(STRICT)
    base = lines.select("id", "line", F.when(strict, F.trim(F.regexp_extract(text, STRICT, 1))).otherwise(name).alias("name"), strict.alias("strict"), (ends + said + bracket + plain).alias("s")).where(F.col("name") != "")
    if surnames is not None:
        known = surnames.select("fold").distinct()
        hit = base.select("id", "line", F.explode(F.split(fold("name"), r"[^\p{L}]+")).alias("fold")).join(known, "fold").select("id", "line", F.lit(0.30).alias("bonus")).distinct()
        base = base.join(hit, ["id", "line"], "left").withColumn("s", F.col("s") + F.coalesce("bonus", F.lit(0.0)))
    score = F.when(F.col("strict"), 1.0).otherwise(F.round(F.least(F.greatest("s", F.lit(0.0)), F.lit(1.0)), 2))
    kind = F.when(F.col("strict"), "strict").when(score >= tag_from, "likely").when(score >= unsure_from, "unsure")
    return base.select("id", "line", "name", kind.alias("kind"), score.alias("score")).where(F.col("kind").isNotNull())


# --- labels inside a turn ---
EMBEDDED = r"(?:El señor|La señora|El Sr\.|La Sra\.|O Sr\.|A Sra\.|O SR\.|A SRA\.|EL SEÑOR|LA SEÑORA|EL SR\.|LA SRA\.) \p{Lu}{2}[\p{Lu} .'’-]*(?: \([^()\n]{1,60}\))?(?: ?:|\.[-–—]+| [-–—]+)"
_SPLIT = "\x1e"


def embedded_turns(rows: DataFrame, marker: str = EMBEDDED) -> DataFrame:
    """(id_int, part, label, text): a turn cut at the labels of other speakers inside it; part 0 is its own speech.

    A label counts behind the end of a sentence or line only. Guards: none within «…» quotations; a turn whose
    labels are nearly all empty (an index or a list of signatures: fewer than 20 characters behind most of them) stays
    whole. Parts without speech are left out.
    """
    open_quote = F.length(F.regexp_replace("text", "[^«]", "")) - F.length(F.regexp_replace("text", "[^»]", ""))
    marked = F.regexp_replace("text", rf"(^|[.!?…»)\]]\s+|\n\s*)({marker})", f"$1{_SPLIT}$2{_SPLIT}")
    pieces = F.split(marked, _SPLIT)
    quoted = lambda p: F.length(F.regexp_replace(p, "[^«]", "")) > F.length(F.regexp_replace(p, "[^»]", ""))
    said = F.filter(F.transform(pieces, lambda p, k: F.when((k > 0) & (k % 2 == 0), F.length(F.trim(p)))), lambda n: n.isNotNull())
    thin = F.size(F.filter(said, lambda n: n < 20)) * 2 > F.size(said)
    whole = (F.size(pieces) < 3) | quoted(F.get(pieces, F.lit(0))) | (thin & (F.size(said) >= 3)) | (open_quote < 0)
    parts = F.when(whole, F.array(F.struct(F.lit(None).cast("string").alias("label"), F.col("text").alias("said")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor(F.size(pieces) / 2).cast("int")), lambda k: F.struct(F.when(k > 0, F.get(pieces, 2 * k - 1)).alias("label"), F.get(pieces, 2 * k).alias("said")))
    )
    cut = rows.where(F.col("text").isNotNull()).select("id_int", F.posexplode(parts).alias("part", "p"))
    return cut.select("id_int", "part", F.trim("p.label").alias("label"), F.trim("p.said").alias("text")).where(F.col("text") != "")


# --- headers of sittings ---
TYPES = {"extraordin": "extraordinaria", "especial": "especial", "solemne": "solemne", "solene": "solemne", "constitu": "constitutiva", "ordin": "ordinaria"}


def session_header(texts: DataFrame, head: int = 30, tail: int = 10, years: tuple[int, int] = (1800, 2100), periods: DataFrame | None = None) -> DataFrame:
    """(id, date, date_source, date_mismatch, session_number, session_type, president, legislature, missing).

    Looked for in the first ``head`` and last ``tail`` lines of each text. The date in the text counts, the first one within
    ``years``; that of the id (2014-05-03 or 20140503) is taken only without one (``id``) and else compared. A number may
    be written out. ``periods``: since, until (dates), name; the text's own legislature counts without one that covers
    the date. ``missing`` lists what wasn't found. ``texts``: id, text.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    window = F.array_join(F.concat(F.slice(lines, 1, head), F.slice(lines, F.greatest(F.size(lines) - tail + 1, F.lit(head + 1)), tail)), "\n")
    at = texts.select(F.col("id").cast("string").alias("id"), window.alias("w"))
    dated = at.withColumn("found", F.get(F.filter(any_date(F.col("w")), lambda d: F.year(d).between(*years)), F.lit(0)))
    compact = F.regexp_extract("id", r"(\d{4})-?(\d{2})-?(\d{2})", 0)
    dated = dated.withColumn("from_id", F.try_to_timestamp(F.regexp_replace(compact, "-", ""), F.lit("yyyyMMdd")).cast("date"))
    raw = F.regexp_extract("w", r"(?iu)(?:sesi[óo]n|sess[ãa]o|acta|reuni[óo]n|reuni[ãa]o|bolet[íi]n)\s+(?:[\p{L}]+\s+){0,2}?(?:n[úu]m(?:ero)?\.?|n\.?[º°o]\.?|no\.)\s*([\p{L}\d][\p{L}\d -]{0,40}?)\s*(?:[.,;:\n(]|$)", 1)
    number = F.when(raw.rlike(r"^\d[\w-]{0,23}$"), F.regexp_replace(raw, r"^0+(?=\d)", ""))
    kind = F.coalesce(*[F.when(F.col("w").rlike(rf"(?iu)(?<![\p{{L}}]){k}"), F.lit(v)) for k, v in TYPES.items()])
    chair = F.nullif(F.trim(F.regexp_extract("w", r"(?u)(?:[Pp]residente?a?|PRESIDENTE?A?)\s*:\s*(?:Ex\.?m[ao]\.?\s+)?(?:(?:Sr|Sra|Dr|Dra|D)\.?ª?\s+)*(\p{Lu}[^\n|,;]{3,}?)(?=\s+(?:Secret|Vogai|Deput)|[|,;\n]|$)", 1)), F.lit(""))
    named = F.nullif(F.trim(F.regexp_extract("w", r"(?iu)([\p{L}\d]+ª?)\s+legislatura|legislatura\s+([\p{L}\d]+)", 1)), F.lit(""))
    out = dated.select(
        "id", F.coalesce("found", "from_id").alias("date"), F.when(F.col("found").isNotNull(), "text").when(F.col("from_id").isNotNull(), "id").otherwise("missing").alias("date_source"),
        F.coalesce(F.col("found") != F.col("from_id"), F.lit(False)).alias("date_mismatch"), F.coalesce(number, _spelled(raw)).alias("session_number"), kind.alias("session_type"), chair.alias("president"), named.alias("legislature"),
    )
    if periods is not None:
        covering = out.select("id", "date").join(periods, (F.col("date") >= F.col("since")) & (F.col("date") <= F.coalesce("until", F.lit("9999-12-31").cast("date")))).groupBy("id").agg(F.min_by("name", "since").alias("period"))
        out = out.join(covering, "id", "left").withColumn("legislature", F.coalesce("period", "legislature")).drop("period")
    lacks = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("session_number", "session_type", "president", "legislature")]
    missing = F.filter(F.array(F.when(F.col("date_source") != "text", F.lit("date")), *lacks), lambda x: x.isNotNull())
    return out.withColumn("missing", F.array_join(missing, ","))


def _spelled(raw: Column) -> Column:
    """A cardinal in words as digits; null if a word is none."""
    value = F.create_map(*[F.lit(x) for kv in CARDINALS.items() for x in kv])
    words = F.filter(F.split(F.lower(F.trim(raw)), r"[\s-]+"), lambda w: (w != "") & (w != "y"))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("part"))
    thousand = lambda s, w: F.struct((s["total"] + F.greatest(s["part"], F.lit(1)) * 1000).alias("total"), F.lit(0).alias("part"))
    step = lambda s, w: F.when(w == "mil", thousand(s, w)).otherwise(F.struct(s["total"].alias("total"), (s["part"] + F.try_element_at(value, w)).alias("part")))
    n = F.aggregate(words, start, step, lambda s: s["total"] + s["part"])
    return F.when((F.size(words) > 0) & F.forall(words, lambda w: F.map_contains_key(value, w)), n.cast("string"))


# --- roll calls ---
VOTES = r"([\p{Lu}][\p{L}'’-]*(?:[ ][\p{L}'’-]+)*), ([\p{L} ]+): (?:(sí|sim|si)|(não|no)|(abstenci[óo]n|abstenção))(?![\p{L}])"


def roll_calls(rows: DataFrame) -> DataFrame:
    """(id_int, place, name, vote): every "Surname, Given: sí" of a vote list; vote is yes, no or abstained."""
    found = F.regexp_extract_all("text", F.lit(VOTES), F.lit(0))
    each = rows.where(F.col("text").isNotNull()).select("id_int", F.posexplode(found).alias("k", "entry"))
    part = lambda n: F.regexp_extract("entry", VOTES, n)
    vote = F.when(part(3) != "", "yes").when(part(4) != "", "no").otherwise("abstained")
    return each.select("id_int", (F.col("k") + 1).alias("place"), F.concat_ws(", ", part(1), F.trim(part(2))).alias("name"), vote.alias("vote"))


def attendance(rows: DataFrame) -> DataFrame:
    """(id_int, present, absent) as printed below a list: "Presentes 65", "Ausentes: 3", across a line break too."""
    n = lambda word: F.nullif(F.regexp_extract("text", rf"(?iu)(?<!\p{{L}}){word}\s*:?\s*(\d+)", 1), F.lit("")).try_cast("int")
    return rows.select("id_int", n("presentes").alias("present"), n("ausentes").alias("absent")).where("present IS NOT NULL OR absent IS NOT NULL")


def line_shapes(rows: DataFrame, least: int = 3) -> DataFrame:
    """(shape, lines, sessions): line openings reduced to their shape, to discover how a chamber marks its speakers.

    Capitals become A, small letters a, digits 9, runs are closed up; only the first 40 characters of a line's shape count
    as its opening.
    """
    line = rows.where(F.col("text").isNotNull()).select("id_session", F.explode(F.split("text", "\n")).alias("line")).where(F.trim("line") != "")
    shape = F.trim("line")
    for pattern, mark in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lo}\p{Lt}\p{Lm}]+", "a"), (r"\d+", "9"), (r"\s+", " "), (r"(?:[Aa]+ ){2,}", "w ")):
        shape = F.regexp_replace(shape, pattern, mark)
    g = line.select("id_session", F.substring(shape, 1, 40).alias("shape")).groupBy("shape").agg(F.count("*").alias("lines"), F.countDistinct("id_session").alias("sessions"))
    return g.where(F.col("lines") >= least)


def read_documents(rows: DataFrame, least_lines: int = 4) -> DataFrame:
    """(id_int, block, begins, ends, lines): stretches of a turn that are read out: runs of numbered or headed lines.

    A line is documentary if it opens with an article, a number with a dot, or capitals. ``least_lines`` such lines with
    at most one other between them make a block.
    """
    doc = r"(?u)^\s*(?:(?:Art[íi]culo|Artigo|Art\.)\s*\d+|\d+[.)º°-]\s|[\p{Lu}\s]{8,}$)"
    lines = rows.where(F.col("text").isNotNull()).select("id_int", F.posexplode(F.split("text", "\n")).alias("at", "line")).where(F.col("line").rlike(doc))
    w = Window.partitionBy("id_int").orderBy("at")
    grouped = lines.withColumn("new", F.when(F.col("at") - F.lag("at").over(w) <= 2, 0).otherwise(1)).withColumn("block", F.sum("new").over(w))
    g = grouped.groupBy("id_int", "block").agg(F.min("at").alias("begins"), F.max("at").alias("ends"), F.count("*").alias("lines")).where(F.col("lines") >= least_lines)
    return g.select("id_int", F.col("block").cast("int").alias("block"), "begins", "ends", "lines")


# --- narrative records ---
_SAID = r"(?:dijo|manifest[óo]|expres[óo]|señal[óo]|respondi[óo]|afirm[óo]|disse|afirmou|respondeu|declarou)"
_WHO = r"(?:el|la|o|a)\s+(?:señora?|senhora?|diputad[oa]|deputad[oa]|honorable|representante|senador[a]?)"
_NAMED = r"(\p{Lu}\p{L}+(?:\s(?:de\s|del\s|da\s|do\s)?\p{Lu}\p{L}+){0,3})"
NARRATED = rf"{_SAID}\s+{_WHO}\s+{_NAMED}\s*:\s*[«“\"]([^«»“”\"]+)[»”\"]"


def narrated_turns(rows: DataFrame) -> DataFrame:
    """(id_int, place, speaker, text): what a narrative record quotes, with who said it ("dijo el señor X: «…»").

    A quotation counts with the nearest speaker before it; quotations that nobody is named for stay in the narrative.
    """
    each = rows.where(F.col("text").isNotNull()).select("id_int", F.posexplode(F.regexp_extract_all("text", F.lit(NARRATED), F.lit(0))).alias("k", "m"))
    return each.select("id_int", (F.col("k") + 1).alias("place"), F.regexp_extract("m", NARRATED, 1).alias("speaker"), F.trim(F.regexp_extract("m", NARRATED, 2)).alias("text"))


def narrated_name(phrase: Column) -> Column:
    """The name in a narrator's phrase: "el honorable representante Luis Gil Sanz, del partido X" is Luis Gil Sanz."""
    bare = F.regexp_replace(F.trim(phrase), r"(?iu)^(?:(?:el|la|o|a|los|las)\s+)?(?:(?:honorable|señora?|senhora?|diputad[oa]|deputad[oa]|representante|senador[a]?|doctora?|doutora?|don|doña)\s+)*", "")
    return F.nullif(F.trim(F.regexp_extract(bare, r"^(\p{Lu}[\p{L}'’.-]*(?:\s+(?:(?:de|del|da|do|la)\s+)*\p{Lu}[\p{L}'’.-]*)*)", 1)), F.lit(""))


def front_of_sittings(rows: DataFrame, marker: str = EMBEDDED) -> DataFrame:
    """(id_session, id_int, part, text): each sitting's first turn cut where its first label begins: 0 what stands before, 1 the rest.

    What stands before is the sitting's front matter and belongs in a row of order 0. First turns without a label, or that
    begin with one, stay whole as part 1.
    """
    first = rows.where(F.col("text").isNotNull()).groupBy("id_session").agg(F.min_by(F.struct("id_int", "text"), "id_int").alias("f")).select("id_session", "f.*")
    front = F.regexp_extract("text", rf"(?s)^(.*?)(?:\n|[.!?…»)\]]\s)\s*(?:{marker})", 1)
    rest = F.substring(F.col("text"), F.length(front) + 1, F.length("text"))
    parts = F.array(F.struct(F.lit(0).alias("part"), F.trim(front).alias("text")), F.struct(F.lit(1).alias("part"), F.trim(rest).alias("text")))
    return first.select("id_session", "id_int", F.explode(parts).alias("p")).select("id_session", "id_int", "p.part", "p.text").where(F.col("text") != "")


def read_texts(spark, folder: str) -> DataFrame:
    """(id, text) of every text file of a folder, whole; the id is the file's name without its ending."""
    whole = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    return whole.select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]+)?$", 1).alias("id"), F.col("value").alias("text"))
