"""Text operators: search pages, concordances, segments, expressions, candidate names, cleaning, tagging."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.terms import search_pattern
from ..functions.text import fold, fold_str, words


#: Parts of a country's names when they are matched with its persons.
SLICES = 16


def flat(c: Column) -> Column:
    """White space collapsed to single blanks."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def search_page(rows: DataFrame, pattern: str, whole_word: bool = True, limit: int = 20, offset: int = 0, around: int = 220) -> DataFrame:
    """(id_int, date, snippet): a page of the matching turns, newest first.

    The page is cut by id before any text is carried: only its rows are joined with their texts.
    """
    rx = search_pattern(pattern, whole_word)
    hits = rows.where(F.col("text").rlike(rx)).select("id_int", "date")
    page = hits.orderBy(F.col("date").desc_nulls_last(), "id_int").offset(offset).limit(limit)
    at = F.regexp_instr("text", F.lit(rx))
    snippet = flat(F.substring(F.col("text"), F.greatest(at - around, F.lit(1)), F.lit(2 * around)))
    return rows.select("id_int", "text").join(F.broadcast(page), "id_int").select("id_int", "date", snippet.alias("snippet"))  # a page is at most ``limit`` rows


def matches(rows: DataFrame, pattern: str) -> DataFrame:
    """(id_int, n): uses of an accent-tolerant whole-word pattern."""
    rx = search_pattern(pattern, whole_word=True)
    return rows.where(F.col("text").rlike(rx)).select("id_int", F.regexp_count("text", F.lit(rx)).alias("n"))


def concordance(rows: DataFrame, pattern: str, width: int = 40, per_row: int = 3) -> DataFrame:
    """(id_int, place, left, hit, right): keyword in context, at most ``per_row`` hits a turn.

    A hit's place is the length of all text and hits before it, so contexts hold neighbouring hits as well.
    """
    rx = search_pattern(pattern, whole_word=True)
    hits = rows.where(F.col("text").rlike(rx)).select("id_int", flat(F.col("text")).alias("flat")).withColumn("hits", F.regexp_extract_all("flat", F.lit(rx), F.lit(0)))
    length = lambda xs: F.aggregate(xs, F.lit(0), lambda s, x: s + F.length(x))
    placed = hits.withColumn("parts", F.split("flat", rx, -1)).select("id_int", "flat", "parts", "hits", F.posexplode(F.slice("hits", 1, per_row)).alias("k", "hit"))
    before = length(F.slice("parts", F.lit(1), F.col("k") + 1)) + length(F.slice("hits", F.lit(1), F.col("k")))
    cut = placed.select("id_int", (F.col("k") + 1).alias("place"), before.alias("b"), "hit", "flat")
    left = F.substring(F.col("flat"), F.greatest(F.col("b") - width, F.lit(0)) + 1, F.least(F.col("b"), F.lit(width)))
    right = F.substring(F.col("flat"), F.col("b") + F.length("hit") + 1, F.lit(width))
    return cut.select("id_int", "place", left.alias("left"), "hit", right.alias("right"))


def stretches(text: Column | str) -> Column:
    """Word runs that no punctuation, quotation mark, line break or wide blank interrupts: array of arrays."""
    pieces = F.split(fold(text), r"[^\p{L}\p{N}\s'’-]+|\n|\s{6,}")
    runs = F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    return F.filter(runs, lambda r: F.size(r) > 0)


def spoken_only(text: Column | str) -> Column:
    """Text without remarks in brackets (up to 400 characters) and without lines in capitals."""
    c = F.col(text) if isinstance(text, str) else text
    lines = F.split(F.regexp_replace(c, r"\([^()]{0,400}\)", " "), "\n")
    def shout(x: Column) -> Column:
        upper = F.length(F.regexp_replace(x, r"[^\p{Lu}]", ""))
        return (upper >= 8) & (upper > 3 * F.length(F.regexp_replace(x, r"[^\p{Ll}]", "")))

    return F.array_join(F.filter(lines, lambda x: ~shout(x)), "\n")


def segment(tokens: list[str], expressions: set[tuple[str, ...]], longest: int = 7) -> list[tuple[str, ...]]:
    """Fewest units that cover the tokens, single words or listed expressions; ties to longer expressions."""
    best: list[tuple[int, int, tuple]] = [(0, 0, ())]
    for end in range(1, len(tokens) + 1):
        options = []
        for size in range(1, min(longest, end) + 1):
            unit = tuple(tokens[end - size : end])
            if size == 1 or unit in expressions:
                n, square, _ = best[end - size]
                options.append((n + 1, square - size * size, unit))
        best.append(min(options))
    out, at = [], len(tokens)
    while at:
        out.append(best[at][2])
        at -= len(best[at][2])
    return out[::-1]


def candidate_names(rows: DataFrame, least: int = 3, most_lower: float = 0.3) -> DataFrame:
    """(name, turns): capitalised sequences and acronyms used in several turns and seldom in lower case."""
    seq = r"\p{Lu}[\p{L}]+(?:\s+(?:de\s+|del\s+|da\s+|do\s+)?\p{Lu}[\p{L}]+)+|\p{Lu}{3,}"
    found = rows.select("id_int", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(seq), F.lit(0)))).alias("name"))
    df = found.groupBy("name").agg(F.countDistinct("id_int").alias("turns")).where(F.col("turns") >= least)
    tokens = rows.select(F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0))).alias("t"))
    use = tokens.groupBy(F.lower("t").alias("low")).agg(F.count("*").alias("n"), F.count_if(F.lower("t") == F.col("t")).alias("small"))
    head = F.lower(F.regexp_extract("name", r"^\p{L}+", 0))
    return df.withColumn("low", head).join(use, "low", "left").where(F.col("small") < F.col("n") * most_lower).select("name", "turns")


def quote_status(quote: Column, text: Column) -> Column:
    """Whether a quotation stands in a text: verbatim, only when case and accents are ignored, or not."""
    q, t = flat(quote), flat(text)
    return F.when(F.contains(t, q), "verbatim").when(F.contains(flat(fold(text)), flat(fold(quote))), "differs").otherwise("missing")


def sound_spelling(c: Column) -> Column:
    """Spelling with the letters Spanish and Portuguese confuse brought together: h, z, v, ge/gi, ll."""
    f = fold(c)
    for pattern, to in ((r"h", ""), (r"z|ç", "s"), (r"c(?=[ei])", "s"), (r"v", "b"), (r"g(?=[ei])", "j"), (r"ll", "y"), (r"(.)\1", r"$1")):
        f = F.regexp_replace(f, pattern, to)
    return f


def strip_html(c: Column) -> Column:
    """Text of an HTML fragment: scripts, styles and tags removed, the usual entities decoded."""
    t = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<(br|/p|/div|/li|/tr|/h[1-6])\b[^>]*>", "\n"), r"<[a-zA-Z/!][^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return t


def repair_encoding(text: str | None) -> str | None:
    """UTF-8 that was read as a one-byte code page, read again, if that leaves fewer oddities; entities decoded."""
    if not text:
        return text
    best, score = text, _oddities(text)
    for page in ("cp1252", "latin-1"):
        try:
            again = text.encode(page).decode("utf-8")
        except UnicodeError:
            continue
        if _oddities(again) < score:
            best, score = again, _oddities(again)
    return html.unescape(best)


def _oddities(text: str) -> int:
    return len(re.findall(r"[ÃÂ][\x80-\xbf¡-¿]|�|[\x80-\x9f]|â€", text))


def decipher(text: str | None, common: set[str], shift: int = 3) -> str | None:
    """Text of a font whose letters are shifted, if shifting back gives clearly more known words."""
    if not text:
        return text
    back = "".join(chr(ord(c) - shift) if 33 + shift <= ord(c) < 127 + shift else c for c in text)
    known = lambda t: sum(w in common for w in re.findall(r"[^\W\d_]+", fold_str(t)))
    return back if known(back) > 2 * known(text) + 1 else text


def recurring_lines(rows: DataFrame, least_sessions: int = 3) -> DataFrame:
    """(form, sessions, lines): line shapes, digits masked, that many sittings share: candidates for page furniture."""
    line = rows.select("id_session", F.explode(F.split("text", "\n")).alias("line")).where((F.length(F.trim("line")) >= 3) & (F.length("line") <= 60))
    form = F.regexp_replace(F.trim("line"), r"\d+", "9")
    g = line.select("id_session", form.alias("form")).groupBy("form").agg(F.countDistinct("id_session").alias("sessions"), F.count("*").alias("lines"))
    return g.where(F.col("sessions") >= least_sessions)


def speech_motive(text: Column) -> Column:
    """Why a text is no speech: vote list, reading or nothing said; null for speech."""
    votes = F.regexp_count(text, F.lit(r"(?iu)[\p{L}]+, [\p{L} ]+: (?:s[ií]|não|no|abstención|abstenção)(?!\p{L})"))
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty").when(text.rlike(r"(?iu)votaci[óo]n nominal|votação nominal|votan a favor|votam a favor") | (votes >= 3), "vote").when(text.rlike(r"(?iu)^\s*se da lectura|^\s*lê-se|^\s*acta n"), "reading")


def tag_lines(texts: DataFrame, marker: str = r"^\s*(?:El|La|O|A)\s+(?:[Ss]r|[Ss]e[ñn]or|[Ss]enhor|SR|SRA)[^:]{2,60}:") -> DataFrame:
    """(id_int, turn, speaker, text): a text cut into turns at lines that open with a speaker's marker.

    Lines keep their order by position; a running count of markers numbers the turns.
    """
    lines = texts.select("id_int", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    is_marker = F.col("line").rlike(marker)
    n = F.sum(F.when(is_marker, 1).otherwise(0)).over(Window.partitionBy("id_int").orderBy("at"))
    tagged = lines.withColumn("turn", n.cast("int")).withColumn("speaker", F.when(is_marker, F.trim(F.regexp_replace(F.regexp_extract("line", marker, 0), r":\s*$", ""))))
    said = F.when(is_marker, F.trim(F.regexp_replace("line", marker, ""))).otherwise(F.trim("line"))
    g = tagged.withColumn("said", said).groupBy("id_int", "turn").agg(F.max("speaker").alias("speaker"), F.sort_array(F.collect_list(F.struct("at", "said"))).alias("l"))
    return g.select("id_int", "turn", "speaker", F.trim(F.array_join(F.transform("l", lambda x: x["said"]), " ")).alias("text"))


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one integer."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    every = row = (1 << len(a)) - 1
    for y in b:
        hit = row & at.get(y, 0)
        row = (row + hit | row - hit) & every
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 times the share of characters kept by insertions and deletions alone."""
    if not a and not b:
        return 100.0
    return 200.0 * common_letters(a, b) / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """Best indel ratio among the common tokens and the common tokens with either rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    first, second = (both + " " + " ".join(sorted(x - y))).strip(), (both + " " + " ".join(sorted(y - x))).strip()
    if both and (not x - y or not y - x):
        return 100.0
    return max(indel_ratio(first, second), indel_ratio(both, first) if both else 0.0, indel_ratio(both, second) if both else 0.0)


def match_names(typed: DataFrame, register: DataFrame, threshold: float = 85, margin: float = 4) -> DataFrame:
    """(country, name, id_dep, score) of typed names whose best person scores enough and clear of the second.

    A name meets every person of its country, so none over the threshold is missed and the margin is tested against
    all; scores are token-set ratios. The register doesn't grow with the turns; persons are repeated over slices of
    the names, so that a large country is many keys. Scores that can't matter are dropped at once.
    """
    parts = int(typed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.pmod(F.xxhash64("name"), F.lit(SLICES))
    left = typed.where(F.col("name").isNotNull()).select("country", "name", F.array_join(words("name"), " ").alias("l"), piece.alias("piece")).where("l <> ''").distinct()
    people = register.where(F.col("speaker_name").isNotNull()).select("country", "id_dep", F.array_join(words("speaker_name"), " ").alias("r")).where("r <> ''").distinct()
    people = people.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SLICES - 1).cast("bigint"))))
    pairs = left.repartition(parts, "country", "piece").join(people, ["country", "piece"]).select("country", "name", "l", "id_dep", "r")
    low = threshold - margin

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [token_set_ratio(x, y) for x, y in zip(b.column("l").to_pylist(), b.column("r").to_pylist())]
            out = pa.RecordBatch.from_arrays([b.column("country"), b.column("name"), b.column("id_dep"), pa.array(s, pa.float64())], names=["country", "name", "id_dep", "score"])
            yield out.filter(pa.array([x > low for x in s], pa.bool_()))

    scored = pairs.mapInArrow(score, "country string, name string, id_dep string, score double").groupBy("country", "name", "id_dep").agg(F.max("score").alias("score"))
    w = Window.partitionBy("country", "name").orderBy(F.desc("score"), "id_dep")
    ranked = scored.withColumn("second", F.lead("score").over(w)).withColumn("k", F.row_number().over(w)).where("k = 1")
    return ranked.where((F.col("score") >= threshold) & (F.coalesce("second", F.lit(0.0)) <= F.col("score") - margin)).select("country", "name", "id_dep", F.round("score", 3).alias("score"))
