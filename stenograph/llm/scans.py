"""Problem 4: noise in text read from scanned pages, and its repair."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import one_per_key, spread, table
from .terms import fold_text

#: Marks that a scan may show where a word is cut at a line's end.
CUTS = "-‐¬­‑"
# --- fixed values: what a printed string is often misread as (printed, misread) ---
CONFUSIONS = [
    ("o", "0"), ("l", "1"), ("i", "1"), ("l", "|"), ("i", "¡"), ("i", "!"), ("s", "5"), ("ó", "6"), ("b", "6"), ("g", "9"), ("q", "9"), ("z", "2"),
    ("b", "8"), ("e", "c"), ("c", "e"), ("n", "u"), ("u", "n"), ("a", "u"), ("ã", "ü"), ("i", "l"), ("l", "i"), ("r", "i"), ("t", "f"), ("f", "t"),
    ("m", "rn"), ("d", "cl"), ("cl", "d"), ("rn", "m"), ("h", "li"), ("n", "ri"), ("m", "nn"), ("u", "ii"), ("õ", "ö"),
]
#: A printed word must be this many times as frequent as the misread form ...
RATIO = 10
#: ... or this many times, if the form holds a digit or mark that words don't have.
RATIO_MARKED = 2
#: Two misreadings in a word of letters alone need this many letters each to be believed.
LETTERS_PER_ERROR = 4
#: A running header's name must stand in this share of all header-like lines, and at least LEAST_HEADER
#: times; so at most 1 / HEADER_SHARE names exist, which bounds what is sent to executors.
HEADER_SHARE = 1 / 1000
LEAST_HEADER = 5
#: Letters of a header's name; names of fewer than 8 must be met exactly, longer ones within a few edits.
LEAST_NAME = 4
#: Words in this share of all words, if nothing corrects them, are passed over at once; at most 1 / KNOWN_SHARE
#: words can be so frequent. It saves time and changes no row.
KNOWN_SHARE = 1 / 40_000

_PART = r"[^\W_][\w|¡]*(?:!(?=\w)[\w|¡]*)*"
_TOKEN = re.compile(rf"{_PART}(?:-{_PART})*|[|¡](?=[^\W\d_]{{2}})[\w|¡]+")
_PAGE = re.compile(r"\W*+(?:(?:p[áa]g(?:ina)?s?|p|folio|fl)\W{0,2}\s*)?[\dSslIOo|]{1,6}(?:\s*/\s*[\dSslIOo|]{1,6})?\W*", re.IGNORECASE)
_SPECIAL = re.compile(r"\d|[Nn][úuo]|[Rr][Ee][Uu]|[Pp][áa]g|[Ss]es|[ªº]")
_LETTERS = re.compile(r"[^\W\d_]+")
_NUMERIC = re.compile(r"\S*\d\S*")


def _without_number(token: re.Match) -> str:
    """A token that is mostly a number goes; a word with a misread digit keeps its letters."""
    text = token.group()
    return " " if sum(c.isdigit() for c in text) * 2 >= sum(c.isalnum() for c in text) else text


_AFFIX = re.compile(r"\b(?:n[úu]m|no|reun|p[áa]g(?:ina)?|sess?[ãa]o|sesi[óo]n n[úu]m)\b\.?|[ªº]", re.IGNORECASE)
_CUT = re.compile(rf"([^\W\d_](?:[\w|¡])*)([{CUTS}])[ \t]*$")


def skeleton(line: str) -> str:
    """A line's letters, folded, without numbers and the words that go with them."""
    if not _SPECIAL.search(line):
        return "".join(_LETTERS.findall(fold_text(line)))
    return re.sub(r"[\W\d_]+", "", fold_text(_NUMERIC.sub(_without_number, _AFFIX.sub(" ", line))))


_DIGIT = re.compile(r"\d")


def header_like(line: str) -> bool:
    """Whether a line is built as running headers are: a name with a page, date or number at its edge, set
    apart by a bar, dash, dot or wide blank, or in square brackets."""
    text = line.strip()
    if not _DIGIT.search(text):
        return False
    if text[0] == "[":
        return bool(re.fullmatch(r"\[[^\[\]]+,\s?\S*\d\S*[\]I|l]", text))
    return bool(
        re.fullmatch(r"(?:\S*\d\S*(?:   | — | · ))?[^\d]{4,}?(?:   | / | — |\.- )\S*\d\S*(?:   \S+\s\S*\d\S*)?", text)
        or re.fullmatch(r"\S*\d\S*\s\S+ · \S*\d\S* · [^\d]{4,}", text)
    )


def near(a: str, b: str, most: int) -> bool:
    """Whether two strings are within ``most`` edits (banded dynamic programming)."""
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row = row, [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            row[j] = min(previous[j] + 1, row[j - 1] + 1, previous[j - 1] + (x != b[j - 1]))
        if min(row) > most:
            return False
    return row[-1] <= most


class Headers:
    """The names of running headers, with the tolerance their own misreadings need."""

    def __init__(self, names: Iterable[str]) -> None:
        self.names = set(names)
        # With at most e edits, one of e + 1 parts of a name stays as it is.
        self.parts = {n: (e := 2 + (len(n) > 12), [n[len(n) * k // (e + 1) : len(n) * (k + 1) // (e + 1)] for k in range(e + 1)]) for n in self.names}
        self.lengths = {k for n in self.names for k in range(len(n) - 2, len(n) + 4)}
        self._seen: dict[str, bool] = {}
        #: Beyond this a line has more letters than a name with a date, a number and its marks.
        self.longest = max(map(len, self.names), default=0) + 32

    def matches(self, line: str) -> bool:
        if len(line) > self.longest or not self.names:
            return False
        key = skeleton(line)
        if key in self.names:
            return True
        if len(key) not in self.lengths or len(key) < 8:
            return False
        if key not in self._seen:
            if len(self._seen) > 200_000:
                self._seen.clear()
            self._seen[key] = any(near(key, n, e) for n, (e, parts) in self.parts.items() if abs(len(n) - len(key)) <= e and any(p in key for p in parts))
        return self._seen[key]


def _is_page(line: str, before: str, width: int) -> bool:
    text = line.strip()
    if not _PAGE.fullmatch(text) or not (any(c.isdigit() for c in text) or re.fullmatch(r"[SlIO]{1,4}", text)):
        return False
    if not re.search(r"[A-Za-zÀ-ÿ]", re.sub(r"[SslIOo|]", "", text)) and re.fullmatch(r"[\dSslIOo|]+", text):
        label = before.strip()  # a number under a short label belongs to a table
        if label and label[0].isupper() and len(label) < 0.6 * width and label[-1] not in ".,;:!?-" and not any(c.isdigit() for c in label):
            return False
    return True


def lines_of(text: str, headers: Headers) -> list[tuple[int, str, str | None]]:
    """(start, line, kind) of every line; kind is ``header``, ``page`` or null."""
    out, at = [], 0
    raw = text.split("\n")
    width = max(map(len, raw))
    for k, line in enumerate(raw):
        kind = None
        if line.strip():
            if headers.matches(line):
                kind = "header"
            elif _is_page(line, raw[k - 1] if k else "", width if len(raw) > 1 else 0) and len(raw) > 1:
                kind = "page"
        out.append((at, line, kind))
        at += len(line) + 1
    return out


def _opens(line: str, at: int, before: str) -> bool:
    """Whether the word at ``at`` opens a sentence."""
    while at and line[at - 1] in " \t\"“«¿¡([—–-":
        at -= 1
    last = line[at - 1] if at else before.rstrip(" \t\"”»)]")[-1:]
    return not last or last in ".!?…:"


def words_of(lines: list[tuple[int, str, str | None]], known: frozenset | set = frozenset()) -> Iterator[tuple[int, str, str, bool]]:
    """(start, word, cut form, opens) of the words of the running text that aren't in ``known``.

    A word cut at a line's end is given once, joined, with ``cut form`` holding both parts and the
    mark; pages' edges in between are stepped over. ``opens`` tells whether the word opens a sentence.
    """
    body = [(a, x) for a, x, kind in lines if kind is None and x.strip()]
    skip = 0
    for k, (at, line) in enumerate(body):
        last, rest, cut = len(line) + 1, None, None
        if line.rstrip(" \t")[-1:] in CUTS and k + 1 < len(body) and (cut := _CUT.search(line)):
            following = body[k + 1][1]
            rest = _TOKEN.match(following, len(following) - len(following.lstrip()))
            if rest and (rest.group()[0].islower() or rest.group()[0] in "|¡0156" or cut.group(1).isupper() and len(cut.group(1)) > 1):
                last = cut.start()
        fresh = {w for w in set(_TOKEN.findall(line, skip)) - known if not w.isdigit()}
        for m in _TOKEN.finditer(line, skip) if fresh else ():
            if m.end() > last:
                break
            word = m.group()
            if word in fresh:
                yield at + m.start(), word, "", _opens(line, m.start(), body[k - 1][1] if k else "")
        skip = 0
        if last <= len(line):
            start = cut.start()  # what stands before the mark may itself hold a hyphen: take the whole token
            while start and (line[start - 1].isalnum() or (line[start - 1] == "-" and start > 1 and line[start - 2].isalnum())):
                start -= 1
            head = line[start : cut.end(1)]
            yield at + start, head + rest.group(), f"{head}{cut.group(2)}{rest.group()}", False
            skip = rest.end()


_HEADS = "key string, kind string, n bigint, low bigint"


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(key, kind, n, low): occurrences of every word (lower case; ``low`` of them written so) and of
    every header-like line's name. Counted per batch first, so the shuffle carries types, not tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        names: Counter = Counter()

        def rows() -> pa.RecordBatch:
            low: Counter = Counter()
            total: Counter = Counter()
            for w, n in words.items():
                key = w.lower()
                total[key] += n
                if key == w:
                    low[key] += n
            keys = [*total, *names]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(["w"] * len(total) + ["h"] * len(names)), pa.array([*total.values(), *names.values()], pa.int64()), pa.array([low[k] for k in total] + [0] * len(names), pa.int64())],
                names=["key", "kind", "n", "low"],
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                words.update(_TOKEN.findall(text))
                if "\n" in text:
                    names.update([skeleton(x) for x in text.split("\n") if header_like(x)])
            if len(words) > 300_000:
                yield rows()
                words.clear()
                names.clear()
        yield rows()

    return texts.select("text").mapInArrow(run, _HEADS).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("low").alias("low"))


def anagram(word: Column) -> Column:
    """Sum of a hash of each character: words with the same letters share it, and replacing one string
    by another shifts it by a difference that depends on these two strings alone."""
    return F.aggregate(F.filter(F.split(word, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda s, c: s + F.shiftright(F.xxhash64(c), 20))


def corrections(words: DataFrame, ratio: int = RATIO, ratio_marked: int = RATIO_MARKED) -> DataFrame:
    """(word, printed, edits): the likeliest printed form of every rare word that has one.

    Rare words are joined with words ``ratio`` times as frequent by anagram hash: hash(printed) =
    hash(word) + the difference of one or two confusions whose misread strings the word holds. An edit
    distance no larger than the confusions' own confirms the match. Printed forms that are
    ``ratio`` times as frequent come first, then fewest edits, the most frequent form, the alphabet. Printed forms must occur in lower case.
    """
    spark = words.sparkSession
    pairs = CONFUSIONS
    single = [(b, None, a, None, max(len(a), len(b))) for a, b in pairs]
    double = [(b, d, a, c, max(len(a), len(b)) + max(len(c), len(d))) for k, (a, b) in enumerate(pairs) for c, d in pairs[k:]]
    rules = spark.createDataFrame([(i, *r) for i, r in enumerate(single + double)], "rule int, m1 string, m2 string, p1 string, p2 string, cost int")
    shift = anagram(F.concat("p1", F.coalesce("p2", F.lit("")))) - anagram(F.concat("m1", F.coalesce("m2", F.lit(""))))
    rules = F.broadcast(rules.withColumn("shift", shift))  # a fixed list
    plain = words.where(F.col("key").rlike(r"\p{L}") & ~F.col("key").rlike(r"^\d+[hH]\d*$|-"))
    frequent = plain.where((F.col("n") >= 2) & F.col("key").rlike(r"^\p{L}{2,}$") & (F.col("low") * 2 >= F.col("n"))).select(F.col("key").alias("printed"), F.col("n").alias("n_printed"), anagram(F.col("key")).alias("hash"))
    marked = F.col("key").rlike(r"[0-9|¡!]")
    rare = plain.where((F.length("key") >= 4) | (marked & (F.length("key") >= 2))).select(F.col("key").alias("word"), "n", marked.alias("marked"), anagram(F.col("key")).alias("own"))
    letters = list(dict.fromkeys(b for _, b in pairs))
    # The rules that can apply are found from the strings the word holds, so no rule is tried in vain.
    held = rare.withColumn("m1", F.explode(F.filter(F.array(*[F.when(F.instr("word", m) > 0, F.lit(m)) for m in letters]), lambda x: x.isNotNull())))
    tried = held.join(rules, "m1").where(F.col("m2").isNull() | ((F.instr("word", F.col("m2")) > 0) & (F.col("marked") | (F.length("word") >= LETTERS_PER_ERROR * 2)))).withColumn("hash", F.col("own") + F.col("shift"))
    hits = tried.join(frequent, "hash").where(
        (F.col("word") != F.col("printed"))
        & (F.col("n_printed") >= F.col("n") * F.when(F.col("marked"), ratio_marked).otherwise(ratio))
        & (F.levenshtein("word", "printed") <= F.col("cost"))
    )
    best = F.struct(F.col("n_printed") < F.col("n") * ratio, F.col("cost"), -F.col("n_printed"), F.col("printed"))
    return hits.groupBy("word").agg(F.min(best).alias("b")).select("word", F.col("b.printed").alias("printed"), F.col("b.cost").alias("edits"))


class Evidence:
    """What is known from the whole corpus: word counts and corrections (stored), header names, very frequent words
    that nothing corrects."""

    def __init__(self, texts: DataFrame) -> None:
        counts = materialize(corpus_counts(texts), "scan-counts")
        self.words = counts.where(F.col("kind") == "w")
        heads = counts.where((F.col("kind") == "h") & (F.length("key") >= LEAST_NAME))
        totals = counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()
        total = {r["kind"]: r["n"] for r in totals}
        least = max(LEAST_HEADER, total.get("h", 0) * HEADER_SHARE)
        self.headers = sorted(r["key"] for r in heads.where(F.col("n") >= least).select("key").collect())
        self.corrections = materialize(corrections(self.words), "scan-corrections")
        often = self.words.where((F.col("n") >= total.get("w", 0) * KNOWN_SHARE) & F.col("key").rlike(r"^\p{L}+$")).select("key")
        self.known = sorted(r["key"] for r in often.join(self.corrections, F.col("key") == F.col("word"), "left_anti").collect())


def candidates(texts: DataFrame, evidence: Evidence) -> DataFrame:
    """(id_int, kind, start_char, end_char, word, cut): edge lines as they are, cut words, and words not known to
    be right."""
    names, often = evidence.headers, evidence.known

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headers, known = Headers(names), {form for w in often for form in (w, w[:1].upper() + w[1:])}
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for identity, text in zip(batch.column("id_int").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                lines = lines_of(text, headers) if "\n" in text else [(0, text, None)]
                for at, line, kind in lines:
                    if kind:
                        row = (identity, kind, at + len(line) - len(line.lstrip()), at + len(line), None, None)
                        for c, v in zip(out, row):
                            c.append(v)
                for at, word, cut, opens in words_of(lines, known):
                    low = word.lower()
                    named = word[0].isupper() and not opens and not (len(word) > 3 and word.isupper())
                    if cut:
                        for c, v in zip(out, (identity, "hyphen", at, at + len(cut), low, cut.lower())):
                            c.append(v)
                    if low in known or named or low.isdigit() or not any(ch.isalpha() for ch in low):
                        continue
                    for c, v in zip(out, (identity, "char", at, at + len(word), low, None)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["id_int", "kind", "start_char", "end_char", "word", "cut"])

    return texts.select("id_int", "text").mapInArrow(run, "id_int string, kind string, start_char bigint, end_char bigint, word string, cut string")


def faults(texts: DataFrame, evidence: Evidence | None = None) -> DataFrame:
    """(id_int, kind, start_char, end_char, repaired) of every scanning fault of ``texts`` (id_int, text).

    Headers and page numbers are found line by line; a cut word is a fault unless the corpus has the
    hyphenated form more often than the joined one; a misread word is one that ``corrections`` mends.
    ``repaired`` is the joined or corrected word, null for lines to remove. Word evidence is joined by
    word, never broadcast; only the bounded sets of header names and very frequent words are sent out.
    Null and empty texts have no faults; repeated ids should be brought down to one row before.
    """
    evidence = evidence or Evidence(texts)
    found = materialize(candidates(texts, evidence), "scan-candidates")
    edge = found.where(F.col("kind").isin("header", "page")).select("id_int", "kind", "start_char", "end_char", F.lit(None).cast("string").alias("repaired"))
    cuts = found.where(F.col("kind") == "hyphen").withColumn("hyphened", F.regexp_replace("cut", f"[{CUTS}]", "-"))
    counted = evidence.words.select(F.col("key").alias("word"), F.col("n").alias("joined_n"))
    hyphened = evidence.words.where(F.col("key").contains("-")).select(F.col("key").alias("hyphened"), F.col("n").alias("hyphened_n"))
    cuts = cuts.join(counted, "word", "left").join(hyphened, "hyphened", "left")
    hyphen = cuts.where(F.coalesce("hyphened_n", F.lit(0)) <= F.coalesce("joined_n", F.lit(0))).select("id_int", "kind", "start_char", "end_char", F.col("word").alias("repaired"))
    wrong = found.where(F.col("kind") == "char").join(evidence.corrections, "word").select("id_int", "kind", "start_char", "end_char", F.col("printed").alias("repaired"))
    return edge.unionByName(hyphen).unionByName(wrong)


_CUT_WORD = re.compile(rf"[^\W\d_][\w|¡-]*[{CUTS}]\s*")


def repair(text: str, found: list) -> str:
    """The text with edge lines removed, cut words joined, misread words corrected and lines reflowed.

    A blank line, or the end of a line that closes a sentence well before the usual width, ends a
    paragraph. A word's capitals are kept.
    """
    out, at = [], 0
    for f in sorted(found, key=lambda f: (f["start_char"], f["kind"] != "hyphen")):
        a, b, new = f["start_char"], f["end_char"], f["repaired"]
        if a < at:
            continue
        out.append(text[at:a])
        old = text[a:b]
        if new is None:
            at = b + 1 if text[b : b + 1] == "\n" else b
        else:
            if f["kind"] == "hyphen":  # the rest of the word may lie behind a page's edge
                m = _CUT_WORD.match(text, a)
                b = m.end() if m else b
                tail = _TOKEN.match(text, b)
                b = tail.end() if tail else b
            out.append(new.upper() if old.isupper() and len(old) > 1 else new[:1].upper() + new[1:] if old[:1].isupper() else new)
            at = b
    out.append(text[at:])
    paragraphs = re.split(r"\n\s*\n", "".join(out))
    joined = (" ".join(line for line in map(str.strip, x.split("\n")) if line) for x in paragraphs)
    return "\n\n".join(p for p in joined if p)


def whole_rows(spark: SparkSession, folder: str) -> DataFrame:
    """id_int and text of every row, one per id_int; stored."""
    rows = spread(table(spark, folder, "interventions").select("id_int", "row_n", "text").where(F.col("text").isNotNull()))
    return materialize(one_per_key(rows, "id_int", "row_n", ["id_int", "text"], payload=True), "scan-texts")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every scanning fault: id_int, kind, start_char."""
    return faults(whole_rows(spark, folder)).select("id_int", "kind", "start_char").distinct()


def p4_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Every text, repaired into continuous paragraphs, with the number of faults mended."""
    texts = whole_rows(spark, folder)
    per_row = faults(texts).groupBy("id_int").agg(F.collect_list(F.struct("kind", "start_char", "end_char", "repaired")).alias("faults"))
    joined = texts.join(per_row, "id_int", "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("faults").to_pylist()
            mended = [repair(t, f or []) for t, f in zip(batch.column("text").to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([batch.column("id_int"), pa.array(mended, pa.string()), pa.array([len(f or []) for f in found], pa.int32())], names=["id_int", "text", "n_faults"])

    return joined.mapInArrow(run, "id_int string, text string, n_faults int")


QUERIES = {"p4_found": p4_found, "p4_repaired": p4_repaired}
SQL: dict[str, str] = {}
