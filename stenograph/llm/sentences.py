"""Problem 10: sentence boundaries across languages and scripts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread, table

# --- fixed values: abbreviations, lower case, without the final dot ---
#: A name or word follows: never the end of a sentence.
TITLES = set(
    # Spanish, Portuguese, Galician, Catalan
    "sr sra srta sres sras srs dr dra dres drs d dª da dña d.ª sto sta san fr mons excmo excma exmo exma ilmo ilma il·lm il·lma ilustr hble hon honor lic licdo licda ing arq abog prof profa profª "
    "gral cnel cap.º tte sgto alm v vd vds ud uds exa exª v.exa rev revdo pdte secr min dip dep sen cons av avda c gob pje pza ej p.ej p.ex ex vid cfr cf fig figs apdo núm.º "
    # English
    "mr mrs ms mx messrs dr st gen col capt lt sgt cpl maj adm cmdr rev hon gov pres rep sen supt fr br sir vs viz e.g i.e cf prof "
    # French
    "m mm mme mmes mlle mlles mgr me cie fg bd éd "
    # German
    "hr hrn fr frl prof dipl ing z.b u.a d.h i.d.r bzw vgl gem geb sog inkl exkl einschl str bd hrsg ggf evtl "
    # Russian, Greek
    "г-н г-жа г-ном гг им т.е т.к ул пр акад проф см ср κ κκ κα δρ καθ βλ πρβλ π.χ δηλ "
    # Hindi
    "डॉ श्री श्रीमती प्रो "
    # Arabic
    "د أ م "
    .split()
)
#: A number (also a Roman one) follows: not the end then.
NUMBERED = set(
    "art arts artº núm núms num nº n no nos nr pág págs pag pags pàg pàgs páx páxs p pp pg cap caps cáp tít tit secc sec seç sect ses lib libr vol vols t tom tomo ley ap fracc inc par párr anex an ed f fol "
    "ch chap fasc § abs s seit ziff kap bd rz ст п пп стр гл разд ч т № σελ αρ αριθ άρ παρ τόμ पृ अनु ص ج م ق ene feb mar abr may jun jul ago sep sept set oct nov dic out dez jan apr aug okt dec dept cca ca aprox approx "
    .split()
)
#: They may end a sentence: it ends if an upper-case word follows.
CLOSING = set("etc usw u.s.w inc ltd corp co s.a s.l cía bros a.m p.m a.c d.c ss sig sigs sgts ff uu h hs hrs min seg km kg m cm ha km² mill mio mrd млн млрд тыс руб д др εκ δισ κ.λπ κλπ κ.ά jr sr.jr".split())
#: Single letters that close a compound abbreviation, by what stands before them.
COMPOUND_END = {("p", "m"), ("a", "m"), ("s", "a"), ("s", "l"), ("ee", "uu"), ("т", "д"), ("т", "п"), ("u", "s"), ("d", "c"), ("a", "c")}
COMPOUND_MORE = {("z", "b"), ("d", "h"), ("u", "a"), ("i", "d"), ("d", "r"), ("p", "ej"), ("p", "ex"), ("т", "е"), ("т", "к"), ("i", "e"), ("e", "g"), ("v", "exa"), ("ss", "ss")}
#: German words before an ordinal number.
BEFORE_ORDINAL = set("am der die das dem den des im vom zum zur beim ab bis seit ihr ihre sein seine ein eine jeder jede".split())
#: Thai words that carry a sentence on behind a blank.
THAI_MORE = ("และ", "หรือ", "แต่", "ว่า", "เพื่อ", "ซึ่ง", "โดย", "เพราะ", "ให้", "ล้าน", "บาท", "ฉบับ", "คน", "ปี", "เปอร์เซ็นต์", "ร้อยละ", "วัน", "เดือน", "ครั้ง", "แห่ง", "ข้อ", "พัน", "หมื่น", "แสน", "ๆ", "ฯ", "น.", "เวลา", "นาฬิกา", "พ.ศ.", "ค.ศ.", "ม.ค.", "ก.พ.", "มี.ค.", "เม.ย.", "พ.ค.", "มิ.ย.", "ก.ค.", "ส.ค.", "ก.ย.", "ต.ค.", "พ.ย.", "ธ.ค.", "มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน", "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม")
#: What carries a sentence on behind a closing quotation mark in Chinese and Japanese.
QUOTE_MORE = ("と", "って", "とは", "は", "が", "を", "に", "の", "も", "で", "など", "という", "然后", "随后", "接着", "说", "道", "表示", "问", "答", "的", "和", "与", "而", "後", "後に")

#: Lao words that carry a sentence on behind a blank.
LAO_MORE = ("ແລະ", "ຫຼື", "ແຕ່", "ວ່າ", "ເພື່ອ", "ຊຶ່ງ", "ໂດຍ", "ເພາະ", "ໃຫ້", "ຄົນ", "ປີ", "ວັນ", "ໆ")

# The characters of the standard's classes, taken from the Unicode database of the regex module.
_ALL = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
_STERM, _ATERM, _CONTINUE = (frozenset(regex.findall(rf"\p{{Sentence_Break={c}}}", _ALL)) for c in ("STerm", "ATerm", "SContinue"))
_STANDARD = _STERM | _ATERM
#: Added to the standard's terminators: the ellipsis, the Greek question mark as typed, the Tibetan shads.
_SHADS = frozenset("།༎༏༑")
_ADDED = frozenset("…;;") | _SHADS
#: Dashes open speech in many languages, so behind a blank they don't carry a sentence on as the standard has it.
_DASHES = frozenset("-–—")
#: Terminators that need no blank behind them: those of one script alone, and the dandas several scripts share.
_CLOSE = {c for c in _STERM if not regex.match(r"\p{Script=Common}", c)} | {*"।॥"}
_WIDE = frozenset("。！？｡．")
_PAIRS = {"(": ")", "[": "]", "{": "}", "«": "»", "“": "”", "„": "“", "‹": "›", "「": "」", "『": "』", "（": "）", "【": "】", "〈": "〉", "《": "》", "〔": "〕", "［": "］", "‚": "‘"}
_CLOSED_BY = {c: [a for a, b in _PAIRS.items() if b == c] for c in _PAIRS.values()}
_OPENING = "¿¡«“„\"'‘‹([{「『（【〈《—–―-•*"


def _class(chars: Iterable[str], most: str = "\uffff") -> str:
    return "[" + "".join(re.escape(c) for c in sorted(chars) if c <= most) + "]"


# A class within the first plane compiles to a table; the other is slower, for texts beyond it.
_RUNS = {(tailored, far): re.compile(_class(_STANDARD | _ADDED if tailored else _STANDARD, "\U0010ffff" if far else "\uffff") + "+") for tailored in (False, True) for far in (False, True)}
_EXTEND = r"[\p{Sentence_Break=Extend}\p{Sentence_Break=Format}]*+"
#: Closing marks, then blanks; a single line break is a blank here.
_TAIL = regex.compile(rf"{_EXTEND}((?:\p{{Sentence_Break=Close}}{_EXTEND})*+)((?:[\p{{Sentence_Break=Sp}}\p{{Sentence_Break=Sep}}\r\n]{_EXTEND})*+)")
_BARRED = r"\p{Sentence_Break=OLetter}\p{Sentence_Break=Upper}\p{Sentence_Break=Lower}\p{Sentence_Break=Sep}\r\n\p{Sentence_Break=STerm}\p{Sentence_Break=ATerm}"
_LOWER_AHEAD = {False: regex.compile(rf"[^{_BARRED}]*+\p{{Sentence_Break=Lower}}"), True: regex.compile(rf"[^{_BARRED}\p{{Sentence_Break=Numeric}}]*+\p{{Sentence_Break=Lower}}")}
_NUMERIC = regex.compile(r"\p{Sentence_Break=Numeric}")
_UPPER = regex.compile(r"\p{Sentence_Break=Upper}")
_CASED = regex.compile(r"[\p{Sentence_Break=Upper}\p{Sentence_Break=Lower}]")
_SKIPPED = regex.compile(r"[\p{Sentence_Break=Extend}\p{Sentence_Break=Format}]")
_MARKS = re.compile("[" + re.escape("".join({*_PAIRS, *_PAIRS.values(), '"'})) + "]")
_PARAGRAPH = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+|\u2029")
_DELIMITERS = frozenset("«»\"“”„()[]{}¿¡—–,;:/")
_UNSPACED = re.compile("[\u0e00-\u0eff]")  # Thai and Lao
_GAP = re.compile(r"(?:(?<=[\u0e00-\u0eff0-9)\]\"”])|(?<=น\.))\s+(?=[\u0e00-\u0eff\"“(])")
_ROMAN = re.compile(r"[IVXLCDM]+(?:\b|[.,])")
_LETTER = re.compile(r"[^\W_]")
_SHORT = re.compile(r"[^\W\d_]{1,3}\.")


def standard_breaks(text: str, begin: int = 0, tailored: bool = True) -> Iterator[tuple[int, int, int, int]]:
    """(first, behind, closed, next) of every break of rules SB5 to SB11 of Unicode's sentence segmentation.

    ``text[first:behind]`` are the terminators, closing marks reach to ``closed``, blanks to ``next``, where
    the break is. Rules SB3 and SB4 (line and paragraph separators) are the caller's: a separator counts as
    a blank here. Tailored, the ellipsis, the Greek question mark and the Tibetan shads are terminators too,
    a number may open a sentence (SB8), and so may a dash behind a blank (SB8a).
    """
    ahead = _LOWER_AHEAD[tailored]
    for m in _RUNS[tailored, max(text, default="") > "\uffff"].finditer(text, begin):
        first, behind = m.span()
        tail = _TAIL.match(text, behind)
        closed, after = tail.end(1), tail.end()
        if after >= len(text):
            return
        c, last = text[after], text[behind - 1]
        if c in _STANDARD or c in _CONTINUE and not (tailored and c in _DASHES and after > closed):  # SB8a
            continue
        if last in _ATERM or tailored and last == "…":
            if not _TAIL.match(text, behind).group(1) and after == closed:
                if _NUMERIC.match(c):  # SB6
                    continue
                k = behind - 2
                while k >= 0 and _SKIPPED.match(text[k]):
                    k -= 1
                if k >= 0 and _CASED.match(text[k]) and _UPPER.match(c):  # SB7
                    continue
            if ahead.match(text, after):  # SB8
                continue
        yield first, behind, closed, after  # SB9 to SB11


def standard_sentences(text: str) -> list[str]:
    """The sentences of the standard's own rules, separators (SB3, SB4) included; nothing tailored."""
    out = []
    for part in regex.findall(r"[^\r\n\p{Sentence_Break=Sep}]*(?:\r\n|[\r\n\p{Sentence_Break=Sep}])|[^\r\n\p{Sentence_Break=Sep}]+", text):
        at = 0
        for *_, after in standard_breaks(part, 0, False):
            if part[after] not in "\r\n\x85\u2028\u2029":
                out.append(part[at:after])
                at = after
        out.append(part[at:])
    return out


def _protected(text: str) -> list[tuple[int, int]]:
    """Outermost (open, close) of the paired brackets and quotation marks; unpaired ones count for nothing.

    One sweep: the open marks lie on a stack, with the places of each kind beside it, so a closing mark
    finds its partner at once and every mark is pushed and popped at most once.
    """
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}
    spans: list[tuple[int, int]] = []
    straight = [m.start() for m in re.finditer('"', text)]
    pairs = dict(zip(straight[::2], straight[1::2])) if len(straight) > 1 else {}
    for m in _MARKS.finditer(text):
        c, at = m.group(), m.start()
        if c == '"':
            if at in pairs:
                spans.append((at, pairs[at]))
            continue
        partner = max((places[a][-1] for a in _CLOSED_BY.get(c, ()) if places.get(a)), default=-1)
        if partner >= 0:
            spans.append((stack[partner][1], at))
            while len(stack) > partner:
                places[stack.pop()[0]].pop()
        elif c in _PAIRS:
            places.setdefault(c, []).append(len(stack))
            stack.append((c, at))
    spans.sort()
    outer: list[tuple[int, int]] = []
    for a, b in spans:
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
        elif b > outer[-1][1]:
            outer[-1] = (outer[-1][0], b)
    return outer


def _token_start(text: str, end: int, start: int) -> int:
    """Where the run of characters that ends at ``end`` and holds no blank or delimiter begins."""
    while end > start and text[end - 1] not in _DELIMITERS and not text[end - 1].isspace():
        end -= 1
    return end


def _ends_at_dot(text: str, at: int, following: int, start: int) -> bool:
    """Whether the dot at ``at`` ends a sentence although what stands at ``following``, not in lower case, comes next."""
    begin = _token_start(text, at, start)
    if begin == at:
        return True
    token = text[begin:at].strip(".'’·")
    low = token.lower()
    if "'" in low or "’" in low:
        low = re.split(r"['’]", low)[-1]
    number = text[following].isdigit() or bool(_ROMAN.match(text, following))
    end = begin
    while end > start and text[end - 1].isspace():
        end -= 1
    previous = text[_token_start(text, end, start) : end]
    prior = previous.strip(".'’").lower()
    if previous.endswith(".") or "." in low:
        first, last = low.rsplit(".", 1) if "." in low else (prior, low)
        first = first.rsplit(".", 1)[-1]
        if (first, last) in COMPOUND_END:
            return not number
        if (first, last) in COMPOUND_MORE:
            return False
    if number and (low in NUMBERED or low in TITLES):
        return False
    if token.isupper() and len(token) <= 3 and _SHORT.match(text, following) and text[following : following + 2].isupper():
        return False  # the first half of a doubled abbreviation
    if low in CLOSING and (len(low) > 1 or prior[-1:].isdigit()):
        return True
    if low in TITLES:
        return False
    if low in NUMBERED and len(low) == 1:
        return False
    if low == "г":
        return bool(re.search(r"\d$", prior))
    if len(token) == 1 and token.isalpha():
        return not token.isupper() and token.islower() and prior[-1:].isdigit()
    if token.isdigit() and len(token) <= 3:
        return end > start and prior not in BEFORE_ORDINAL  # the number of an item, an ordinal
    return True


def boundaries(text: str | None) -> list[int]:
    """Offset of the first character of every sentence, opening marks included.

    The breaks of Unicode's sentence segmentation (``standard_breaks``), tailored: a blank line ends a
    sentence, a single line break is a blank. Breaks inside paired quotation marks or brackets end nothing,
    unless the closing mark follows at once and a new sentence begins behind it. A dot after an
    abbreviation, initial or ordinal ends nothing. Thai and Lao sentences end at blanks that don't belong
    to a number or a carried-on clause. Null and blank texts have no sentence. Time is linear in the text.
    """
    if not text or text.isspace():
        return []
    out: list[int] = []
    at = 0
    for gap in [*_PARAGRAPH.finditer(text), None]:
        end = gap.start() if gap else len(text)
        paragraph = text[at:end]
        if paragraph and not paragraph.isspace():
            out += [at + k for k in _within(paragraph)]
        at = gap.end() if gap else end
    return out


def _within(text: str) -> list[int]:
    start = len(text) - len(text.lstrip())
    out = [start]
    spans = _protected(text) if _MARKS.search(text) else []
    k, seen, letter = 0, -1, ""
    for position, behind, closed, after in standard_breaks(text, start):
        run, space = text[position:behind], after > closed
        closers = closed > behind
        while k < len(spans) and spans[k][1] < position:
            k += 1
        quoted = False
        if k < len(spans) and spans[k][0] < position:
            if not closers or spans[k][1] >= closed:
                continue
            quoted = True
        elif closers:
            # a mark that opens something behind the terminator isn't a closer
            j = k
            while j < len(spans) and spans[j][0] < behind:
                j += 1
            if j < len(spans) and spans[j][0] < closed:
                after = spans[j][0]
                closers, space = bool(text[behind:after].strip()), text[behind:after] != ""
        first = text[after]
        if not _WIDE.isdisjoint(run):
            if not (quoted and text.startswith(QUOTE_MORE, after) or first in "，、；：,;:）」』”"):
                out.append(after)
            continue
        if not _SHADS.isdisjoint(run):
            if space:
                out.append(after)
            continue
        if not space and not (run[-1] in _CLOSE and first.isalpha()):
            continue
        if seen < after:  # the next letter or digit, looked up once for all breaks before it
            found = _LETTER.search(text, after)
            seen, letter = (found.start(), found.group()) if found else (len(text), "")
        if all(c in ";;" for c in run):  # the Greek question mark
            if ("Ͱ" <= text[position - 1] <= "Ͽ" or "ἀ" <= text[position - 1] <= "῿") and (letter.isupper() or letter.isdigit()):
                out.append(after)
            continue
        if not letter or letter.islower() or first in ",;:)]}»”%.!?…":
            continue
        run = run.strip(";;")
        if set(run) <= {".", "…", "‥", "․"} and (len(run) > 1 or run in "…‥"):
            if letter.isupper() and space:
                out.append(after)
            continue
        if run == "." and not closers:
            rest = after
            while rest < len(text) and text[rest] in _OPENING:
                rest += 1
            if rest == after and not _ends_at_dot(text, position, rest, start):
                continue
            if first in "([" and letter.isdigit():
                continue
        out.append(after)
    if _UNSPACED.search(text):
        out = sorted({*out, *_blank_breaks(text, spans)})
    return out


def _blank_breaks(text: str, spans: list[tuple[int, int]]) -> Iterator[int]:
    """Breaks at the blanks of scripts that set blanks between sentences and clauses only (Thai, Lao)."""
    k, done, own = 0, 0, False
    for m in _GAP.finditer(text):
        for c in reversed(text[done : m.start()]):
            if c.isalpha():
                own = bool(_UNSPACED.match(c))  # whether the last letter so far is of such a script
                break
        done = m.start()
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if k < len(spans) and spans[k][0] < m.start() or not own:
            continue
        if text[m.start() - 1] not in "ๆໆ" and not text.startswith(THAI_MORE, m.end()) and not text.startswith(LAO_MORE, m.end()):
            yield m.end()


def sentences(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sentence_no, start_char, end_char, sentence): one row per sentence, numbered from 1.

    ``end_char`` is exclusive, without trailing blanks. One pass over the text column without shuffle.
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers, starts, ends, units = [], [], [], [], []
            ids = batch.column(key)
            for row, value in enumerate(batch.column(text).to_pylist()):
                found = boundaries(value)
                for n, a in enumerate(found):
                    unit = value[a : found[n + 1] if n + 1 < len(found) else len(value)].rstrip()
                    keys.append(row)
                    numbers.append(n + 1)
                    starts.append(a)
                    ends.append(a + len(unit))
                    units.append(unit)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(keys, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(units, pa.string())], names=[key, "sentence_no", "start_char", "end_char", "sentence"])

    return documents.select(key, text).where(F.col(text).isNotNull()).mapInArrow(run, f"`{key}` {kind}, sentence_no int, start_char bigint, end_char bigint, sentence string")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """First character of every sentence of every document."""
    return sentences(spread(table(spark, folder, "documents").select("doc_id", "text"))).select("doc_id", "start_char")


def p10_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as its sentences."""
    return sentences(spread(table(spark, folder, "documents").select("doc_id", "text")))


QUERIES = {"p10_found": p10_found, "p10_sentences": p10_sentences}
SQL: dict[str, str] = {}
