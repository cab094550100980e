"""Pieces of a transcript that aren't speech of the turn: stamps, fillers, sound notes, labels."""

from __future__ import annotations

import re

from .terms import composed, fold_text

# --- fixed values: hesitations and empty phrases of Spanish and Portuguese transcripts ---
#: Set off by commas or by a sentence's start, and followed by a comma.
PHRASES = ["o sea", "pues eso", "digamos", "es decir que", "quer dizer", "tipo assim", "então assim", "pois é", "ou seja que"]
#: Hesitations: they may be drawn out by repeating a letter.
HESITATIONS = [r"e+h+m*", r"e+m+", r"m{2,}h*", r"a+h+n*", r"u+h+m*", r"h+u+m+", r"h+m{2,}", r"é{2,}", r"h+ã+", r"ã+h*n*"]
#: Words that are fillers only when they trail off in dots.
TRAILING = ["este", "esto", "é", "eh+", "e+h", "hã+", "ã+", "eh", "um", "bueno", "pues", "então", "m+", "ah+n*", "hum+"]
#: Tags asked of nobody.
TAGS = [r"¿\s*(?:eh+|verdad|no|sabes?|me explico|vale)\s*\?", r"(?:né|sabe|tá|certo|viu|entende|percebe)\s*\?"]
#: Stems of noises, gestures and pauses, folded.
SOUNDS = [
    "aplau", "palma", "ovac", "risa", "riso", "rien", "carcaj", "murmu", "rumor", "abuche", "vaia", "pausa", "silenci", "tose", "tosse",
    "carrasp", "susurr", "grit", "protest", "interrup", "timbre", "campan", "campain", "golpe", "maza", "martel", "apartes", "inaudib",
    "ininteligib", "microfon", "tumult", "bulla", "alborot", "suena", "suenan", "soa", "soam", "muito bem", "muy bien", "bravo", "apoiad",
    "llora", "chora", "suspir", "ruido", "barulh", "musica", "se oye", "ouve se", "desligad", "apagad", "asient", "gesto", "senala",
    "manifestac", "hilarid",
]
#: Honorifics that open a label.
HONORIFIC = r"(?:se[ñn]or(?:a|es|as|ita)?|senhor(?:a|es|as)?|sr[ae]?s?\.?|srta\.?|dip\.?|dep\.?|diputad[oa]|deputad[oa]|ministr[oa]|senador(?:a)?|don|doña|dr[a]?\.)"

_STAMP = re.compile(
    r"[\[(<{]\s*\d{1,2}\s*(?:[:.]\s*\d{2}\s*[:.]\s*\d{2}(?:[.,]\d{1,3})?|[:hH]\s*\d{2}(?:min)?)\s*[\])>}]"
    r"|#\s*\d{1,2}:\d{2}:\d{2}(?:[-.,]\d+)?\s*#"
    r"|(?<![\w:.,/])\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?![\w:/])"
)
_EDGE = r"(?:^|[,;:.!?…)\]}>*#—–¿¡-]\s{1,2}|[¿¡\n]|\d\s)"
_FILLER = re.compile(
    rf"{_EDGE}(?P<all>"
    rf"(?:{'|'.join(sorted(PHRASES, key=len, reverse=True)).replace(' ', chr(92) + 's+')})(?=\s*,)"
    rf"|(?:{'|'.join(HESITATIONS)})(?:\.{{2,}}|…|(?=\s*[,.…]))"
    rf"|(?:{'|'.join(TRAILING)})(?:\.{{2,}}|…)"
    rf"|{'|'.join(TAGS)}"
    rf")",
    re.IGNORECASE,
)
_BRACKETED = re.compile(r"\(([^()]{2,})\)|\[([^\[\]]{2,})\]|\{([^{}]{2,})\}|<([^<>]{2,})>|(?<!\*)\*([^*\n()\[\]{}<>]{2,})\*(?!\*)")
_CAPITAL = r"(?:[A-ZÀ-ÖØ-Þ]\.|[A-ZÀ-ÖØ-Þ0-9](?:[\w'’|¡!ª]|-(?=\w))*+)"
#: As many parts as there are; never given back, since what ends a label can't be part of a name.
_NAME = re.compile(rf"{_CAPITAL}(?:,?\s+(?:{_CAPITAL}|(?:de|da|do|dos|das|del|la|las|los|e|y)(?=\s)))*+")
_OPENS = re.compile(
    r"(?:^|[.!?…»”\"')\]}>*#\d,;:—–-]\s{1,2}|\n)[^\S\n]?(?P<all>(?P<mark>>>\s*|[—–-]{1,2}\s*|\*{1,2})?"
    rf"(?P<title>(?P<article>(?:El|La|Los|Las|O|A|Os|As|EL|LA)\s+)?(?P<honor>(?i:{HONORIFIC}))\s+)?|\[)(?=[A-ZÀ-ÖØ-Þ0-9])"
)
_ENDS = re.compile(r"(?P<paren>\s*\([^()\n]+\))?(?P<end>(?:\s*:|\s?\.\s?[-–—]+|\s[-–—]+)(?=\s)|\s*:\*{1,2})")
_CLOSES = re.compile(r"\](?=\s)")
#: Names of running headers, folded; they look like labels when a dash follows.
_PRINTED = re.compile(r"diario|boletin|boletim|actas?|atas|congres|camara|asamblea|assembleia|version|sesion|sess|taquigraf|debates")
_SMALL = re.compile(r"[a-zß-öø-ÿ]{2}")
_PAGE_LINE = re.compile(r"[^\w\n]*\d{1,4}[^\w\n]*(?=\n|\Z)|[^\S\n]*\d{1,2}[/.\-\w]\d{1,2}[/.\-\w]\d{2,4}")
_BLANKS = re.compile(r"[^\S\n]*")
_LINE_ENDS = re.compile(r"\n+")
#: What stands before a remark that is set off from the sentence.
_SETS_OFF = frozenset(".!?…:;)]}>*#\"”»—–-")


def note_form(inside: str) -> str:
    """What uses of one remark in brackets share: its folded words, misread characters mended, cut words joined."""
    return " ".join(re.findall(r"[^\W_]+", fold_text(re.sub(r"[-‐¬\u00ad]\s*\n\s*", "", inside)).translate(str.maketrans("0|1!¡5", "oliiis"))))


def _noisy(form: str) -> bool:
    """Whether a remark begins with a noise, gesture or pause, or a third of its words are such."""
    words = form.split()
    hits = [any(w == s or len(s) > 3 and w.startswith(s) for s in SOUNDS if " " not in s) for w in words]
    return bool(words) and (hits[0] or 3 * sum(hits) >= len(words) or any(form.startswith(s) for s in SOUNDS if " " in s))


def _upper(name: str) -> bool:
    """Whether a word of three or more letters is in capitals (a misread character doesn't matter)."""
    return any(sum(c.isupper() for c in w) >= 3 and not any(c.islower() for c in w) for w in re.findall(r"[\w|¡!]+", name))


class _Ahead:
    """Where a pattern is found next at or behind a place that only moves forward: each stretch is searched once."""

    def __init__(self, pattern: re.Pattern, text: str) -> None:
        self.pattern, self.text, self.at = pattern, text, -1

    def __call__(self, place: int) -> int:
        if self.at < place:
            m = self.pattern.search(self.text, place)
            self.at = m.start() if m else len(self.text) + 1
        return self.at


def _free(layer: list[tuple], taken: list[tuple]) -> list[tuple]:
    """The members of a layer, in order, that overlap neither each other nor what is taken (sorted): one sweep."""
    out, k, done = [], 0, 0
    for piece in layer:
        while k < len(taken) and taken[k][1] <= piece[0]:
            k += 1
        if piece[0] >= done and (k == len(taken) or taken[k][0] >= piece[1]):
            out.append(piece)
            done = piece[1]
    return out


#: kind, how sure it is from the text alone (2 sure, 1 likely, 0 doubtful), what decides doubts (form of a note, label).
Candidate = tuple[int, int, str, int, str | None]


def _labels(text: str) -> list[Candidate]:
    out: list[Candidate] = []
    small, line_end = _Ahead(_SMALL, text), _Ahead(_LINE_ENDS, text)
    dead = -1  # a name that runs on to a place where no label ends does so from each of its parts
    for m in _OPENS.finditer(text):
        at, begin = m.end(), m.start("all")
        if at < dead:
            continue
        run = _NAME.match(text, at)
        if not run:
            continue
        stop = run.end()
        if m.group("all") == "[":
            if _CLOSES.match(text, stop):
                named = run.group()
                if re.search(r"[^\W\d_]{3}", named) and sum(c.isdigit() for c in named) < 2 and not _PRINTED.search(fold_text(named)):
                    out.append((begin, stop + 1, "bracket", 1 if _noisy(note_form(named)) else 0, named))
            continue
        tail = _ENDS.match(text, stop) or (_ENDS.match(text, stop - 1) if text[stop - 1] == "." else None)
        if not tail:
            dead = stop
            continue
        end, named, honor, mark = tail.end(), text[at : tail.start()], m.group("honor"), m.group("mark")
        if honor and not m.group("article") and not honor.endswith(".") and fold_text(honor).startswith(("senor", "senhor")) and not _upper(named):
            continue  # an address, not a label
        if honor and honor[0].islower() and not m.group("article") and not mark:
            continue
        if len(re.findall(r"[^\W\d_]", named)) < (1 if honor else 3):
            continue
        # Words that aren't all capitals, numbers or dates follow on the same line, or on the next if that ends here.
        blank = _BLANKS.match(text, end).end()
        if _PAGE_LINE.match(text, blank):
            continue
        first = line_end(blank)
        if first == blank:
            first = text.find("\n", _LINE_ENDS.match(text, blank).end())
        if small(blank) >= (first if first >= 0 else len(text)):
            continue
        sure = 2
        if not (honor or (mark and mark.strip() in (">>", "*", "**")) or (tail.group("paren") and mark)):
            # A bare name needs capitals on one line, and a comma before the given name if only a dash follows.
            plain = _upper(named) and "\n" not in named and not re.search(r"[^\W_]{2}\.\s", named + " ")
            dash = ":" not in tail.group("end") and not tail.group("end").startswith(".")
            if _PRINTED.search(fold_text(named)):
                continue
            if not plain or dash and "," not in named:
                # Left to the roster: a line of its own that opens with a name of several parts.
                if text[begin - 1 : begin] not in ("", "\n") and text[begin - 2 : begin] != "\n " or len(named.split()) < 2 or any(c.isdigit() for c in named) or "\n" in named:
                    continue
                sure = 0
        out.append((begin, end, "label", sure, text[begin:end]))
    return out


def candidates(text: str | None) -> list[Candidate]:
    """(start, end, kind, sure, evidence) of everything that may not be speech, in order, without overlaps.

    Kinds are those of ``pieces`` and ``bracket`` (a name or a note in square brackets). ``sure``: 2 decided by
    the text alone, 1 a note by its words, 0 left to the corpus: remarks in brackets to their form's other uses,
    labels to the roster. ``evidence`` is the form of a note or the text of a label; a note that isn't set off
    from the sentence has its form prefixed by a blank. Decomposed letters are read as composed ones; offsets are
    those of the text as it is. Time is linear in the text.
    """
    if not text:
        return []
    text, offsets = composed(text)
    found = _candidates(text)
    return found if offsets is None else [(offsets[a], offsets[b], *rest) for a, b, *rest in found]


def _candidates(text: str) -> list[Candidate]:
    taken: list[Candidate] = [(m.start(), m.end(), "timestamp", 2, None) for m in _STAMP.finditer(text)]
    labels = _labels(text) if any(c in text for c in ":-–—[") else []
    layer: list[Candidate] = [x for x in labels if x[2] == "bracket"]
    taken = sorted(taken + _free(layer, taken))
    if any(c in text for c in "([{<*"):
        layer = []
        for m in _BRACKETED.finditer(text):
            kind = m.lastindex - 1
            inside = m.group(kind + 1)
            form = note_form(inside)
            if inside.endswith(":") or not re.search(r"[a-z]{3}", form) or re.search(r"\d\D?\d", inside):
                continue
            k = m.start() - 1
            while k >= 0 and text[k].isspace():
                k -= 1
            set_off = k < 0 or text[k] in _SETS_OFF
            # Braces, angles and stars hold nothing but recorder's notes.
            layer.append((m.start(), m.end(), "sound", 2 if kind in (2, 3, 4) else int(set_off and _noisy(form)), form if set_off else " " + form))
        taken = sorted(taken + _free(layer, taken))
    taken = sorted(taken + _free([x for x in labels if x[2] == "label" and x[3] == 2], [x for x in taken if x[2] != "sound" or x[3]]))
    taken = sorted(taken + _free([x for x in labels if x[2] == "label" and x[3] == 0], taken))
    fillers = [(*m.span("all"), "filler", 2, None) for m in _FILLER.finditer(text)]
    return sorted(taken + _free(fillers, [x for x in taken if x[3] or x[2] == "bracket"]))


def pieces(text: str | None, notes: dict[str, bool] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every piece that isn't speech, in order, without overlaps.

    Offsets count code points. Kinds: ``timestamp``, ``sound``, ``label``, ``filler``. Null and empty
    texts have none. ``notes`` says of the forms that recur in the corpus whether they are notes; a remark
    of another form is one if it is set off and begins with a noise. "(risas aparte)" within a sentence
    stays speech, and so do spoken times, "este" or "digamos" inside a sentence, and "Señor presidente:".
    """
    out = []
    for a, b, kind, sure, evidence in candidates(text):
        if kind == "bracket":
            kind = "sound" if (notes or {}).get(note_form(evidence), sure == 1) else "label"
        elif kind == "sound" and sure < 2:
            if not (notes or {}).get(evidence.strip(), sure == 1):
                continue
        elif sure < 2:
            continue
        out.append((a, b, kind))
    return out


_COMMA = re.compile(r"\s*,")


def strip_pieces(text: str | None, found: list[tuple[int, int, str]] | None = None) -> str | None:
    """The text without its pieces: commas that set off a filler go with it, blanks are closed up."""
    if not text:
        return text
    out, at = [], 0
    for a, b, kind in pieces(text) if found is None else found:
        left = text[at:a]
        if kind == "filler":
            rest = _COMMA.match(text, b)
            if rest and (left.rstrip().endswith(",") or not left.strip() or left.rstrip()[-1] in ".!?…)]}>*#" or left.rstrip(" \t")[-1:] == "\n"):
                b = rest.end()
            elif left.rstrip().endswith(","):
                left = left.rstrip()[:-1]
            if left.rstrip().endswith(",") and rest:
                left = left.rstrip()[:-1]
        out.append(left)
        at = b
    out.append(text[at:])
    joined = re.sub(r"[ \t]{2,}", " ", " ".join(x.strip(" ") for x in out if x.strip(" ")))
    return re.sub(r" +([,.;:!?])", r"\1", joined).strip()
