"""Folding and tokens as Catalyst expressions.

Spark SQL has no Unicode normaliser, so decomposition is done by ``translate`` with a table derived
from the Unicode database at import: every letter whose canonical decomposition is one base
character plus combining marks maps to its base; marks that stand alone are removed afterwards.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Token of a folded text.
WORD = r"[\p{L}\p{N}]+"
#: Token of an unfolded text: marks belong to the word.
MARKED_WORD = r"[\p{L}\p{N}\p{M}]+"


def _marks(begin: int, end: int) -> re.Pattern:
    """Runs of nonspacing marks within a range of code points."""
    codes = [c for c in range(begin, end) if unicodedata.category(chr(c)) == "Mn"]
    out, k = [], 0
    while k < len(codes):
        j = k
        while j + 1 < len(codes) and codes[j + 1] == codes[j] + 1:
            j += 1
        out.append(f"\\U{codes[k]:08x}-\\U{codes[j]:08x}")
        k = j + 1
    return re.compile(f"[{''.join(out)}]+")


@cache
def _mark_classes() -> tuple[re.Pattern, re.Pattern]:
    """Marks of the first plane and beyond: one range beyond it in a class would make every character slow."""
    return _marks(0, 0x10000), _marks(0x10000, sys.maxunicode + 1)


_FAR = re.compile("[\U00010000-\U0010ffff]")
_PYTHON_WORD = re.compile(r"[^\W_]+")


def fold_text(text: str) -> str:
    """Lower case, canonical decomposition, marks (Mn) removed; not trimmed."""
    low = text.lower()
    if low.isascii():
        return low
    near, far = _mark_classes()
    plain = near.sub("", unicodedata.normalize("NFD", low))
    return far.sub("", plain) if _FAR.search(plain) else plain


def fold_str(text: str) -> str:
    """``fold_text``, trimmed: the Python twin of ``fold``."""
    return fold_text(text).strip()


def word_list(text: str | None) -> list[str]:
    """The folded words of a text, in order: the Python twin of ``words``; null gives none."""
    return _PYTHON_WORD.findall(fold_text(text)) if text else []


@cache
def _bases() -> tuple[str, str]:
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        parts = unicodedata.normalize("NFD", char)
        if parts == char:
            continue
        base = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        if len(base) == 1:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


@cache
def folded_letters() -> dict[str, str]:
    """For each plain letter, the composed letters of either case that fold to it."""
    out: dict[str, str] = {}
    for char, base in zip(*_bases()):
        low = base.lower()
        if low.isascii() and low.isalpha() and ord(char) < 0x250:
            out[low] = out.get(low, "") + char
    return out


def fold(text: Column | str) -> Column:
    """Lower case, NFD, combining marks removed, trimmed."""
    source, target = _bases()
    column = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.translate(F.lower(column), source, target), r"\p{Mn}+", ""))


def words(text: Column | str) -> Column:
    """The folded words of a text, in order; null gives null."""
    return F.regexp_extract_all(fold(text), F.lit(WORD), F.lit(0))


def count_words(text: Column | str) -> Column:
    """Number of words of the unfolded text, marks included; null counts 0."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.size(F.regexp_extract_all(F.lower(column), F.lit(MARKED_WORD), F.lit(0))), F.lit(0))


def fold_map(text: str) -> tuple[str, list[int]]:
    """The folded text and, for each of its characters, the place in the text it comes from; one more for the end.

    Every character is folded with the marks behind it, so a match in the folded text can be cut from the text itself.
    """
    out, places = [], []
    for k, c in enumerate(text):
        plain = fold_text(c)
        out.append(plain)
        places += [k] * len(plain)
    return "".join(out), [*places, len(text)]


def slug(text: Column | str) -> Column:
    """A name for files: folded, runs of anything but letters and digits as one hyphen."""
    return F.regexp_replace(F.regexp_replace(fold(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def citation(speaker: Column, party: Column, country: Column, date: Column) -> Column:
    """A turn cited in short: "Ana Gil (PP), ES, 3/5/2014"; unknown parts are left out."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    named = F.concat(F.coalesce(filled(speaker), F.lit("?")), F.coalesce(F.concat(F.lit(" ("), filled(party), F.lit(")")), F.lit("")))
    day = F.concat_ws("/", F.day(date).cast("string"), F.month(date).cast("string"), F.year(date).cast("string"))
    return F.concat_ws(", ", named, filled(country), F.when(date.isNotNull(), day))


def display_name(name: Column) -> Column:
    """A speaker's name to show: "SURNAME, Given" turned round, capitals only at the beginning of words, particles small."""
    turned = F.regexp_replace(F.trim(F.regexp_replace(name, r"\s+", " ")), r"^([^,]+), (.+)$", "$2 $1")
    shown = F.initcap(F.lower(turned))
    for particle in ("De", "Del", "La", "Las", "Los", "Y", "Da", "Do", "Dos", "Das", "E"):
        shown = F.regexp_replace(shown, rf" {particle} ", f" {particle.lower()} ")
    return shown
