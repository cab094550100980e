"""Dates and numbers written out in Spanish and Portuguese, and rounding."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "janeiro": 1, "fevereiro": 2, "março": 3, "maio": 5, "junho": 6, "julho": 7, "setembro": 9, "outubro": 10, "novembro": 11, "dezembro": 12,
}
UNITS = {w: k for k, w in enumerate("cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte veintiuno veintidós veintitrés veinticuatro veinticinco veintiséis veintisiete veintiocho veintinueve".split())}
TENS = {w: 30 + 10 * k for k, w in enumerate("treinta cuarenta cincuenta sesenta setenta ochenta noventa".split())}
HUNDREDS = {"cien": 100, "ciento": 100, "doscientos": 200, "trescientos": 300, "cuatrocientos": 400, "quinientos": 500, "seiscientos": 600, "setecientos": 700, "ochocientos": 800, "novecientos": 900}


#: Every word of a Spanish cardinal below a million with its value.
CARDINALS = {**UNITS, **TENS, **HUNDREDS, "mil": 1000, "un": 1, "una": 1, "primero": 1}


def cardinal(text: str) -> int | None:
    """A Spanish cardinal in words; null if any word is unknown."""
    total = part = 0
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        if word == "y":
            continue
        value = UNITS.get(word, TENS.get(word, HUNDREDS.get(word, 1 if word in ("un", "una", "primero") else None)))
        if word == "mil":
            total, part = total + (part or 1) * 1000, 0
        elif value is None:
            return None
        else:
            part += value
    return total + part if text.strip() else None


def written_date(text: Column) -> Column:
    """The first date in a text: "3 de mayo de 2014", "3/5/2014", "2014-05-03"; two-digit years from 79 on are 19xx."""
    month = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    low = F.lower(text)
    long = r"(\d{1,2})[º°]?\s+de\s+(\p{L}+)\s+(?:de\s+|del\s+)?(\d{1,2}\.?\d{3}|\d{4})"
    slash = r"(?<!\d)(\d{1,2})[/.-](\d{1,2})[/.-](\d{4}|\d{2})(?!\d)"
    iso = r"(?<!\d)(\d{4})-(\d{2})-(\d{2})(?!\d)"
    part = lambda p, k: F.regexp_extract(low, p, k)
    number = lambda p, k: F.nullif(part(p, k), F.lit("")).try_cast("int")
    year2 = number(slash, 3)
    year = F.when(F.length(part(slash, 3)) == 4, year2).when(year2 >= 79, year2 + 1900).otherwise(year2 + 2000)
    make = lambda y, m, d: F.try_to_timestamp(F.format_string("%04d-%02d-%02d", y, m, d), F.lit("yyyy-MM-dd")).cast("date")
    guarded = lambda y, m, d: F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), make(y, m, d))
    words = guarded(F.nullif(F.regexp_replace(part(long, 3), r"\.", ""), F.lit("")).try_cast("int"), F.try_element_at(month, part(long, 2)), number(long, 1))
    return F.coalesce(words, guarded(number(iso, 1), number(iso, 2), number(iso, 3)), guarded(year, number(slash, 2), number(slash, 1)))


def any_date(text: Column) -> Column:
    """Every date in a text, in order, as an array: day or month first, in digits or words, two-digit years from 79 on 19xx.

    "3 de mayo de 2014", "mayo 3, 2014", "NOVIEMBRE 12 DEL 2007", "FEBRERO OCHO DE 1985", "veintiuno de febrero de
    1989", "septiembre 19/85", "3/5/2014", "2014-05-03", with a dot in the year's thousands.
    """
    words = [w for w, n in {**UNITS, "treinta": 30, "primero": 1}.items() if 1 <= n <= 31] + ["treinta y uno"]
    days = F.create_map(*[F.lit(x) for w in words for x in (w, 31 if w == "treinta y uno" else {**UNITS, "treinta": 30, "primero": 1}[w])])
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    month = "|".join(sorted(MONTHS, key=len, reverse=True))
    day = rf"\d{{1,2}}(?!\d)[º°ªo.]{{0,2}}|{'|'.join(sorted(words, key=len, reverse=True))}"
    year = r"[12]\.?\d{3}(?!\d)"
    low = F.lower(text)
    shapes = [
        rf"(?<![\p{{L}}\d])({day})\)?\s+(?:de\s+)?({month})(?:,?\s+del?)?,?\s+({year})",
        rf"(?<![\p{{L}}\d])({month})\s+({day})(?:\s*,|\s+del?)?\s+({year})",
        rf"(?<![\p{{L}}\d])({month})\s+(\d{{1,2}})\s*/\s*(\d{{2}})(?!\d)",
        r"(?<![\d/.-])(\d{1,2})[/.-](\d{1,2})[/.-](\d{4}|\d{2})(?!\d)",
        r"(?<!\d)(\d{4})-(\d{2})-(\d{2})(?!\d)",
    ]
    found = F.regexp_extract_all(low, F.lit("|".join(f"(?:{s.replace('(', '(?:').replace('(?:?', '(?')})" for s in shapes)), F.lit(0))
    number = lambda c: F.coalesce(F.nullif(F.regexp_replace(c, r"\D", ""), F.lit("")).try_cast("int"), F.try_element_at(days, c))

    def make(x: Column) -> Column:
        def part(k: int, g: int) -> Column:
            return F.regexp_extract(x, "^" + shapes[k], g)

        def whole(y: Column) -> Column:
            n = F.nullif(F.regexp_replace(y, r"\D", ""), F.lit("")).try_cast("int")
            return F.when(F.length(y) != 2, n).when(n >= 79, n + 1900).otherwise(n + 2000)

        options = [(part(0, 3), F.try_element_at(months, part(0, 2)), number(part(0, 1))), (part(1, 3), F.try_element_at(months, part(1, 1)), number(part(1, 2))), (part(2, 3), F.try_element_at(months, part(2, 1)), number(part(2, 2)))]
        options += [(part(3, 3), number(part(3, 2)), number(part(3, 1))), (part(4, 1), number(part(4, 2)), number(part(4, 3)))]
        made = [F.when(whole(y).isNotNull() & m.isNotNull() & d.isNotNull(), F.try_to_timestamp(F.format_string("%04d-%02d-%02d", whole(y), m, d), F.lit("yyyy-MM-dd")).cast("date")) for y, m, d in options]
        return F.coalesce(*made)

    return F.filter(F.transform(found, make), lambda d: d.isNotNull())


def weekday_agrees(text: Column, date: Column) -> Column:
    """Whether the first weekday named in a text is that of the date; null if none is named."""
    names = ["lunes|segunda", "martes|ter[çc]a", "mi[ée]rcoles|quarta", "jueves|quinta", "viernes|sexta", "s[áa]bado", "domingo"]
    first = F.lower(F.regexp_extract(text, rf"(?iu)(?<!\p{{L}})({'|'.join(names)})(?:-feira)?(?!\p{{L}})", 1))
    said = F.coalesce(*[F.when(first.rlike(f"^(?:{n})$"), F.lit(k)) for k, n in enumerate(names)])
    return said == F.weekday(date)


def event_window(date: Column, event: str, before: int, after: int) -> Column:
    """Whether a date lies from ``before`` days before an event to ``after`` days behind it, both included."""
    d = F.lit(event).cast("date")
    return date.between(F.date_sub(d, before), F.date_add(d, after))


def nearest_month(word: Column) -> Column:
    """The month a misspelt name of three letters or more means; null if it isn't clear.

    Names whose length differs by more than 3 aren't compared. The nearest month may be away by half the word's
    letters, 2 at least, and every other month must be 2 edits farther.
    """
    low = F.lower(word)
    near = [F.when(F.abs(F.length(low) - len(w)) <= 3, F.struct(F.levenshtein(low, F.lit(w)).alias("d"), F.lit(n).alias("m"))) for w, n in MONTHS.items()]
    best = F.array_sort(F.filter(F.array(*near), lambda x: x.isNotNull()))
    first = F.get(best, F.lit(0))
    second = F.get(F.filter(best, lambda x: x["m"] != first["m"]), F.lit(0))
    clear = (first["d"] <= F.greatest(F.lit(2), F.floor(F.length(low) / 2))) & (F.coalesce(second["d"], F.lit(99)) - first["d"] >= 2)
    return F.when((F.length(low) >= 3) & (clear | (first["d"] == 0)), first["m"])


def half_up(value: Column, digits: int) -> Column:
    """Rounding with halves upward, also below zero."""
    scale = F.lit(10.0**digits)
    return F.floor(value * scale + 0.5) / scale
