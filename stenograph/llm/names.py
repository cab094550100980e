"""Problem 2: variant spellings of names typed by people, linked by an exact radius join in metric space."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import table
from .terms import fold_text

#: Pivots of the metric partitioning: the square root of the number of points, at most this many. It bounds the
#: array each name is compared with; cells are split further by rings, so a cell needn't stay small.
MOST_PIVOTS = 1024

# --- fixed values: usual pet names and short forms of Spanish and Portuguese given names, folded ---
PET_NAMES = {
    "abel": "abelardo", "ale": "alejandro alejandra", "alex": "alejandro alejandra alexandre", "alvarito": "alvaro", "andresito": "andres",
    "ba": "barbara", "beto": "alberto roberto humberto", "bea": "beatriz", "bia": "beatriz", "berto": "alberto roberto", "bel": "isabel", "betty": "beatriz",
    "bento": "benedito", "cacho": "carlos", "carlitos": "carlos", "carlinhos": "carlos", "cata": "catalina catarina",
    "cesinha": "cesar", "chabela": "isabel", "chago": "santiago", "charo": "rosario", "chayo": "rosario", "chela": "graciela", "chelo": "consuelo",
    "chema": "jose", "chente": "vicente", "chepe": "jose", "chico": "francisco", "chica": "francisca", "chiqui": "francisca", "chuy": "jesus", "chucho": "jesus",
    "cida": "aparecida", "cidinha": "aparecida", "concha": "concepcion conceicao", "conchi": "concepcion", "conchita": "concepcion", "cuca": "refugio", "curro": "francisco",
    "dani": "daniel daniela", "dudu": "eduardo", "duda": "eduardo eduarda", "edu": "eduardo", "fati": "fatima", "fede": "federico", "fefo": "federico", "fer": "fernando fernanda",
    "fina": "josefa", "fito": "adolfo rodolfo", "fran": "francisco francisca", "gabi": "gabriel gabriela", "gonza": "gonzalo", "gogo": "gregorio",
    "goyo": "gregorio", "graci": "graciela", "guille": "guillermo", "guto": "augusto", "gus": "gustavo", "helo": "heloisa", "henri": "henrique", "isa": "isabel", "isabelita": "isabel",
    "inesita": "ines", "jandro": "alejandro", "joaozinho": "joao", "jorgito": "jorge", "juancho": "juan", "juanito": "juan", "ju": "julia juliana", "juju": "julia",
    "kike": "enrique", "kiko": "francisco", "lalo": "eduardo gonzalo", "lena": "elena helena magdalena", "leninha": "helena", "leo": "leonor leonardo leopoldo",
    "lola": "dolores", "lolita": "dolores", "loles": "dolores", "loli": "dolores", "lucho": "luis", "luchi": "lucia", "lucy": "lucia", "luci": "lucia", "luisinho": "luis", "lula": "luis",
    "luisito": "luis", "lupe": "guadalupe", "lupita": "guadalupe", "maite": "maria", "malena": "magdalena", "mane": "manuel", "manel": "manuel", "manolo": "manuel",
    "manu": "manuel manuela", "manolito": "manuel", "maneco": "manuel", "marita": "maria", "mari": "maria", "maruja": "maria", "mariquita": "maria", "martita": "marta", "martinha": "marta", "meche": "mercedes",
    "memo": "guillermo", "merche": "mercedes", "merceditas": "mercedes", "moncho": "ramon", "monchi": "ramon", "monchito": "ramon", "nacho": "ignacio", "nachito": "ignacio", "nanda": "fernanda", "nando": "fernando",
    "nena": "elena", "neco": "manuel", "nela": "manuela", "nelo": "manuel", "nina": "catalina", "paca": "francisca", "paco": "francisco",
    "pancha": "francisca", "pancho": "francisco", "paquita": "francisca", "paquito": "francisco", "pepa": "josefa", "pepe": "jose", "pepita": "josefa", "pepito": "jose",
    "perico": "pedro", "pili": "pilar", "pilarin": "pilar", "pilarica": "pilar", "quico": "francisco", "quim": "joaquim", "quique": "enrique", "rafa": "rafael", "rafi": "rafael", "rafinha": "rafael", "rai": "raimundo", "rosi": "rosario",
    "rita": "margarita", "santi": "santiago", "sebas": "sebastian sebastiao", "teo": "teodoro", "tere": "teresa", "teresita": "teresa", "teresinha": "teresa",
    "tiao": "sebastiao", "tiaozinho": "sebastiao", "tino": "agustin", "tito": "alberto", "titi": "tiago", "tomasito": "tomas", "tomi": "tomas", "tonho": "antonio", "toni": "antonio", "tonico": "antonio", "toninho": "antonio", "tono": "antonio",
    "totonho": "antonio", "toya": "victoria", "tucho": "antonio", "vasquinho": "vasco", "vicen": "vicente", "vicentin": "vicente", "xico": "francisco", "ze": "jose", "zeca": "jose", "zezinho": "jose", "zefa": "josefa",
}
PET_NAMES = {k.replace("​", ""): set(v.split()) for k, v in PET_NAMES.items()}
#: Titles, offices and articles before a name, folded.
TITLES = set(
    "sr sra srta srs sras senor senora senorita senores senhor senhora senhores dip dep diputado diputada deputado deputada ministro ministra presidente presidenta "
    "vicepresidente vicepresidenta secretario secretaria senador senadora relator relatora don dona dr dra doctor doctora lic ing prof excmo excma exmo exma "
    "invitado invitada convidado convidada ciudadano ciudadana licenciado licenciada".split()
)
ARTICLES = {"el", "la", "los", "las", "o", "a", "os", "as"}
_TOKEN = re.compile(r"[^\W_]+(?:['’´][^\W_]+)*ª?\.?")
_MISREAD = str.maketrans("015|", "olsl")


def _tokens(text: str) -> list[str]:
    return [fold_text(t) for t in _TOKEN.findall(unicodedata.normalize("NFC", text))]  # a mark that stands alone would cut the word


def _strip_titles(tokens: list[str]) -> list[str]:
    """Drop leading titles and the articles before them; "A. Marbosque" keeps its initial."""
    k = 0
    while k < len(tokens):
        bare = tokens[k].rstrip(".")
        following = tokens[k + 1].rstrip(".") if k + 1 < len(tokens) else ""
        if bare in TITLES:
            k += 1
        elif bare in ARTICLES and not tokens[k].endswith(".") and following in TITLES:
            k += 1
        else:
            break
    return tokens[k:]


def name_part(raw: str | None) -> str:
    """What is left of a typed speaker when titles, party, brackets and end marks are taken off."""
    if not raw:
        return ""
    text = re.sub(r"^[^\W\d_]+(?:\s[^\W\d_]+)?:\s+(?=\S)", "", unicodedata.normalize("NFC", raw.strip()))
    outside = re.sub(r"[(\[][^)\]]*[)\]]?", " ", text)
    for candidate in (outside, " ".join(re.findall(r"[(\[]([^)\]]*)", text))):
        clean = re.sub(r"[\s:;.,—–\-]+$", "", re.sub(r"(?<=\w)\.(?=[\s:—–-]*$)", lambda m: "." if re.search(r"\b\w\.[\s:—–-]*$", candidate) else "", candidate)).strip()
        left, comma, right = clean.partition(",")
        kept = _strip_titles(_tokens(left))
        if [t for t in kept if len(t.rstrip(".")) > 2]:
            return " ".join(kept) + (", " + " ".join(_strip_titles(_tokens(right))) if comma else "")
    return ""


def readings(name: str, most_given: int = 4) -> list[tuple[list[str], str, str, bool]]:
    """(given tokens, surnames without blanks, initial of the second surname, only the first surname?).

    Each way to split the name into given names and surnames: given first, given last, given behind a
    comma; a last single letter may stand for the second surname; "de X" behind a surname may be a
    spouse's name. ``most_given``: given names of the person of the register who has most, so that no reading
    with more can fit. A surname has two letters or more.
    """
    out: list[tuple[list[str], str, str, bool]] = []

    def letters(tokens: list[str]) -> str:
        return "".join(t.rstrip(".").translate(_MISREAD) for t in tokens if t not in ("de", "da", "do", "dos", "das", "del", "y", "e") or len(tokens) == 1)

    def add(given: list[str], surname: list[str], only: bool = False) -> None:
        initial = ""
        if len(surname) > 1 and len(surname[-1].rstrip(".")) == 1:
            initial, surname = surname[-1][0], surname[:-1]
        joined = letters(surname)
        if len(joined) >= 2 and len(given) <= most_given:
            out.append((given, joined, initial, only))

    left, comma, right = name.partition(",")
    first = left.split()
    if comma:
        options = [(right.split(), first)]
    else:
        options = [(first[:k], first[k:]) for k in range(min(most_given + 1, len(first)))]
        options += [(first[-k:], first[:-k]) for k in range(1, most_given + 1) if len(first) > k]
    for given, surname in options:
        add(given, surname)
        if "de" in surname[1:-1]:
            at = surname.index("de", 1)
            add(given, surname[:at], True)
    return out


@lru_cache(maxsize=100_000)
def edits(a: str, b: str) -> int:
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def _subsequence(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


@lru_cache(maxsize=200_000)
def given_cost(typed: str, own: str) -> int | None:
    """Edits between one typed given name and one of the register; null if it is no form of it."""
    bare = typed.rstrip(".").translate(_MISREAD)
    if bare == own or not bare:
        return 0
    if bare in ("mª", "ma") and own == "maria":
        return 0
    if len(bare) == 1:
        return 0 if own[0] == bare else None
    if typed.endswith(".") and bare[0] == own[0] and len(bare) < len(own) and _subsequence(bare, own):
        return 0
    if own in PET_NAMES.get(bare, ()):
        return 0
    small = re.fullmatch(r"(\w{3,})(?:it[oa]|inh[oa]|ill[oa]|zinh[oa]|it[oa]s)", bare)
    if small and own.startswith(small.group(1)[:4]) and len(small.group(1)) >= 3:
        return 0
    most = 0 if len(bare) < 4 else 1 if len(bare) < 6 else 2
    d = edits(bare, own)
    if d <= most:
        return d
    if len(bare) >= 4 and any(own in full and edits(bare, pet) == 1 for pet, full in PET_NAMES.items() if len(pet) >= 4):
        return 1
    return None


def given_fit(typed: list[str], own: list[str]) -> int | None:
    """Least edits that make every typed given name a form of a different one of the register."""
    if not typed:
        return 0
    best: int | None = None
    if len(typed) <= len(own):
        def place(k: int, free: tuple[int, ...], cost: int) -> None:
            nonlocal best
            if k == len(typed):
                best = cost if best is None else min(best, cost)
                return
            for j in free:
                c = given_cost(typed[k], own[j])
                if c is not None:
                    place(k + 1, tuple(x for x in free if x != j), cost + c)

        place(0, tuple(range(len(own))), 0)
    if best is None and len(typed) > 1 or len(own) > 1 and best is None:
        joined = "".join(t.rstrip(".") for t in typed).translate(_MISREAD)
        for target in {"".join(own), *own}:
            if len(joined) >= 5 and edits(joined, target) <= 1:
                best = min(best if best is not None else 9, edits(joined, target))
    return best


def radius(name: Column) -> Column:
    """Edits allowed for a string of this length."""
    n = F.length(name)
    return F.when(n < 5, 0).when(n < 8, 1).when(n < 13, 2).when(n < 18, 3).otherwise(4)


def radius_join(queries: DataFrame, points: DataFrame, block: str, query: str, point: str, pivots: int | None = None) -> DataFrame:
    """Pairs (block, query, point, d) of equal block whose edit distance is within the query's radius.

    ``queries`` and ``points`` hold distinct values. Every point goes to the cell of its nearest pivot, and
    there to the ring of its distance from it. A query with radius r goes to each cell p that may hold a match, by
    the triangle inequality d(q, p) <= d(q, nearest pivot) + 2 r, and there to the rings
    |d(q, p) - d(x, p)| <= r that exist. So (block, cell, ring) is the join key: most pairs are never formed, and a
    busy cell is many keys. Pivots are drawn from the points by hash, so the same data give the same cells;
    their number follows that of the points and limits no result, which is exact. Queries longer or shorter than
    any point by more than their radius can't match and aren't compared. Nulls match nothing.
    """
    facts = points.where(F.col(point).isNotNull()).agg(F.approx_count_distinct(point).alias("n"), F.min(F.length(point)).alias("short"), F.max(F.length(point)).alias("long")).first()
    if not facts["n"]:
        return queries.select(block, query).join(points.select(block, point).limit(0), block).withColumn("d", F.lit(0))
    pivots = pivots or min(MOST_PIVOTS, max(8, math.isqrt(facts["n"])))
    drawn = [r[0] for r in points.select(point).where(F.col(point).isNotNull()).distinct().orderBy(F.xxhash64(point), point).limit(pivots).collect()]
    array = F.array(*[F.lit(p) for p in drawn])
    spread = lambda c: F.transform(array, lambda p, k: F.struct(F.levenshtein(c, p).alias("dp"), k.alias("cell")))
    cells = points.select(block, point).where(F.col(point).isNotNull()).withColumn("_n", F.array_min(spread(F.col(point)))).select(block, point, F.col("_n.cell").alias("_cell"), F.col("_n.dp").alias("_ring"))
    rings = cells.groupBy("_cell").agg(F.min("_ring").alias("_lo"), F.max("_ring").alias("_hi"))
    sent = (
        queries.select(block, query).withColumn("_r", radius(F.col(query)))
        .where((F.length(query) >= facts["short"] - F.col("_r")) & (F.length(query) <= facts["long"] + F.col("_r")))
        .withColumn("_all", spread(F.col(query)))
        .withColumn("_near", F.array_min("_all")["dp"])
        .withColumn("_to", F.explode(F.filter("_all", lambda s: s["dp"] <= F.col("_near") + 2 * F.col("_r"))))
        .select(block, query, "_r", F.col("_to.cell").alias("_cell"), F.col("_to.dp").alias("_dq"))
        .join(F.broadcast(rings), "_cell")  # one row per pivot
        .withColumn("_from", F.greatest(F.col("_dq") - F.col("_r"), "_lo")).withColumn("_until", F.least(F.col("_dq") + F.col("_r"), "_hi"))
        .where(F.col("_from") <= F.col("_until"))
        .withColumn("_ring", F.explode(F.sequence("_from", "_until")))
    )
    pairs = sent.join(cells, [block, "_cell", "_ring"]).where(F.abs(F.length(query) - F.length(point)) <= F.col("_r")).withColumn("d", F.levenshtein(query, point))
    return pairs.where(F.col("d") <= F.col("_r")).select(block, query, point, "d")


def persons(register: DataFrame) -> DataFrame:
    """(country, id_dep, given, form, kind): the surname strings of every person of the register."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for row in batch.to_pylist():
                given = " ".join(_tokens(row["first_name"] or ""))
                last = [t for t in _tokens(row["last_name"] or "") if t not in ("de", "da", "do", "dos", "das", "del", "la", "y", "e")]
                if not last:
                    continue
                second = last[1][0] if len(last) > 1 else ""
                forms = {("both", "".join(last)), ("first", last[0])} | ({("second", last[-1])} if len(last) > 1 else set())
                for kind, form in forms:
                    for c, v in zip(out, (row["country"], row["id_dep"], given, second, kind, form)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], names=["country", "id_dep", "given", "second", "kind", "form"])

    rows = register.select("country", "id_dep", "first_name", "last_name").where(F.col("id_dep").isNotNull()).distinct()
    return rows.mapInArrow(run, "country string, id_dep string, given string, second string, kind string, form string").distinct()


def link_names(typed: DataFrame, register: DataFrame) -> DataFrame:
    """(country, name, id_dep) for every typed name that fits exactly one person of its country.

    ``typed`` holds distinct (country, name). Each name is read in every way its tokens allow; the
    surname strings are matched by ``radius_join``; given names must all be forms of the person's. A
    person's cost is the least number of edits over the readings; the name is linked if one person has
    the lowest cost alone. A single surname fits everybody who bears it first or second. Names that
    fit nobody (offices, voices, people not in the register) or several persons are not linked.
    """

    names = register.where(F.col("id_dep").isNotNull()).agg(F.max(F.size(F.split(F.trim("first_name"), r"\s+"))).alias("given")).first()
    most_given = max(1, names["given"] or 1)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for country, name in zip(batch.column("country").to_pylist(), batch.column("name").to_pylist()):
                seen = set()
                for given, surname, initial, only in readings(name_part(name), most_given):
                    key = (" ".join(given), surname, initial, only)
                    if key not in seen:
                        seen.add(key)
                        for c, v in zip(out, (country, name, " ".join(given), surname, initial, only)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, [pa.string()] * 5 + [pa.bool_()])], names=["country", "name", "typed", "surname", "initial", "only"])

    spelled = materialize(typed.select("country", "name").mapInArrow(read, "country string, name string, typed string, surname string, initial string, only boolean"), "name-readings")
    people = materialize(persons(register), "name-forms")
    near = radius_join(spelled.select("country", "surname").distinct(), people.select("country", "form").distinct(), "country", "surname", "form")
    fits = spelled.join(near, ["country", "surname"]).join(people, ["country", "form"])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for r in batch.to_pylist():
                if r["initial"] and (r["kind"] != "first" or r["second"] != r["initial"]) or r["only"] and r["kind"] != "first":
                    continue
                cost = given_fit(r["typed"].split(), r["given"].split())
                if cost is not None:
                    for c, v in zip(out, (r["country"], r["name"], r["id_dep"], cost + r["d"])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.string(), pa.string(), pa.int32()))], names=["country", "name", "id_dep", "cost"])

    judged = fits.select("country", "name", "typed", "initial", "only", "id_dep", "given", "second", "kind", F.col("d").cast("int").alias("d")).mapInArrow(judge, "country string, name string, id_dep string, cost int")
    person = judged.groupBy("country", "name", "id_dep").agg(F.min("cost").alias("cost"))
    level = person.groupBy("country", "name", "cost").agg(F.count("*").alias("n"), F.min("id_dep").alias("id_dep"))
    best = level.groupBy("country", "name").agg(F.min(F.struct("cost", "n", "id_dep")).alias("b"))
    return best.where(F.col("b.n") == 1).select("country", "name", F.col("b.id_dep").alias("id_dep"))


def unlinked_rows(spark: SparkSession, folder: str) -> DataFrame:
    """id_int, country and typed name of rows without ``id_dep``."""
    rows = table(spark, folder, "interventions").where(F.col("id_dep").isNull())
    name = F.when(F.trim(F.col("speaker_name")) != "", F.col("speaker_name")).otherwise(F.col("speaker_raw"))
    return rows.select("id_int", "country", name.alias("name")).where(F.trim("name") != "")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without ``id_dep`` whose typed name settles the person."""
    rows = unlinked_rows(spark, folder)
    linked = link_names(rows.select("country", "name").distinct(), table(spark, folder, "deputies"))
    return rows.join(linked, ["country", "name"]).select("id_int", "id_dep").distinct()


QUERIES = {"p2_found": p2_found}
SQL: dict[str, str] = {}
