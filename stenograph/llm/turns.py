"""Problem 1: speech transcripts into clean speaker turns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import one_per_key, table
from .arrow import lists
from .names import edits, given_fit, name_part, persons
from .pieces import candidates, note_form, strip_pieces
from .terms import speech_rows


#: A remark's form is judged by its uses if it has this share of all remarks in brackets, and LEAST_USES; so at
#: most 1 / FORM_SHARE forms are judged, which bounds what is sent to executors. Others go by their words.
FORM_SHARE = 1 / 20_000
LEAST_USES = 5
#: Sittings a form or a name must come from to count as recurring.
LEAST_SITTINGS = 3
#: Share of a form's uses that must be set off from the sentence if it is a note.
SET_OFF = 0.9

_CANDIDATES = "id_session string, country string, id_int string, kind string, start_char bigint, end_char bigint, sure int, set_off boolean, form string, label string"


def doubtful_pieces(rows: DataFrame) -> DataFrame:
    """Everything that may not be speech of the turn, with what decides the doubtful ones; stored, copies once.

    ``rows``: id_session, country, id_int, text. One pass over the texts; only pieces go on from here.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for row, text in enumerate(batch.column("text").to_pylist()):
                for a, b, kind, sure, evidence in candidates(text):
                    label = evidence if kind in ("label", "bracket") else None
                    form = note_form(evidence) if kind == "bracket" else evidence if kind == "sound" else None
                    off = None if form is None else not form.startswith(" ")
                    for c, v in zip(out, (row, kind, a, b, sure, off, form and form.strip(), label)):
                        c.append(v)
            at = pa.array(out[0], pa.int64())
            own = [batch.column(c).take(at) for c in ("id_session", "country", "id_int")]
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(own + [pa.array(x, t) for x, t in zip(out[1:], types)], names=[f.split()[0] for f in _CANDIDATES.split(", ")])

    found = rows.select("id_session", "country", "id_int", "text").where(F.col("text").isNotNull()).mapInArrow(run, _CANDIDATES)
    return materialize(found.distinct(), "piece-candidates")


def note_forms(found: DataFrame) -> DataFrame:
    """(form, is_note) of the remarks in brackets that recur: notes stand between sentences in nearly all uses, and
    in several sittings; asides, references and places stand within them. At most 1 / FORM_SHARE rows."""
    uses = found.where(F.col("form").isNotNull())
    total = uses.count()
    per_sitting = uses.groupBy("form", "id_session").agg(F.count("*").alias("n"), F.count_if("set_off").alias("off"))
    forms = per_sitting.groupBy("form").agg(F.sum("n").alias("n"), F.sum("off").alias("off"), F.count("*").alias("sittings"))
    kept = forms.where((F.col("n") >= max(LEAST_USES, total * FORM_SHARE)) & (F.col("sittings") >= LEAST_SITTINGS))
    return kept.select("form", (F.col("off") >= F.col("n") * SET_OFF).alias("is_note"))


def marked_pieces(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(id_int, kind, start_char, end_char) of every piece that isn't speech of the turn.

    ``rows``: id_session, country, id_int, speaker_raw, id_dep, text. Stamps, fillers and what is plainly a label or
    a note are decided by the text; a remark in brackets by how its form is used in the whole corpus; a line that
    merely opens with a name, and a name in square brackets, by whether ``resolve_labels`` finds somebody in the
    roster whom it fits.
    One row per piece; null and empty texts give none; copies of a key give their pieces once.
    """
    found = doubtful_pieces(rows)
    asked = found.where(F.col("label").isNotNull())
    known = materialize(resolve_labels(asked.select("id_session", "country", "label").distinct(), register, typed_names(rows, plain_labels(found))).select("id_session", "label", F.lit(True).alias("resolved")), "piece-labels")
    doubtful = found.where((F.col("sure") < 2) & F.col("kind").isin("label", "bracket")).join(known.hint("merge"), ["id_session", "label"], "left")
    plain = found.where((F.col("sure") == 2) | (F.col("kind") == "sound")).withColumn("resolved", F.lit(False))
    judged = plain.unionByName(doubtful).join(F.broadcast(note_forms(found)), "form", "left")  # bounded by FORM_SHARE
    resolved, note = F.coalesce("resolved", F.lit(False)), F.coalesce("is_note", F.col("sure") == 1)
    kind = (
        F.when((F.col("kind") == "bracket") & resolved, "label")
        .when(F.col("kind") == "bracket", F.when(note, "sound").otherwise("label"))
        .when((F.col("sure") == 2) | (F.col("kind") == "sound") & note | (F.col("kind") == "label") & resolved, F.col("kind"))
    )
    return judged.select("id_int", kind.alias("kind"), "start_char", "end_char").where(F.col("kind").isNotNull())


_SECONDS = re.compile(r"(\d{1,2})\D(\d{2})(?:\D(\d{2}))?")


def _clock(stamp: str) -> int | None:
    m = _SECONDS.search(stamp)
    return int(m[1]) * 3600 + int(m[2]) * 60 + int(m[3] or 0) if m and int(m[1]) < 24 else None


_PIECE = "array<struct<a:int,b:int,kind:string,sure:int,set_off:boolean,form:string>>"
_SEGMENT = "id_session string, id_int string, row_order int, speaker_raw string, id_dep string, country string, segment int, label string, sure int, set_off boolean, form string"


def segments(rows: DataFrame) -> DataFrame:
    """Rows cut at everything that may be a label: (id_session, id_int, row_order, ..., segment, label, sure, form, text, pieces).

    ``label`` is null for what the row's own speaker says. A label that the corpus must confirm has ``sure`` below 2; one in
    square brackets has a ``form`` too, since it may be a note. ``text`` is the segment as it is, ``pieces`` what may
    not be speech in it. Texts are read here once; what the corpus says of them is applied by ``spoken``.
    """
    schema = f"{_SEGMENT}, text string, pieces {_PIECE}"
    keep = ["id_session", "id_int", "row_order", "speaker_raw", "id_dep", "country"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, labels, sures, offs, forms, texts, pieces = [], [], [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                number, begin, label, sure, form, inside = 0, 0, None, 2, None, []
                for a, b, kind, how, evidence in [*candidates(text), (len(text or ""), 0, "end", 0, None)]:
                    if kind not in ("label", "bracket", "end"):
                        off = evidence is not None and not evidence.startswith(" ")
                        inside.append((a - begin, b - begin, kind, how, off, evidence and evidence.strip()))
                        continue
                    if number or text and text[:a].strip():
                        for c, v in zip((at, numbers, labels, sures, offs, forms, texts, pieces), (row, number, label, sure, None if form is None else True, form, text[begin:a], inside)):
                            c.append(v)
                    number, begin, inside = number + 1, b, []
                    if kind != "end":
                        label, sure, form = text[a:b], how if kind == "label" else min(how, 1), note_form(evidence) if kind == "bracket" else None
            own = [batch.column(c).take(pa.array(at, pa.int64())) for c in keep]
            sizes, flat = [len(x) for x in pieces], [p for x in pieces for p in x]
            parts = [pa.array(c, f.type) for c, f in zip(zip(*flat) if flat else [[]] * 6, _arrow.field("pieces").type.value_type)]
            found = lists(pa.StructArray.from_arrays(parts, fields=list(_arrow.field("pieces").type.value_type)), sizes)
            rest = [pa.array(c, _arrow.field(n).type) for n, c in zip(("segment", "label", "sure", "set_off", "form", "text"), (numbers, labels, sures, offs, forms, texts))]
            yield pa.RecordBatch.from_arrays([*own, *rest, found], schema=_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    _arrow = to_arrow_schema(_parse_datatype_string(schema))
    return rows.select("id_session", "id_int", F.col("intervention_order").alias("row_order"), "speaker_raw", "id_dep", "country", "text").mapInArrow(run, schema)


def spoken(cut: DataFrame, notes: dict[str, bool]) -> DataFrame:
    """``segments`` with what isn't speech taken out: (..., label, sure, joined, text, clock); those left empty are dropped.

    ``notes``: the forms judged by ``note_forms``, a bounded set. ``joined`` marks a segment behind a note in square
    brackets, which goes on where the one before stopped. ``clock`` is its first stamp in seconds.
    """
    keep = ["id_session", "id_int", "row_order", "speaker_raw", "id_dep", "country", "segment"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, labels, sures, joins, texts, clocks = [], [], [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("label", "sure", "form", "text", "pieces")))
            for k, (label, sure, form, text, found) in enumerate(rows):
                inside = [(p["a"], p["b"], p["kind"]) for p in found if p["kind"] != "sound" or p["sure"] == 2 or notes.get(p["form"], p["sure"] == 1)]
                said = strip_pieces(text, inside)
                if said:
                    joined = form is not None and notes.get(form, sure == 1)
                    at.append(k)
                    labels.append(None if joined else label)
                    sures.append(2 if form is not None else sure)
                    joins.append(joined)
                    texts.append(said)
                    clocks.append(next((c for x, y, kind in inside if kind == "timestamp" and (c := _clock(text[x:y])) is not None), None))
            own = [batch.column(c).take(pa.array(at, pa.int64())) for c in keep]
            types = (pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays(own + [pa.array(x, t) for x, t in zip((labels, sures, joins, texts, clocks), types)], names=[*keep, "label", "sure", "joined", "text", "clock"])

    return cut.mapInArrow(run, _SEGMENT.split(", label")[0] + ", label string, sure int, joined boolean, text string, clock int")


def phonetic(name: str) -> str:
    """A key that spellings of a Spanish or Portuguese surname share: its consonant sounds."""
    s = "".join(c for c in name if c.isalpha())
    for pattern, sound in (
        (r"^h|(?<=[^c])h", ""), (r"ch", "x"), (r"nh|ñ", "n"), (r"lh|ll", "l"), (r"qu|k|c(?=[aouclrtnsm]|$)", "k"), (r"c|ç|z|s+", "s"), (r"g(?=[eiy])|j", "j"),
        (r"gu", "g"), (r"v|w|b", "b"), (r"ph", "f"), (r"y", "i"), (r"[aeiou]+", ""), (r"(.)\1+", r"\1"),
    ):
        s = re.sub(pattern, sound, s)
    return s


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost one-to-one assignment of rows to columns (Hungarian method with potentials)."""
    n, m = cost.shape
    if n > m:
        return [(i, j) for j, i in assign(cost.T)]
    u, v, match, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while match[j0]:
            used[j0] = True
            reduced = cost[match[j0] - 1] - u[match[j0]] - v[1:]
            better = ~used[1:] & (reduced < least[1:])
            least[1:][better] = reduced[better]
            way[1:][better] = j0
            j1 = 1 + int(np.argmin(np.where(used[1:], np.inf, least[1:])))
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return [(int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j]]


#: Cost of leaving a label unassigned, in edits.
UNKNOWN = 3.0
_LINKS = "country string, clean string, sound string"
_PEOPLE = "country string, person string, id_dep string, voice string, given string, forms array<string>, sound string"


def _tolerance(form: str) -> int:
    """Edits at which a token may still be a spelling of a surname of this length."""
    return 0 if len(form) < 4 else 1 if len(form) < 6 else 2


def label_cost(clean: str, given: str, forms: list[str]) -> float:
    """Edits between a label's name and a person: its tokens are surnames, given names, or 2.5 edits each."""
    tokens = clean.split()
    nearest = [min((edits(t.rstrip("."), f), f) for f in forms) for t in tokens]
    left = [t for t, (d, f) in zip(tokens, nearest) if d > _tolerance(f)]
    if len(left) == len(tokens):
        return 99.0
    close = sum(d for d, f in nearest if d <= _tolerance(f))
    fit = [t for t in left if len(t.rstrip(".")) <= 2 or given_fit([t], given.split()) is not None]
    return close + 2.5 * (len(left) - len(fit)) - 0.01 * len(forms)


def _clean_names(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``clean``, the folded name in ``column`` without titles, marks and commas; rows without one go."""
    kept = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", clean string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [name_part(x).replace(",", " ") or None for x in batch.column(column).to_pylist()]
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(clean, pa.string())], names=[*kept, "clean"])
            yield out.filter(pa.array([x is not None for x in clean], pa.bool_()))

    return rows.mapInArrow(run, schema)


def _heard(names: DataFrame) -> DataFrame:
    """(country, clean, sound): each distinct name once for each sound of its tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for country, clean in zip(batch.column("country").to_pylist(), batch.column("clean").to_pylist()):
                for sound in {phonetic(t.rstrip(".")) for t in clean.split() if len(t.rstrip(".")) > 1}:
                    for c, v in zip(out, (country, clean, sound)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], names=["country", "clean", "sound"])

    return names.mapInArrow(run, _LINKS)


def _costs(names: DataFrame, people: DataFrame) -> DataFrame:
    """(country, clean, person, id_dep, voice, cost) of distinct names and the people their tokens sound like."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost = [label_cost(r["clean"], r["given"], r["forms"]) for r in batch.to_pylist()]
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("country", "clean", "person", "id_dep", "voice")), pa.array(cost, pa.float64())], names=["country", "clean", "person", "id_dep", "voice", "cost"])
            yield out.filter(pa.array([c < UNKNOWN for c in cost], pa.bool_()))

    pairs = _heard(names).join(people, ["country", "sound"]).select("country", "clean", "person", "id_dep", "voice", "given", "forms").distinct()
    return pairs.mapInArrow(run, "country string, clean string, person string, id_dep string, voice string, cost double")


def _people_of_register(register: DataFrame) -> DataFrame:
    people = persons(register).where(F.col("kind") != "both").groupBy("country", "id_dep", "given").agg(F.sort_array(F.collect_set("form")).alias("forms"))  # two surnames a person
    return people.select("country", F.col("id_dep").alias("person"), "id_dep", F.lit(None).cast("string").alias("voice"), "given", "forms")


def _sounding(people: DataFrame) -> DataFrame:
    """People once for each sound of their surnames."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("forms").to_pylist()
            at = [(k, s) for k, f in enumerate(forms) for s in sorted({phonetic(x) for x in f})]
            rows = batch.take(pa.array([k for k, _ in at], pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([s for _, s in at], pa.string())], names=[*rows.schema.names, "sound"])

    return people.mapInArrow(run, _PEOPLE)


def plain_labels(found: DataFrame) -> DataFrame:
    """The labels that need no roster to be known as such, so that the roster can be gathered from them."""
    return found.where((F.col("kind") == "label") & (F.col("sure") == 2))


def typed_names(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(id_session, country, clean): every name typed for a speaker without id, or standing in a label, once a sitting."""
    typed = rows.where(F.col("id_dep").isNull() & (F.trim("speaker_raw") != "")).select("id_session", "country", F.col("speaker_raw").alias("raw"))
    named = labels.select("id_session", "country", F.col("label").alias("raw"))
    return _clean_names(typed.unionByName(named).distinct(), "raw").select("id_session", "country", "clean").distinct()


def roster(register: DataFrame, typed: DataFrame) -> DataFrame:
    """(country, person, id_dep, voice, given, forms): the register, and the speakers it lacks, from all transcripts.

    A name of two or more parts that recurs in LEAST_SITTINGS sittings and is no spelling of anybody in the register
    (``label_cost``) becomes a person of its own, known by ``voice``, the name. Its last two parts are its surnames.
    """
    known = _people_of_register(register)
    often = typed.groupBy("country", "clean").agg(F.countDistinct("id_session").alias("sittings")).where((F.col("sittings") >= LEAST_SITTINGS) & F.col("clean").contains(" "))
    often = materialize(often.select("country", "clean"), "roster-names")
    fits = _costs(often, _sounding(known)).select("country", "clean").distinct()
    parts = F.filter(F.split(F.regexp_replace("clean", r"\.", ""), " +"), lambda t: F.length(t) > 0)
    surnames = F.when(F.size("parts") > 2, F.slice("parts", -2, 2)).otherwise(F.slice("parts", -1, 1))
    given = F.array_join(F.slice("parts", 1, F.size("parts") - F.size("forms")), " ")
    guests = often.join(fits, ["country", "clean"], "left_anti").withColumn("parts", parts).where(F.size("parts") > 1).withColumn("forms", F.sort_array(F.array_distinct(surnames)))
    guests = guests.select("country", F.concat(F.lit("~"), "clean").alias("person"), F.lit(None).cast("string").alias("id_dep"), F.col("clean").alias("voice"), given.alias("given"), "forms")
    return known.unionByName(guests)


def resolve_labels(labels: DataFrame, register: DataFrame, typed: DataFrame | None = None) -> DataFrame:
    """(id_session, label, id_dep, voice) of labels that fit somebody of the roster, with the person assigned, if any.

    ``labels``: distinct (id_session, country, label). The roster is the register and, from ``typed``, the names that
    recur across transcripts (``roster``). Names meet persons by the sound of their surnames, and each distinct name
    is compared once however many sittings have it. Within a sitting the names are assigned to persons one to one
    so that the total of edits is least, a name being left alone where that is cheaper or where two persons fit it
    equally (both columns null then); what is left over goes to its one nearest person, so that two spellings of
    a person meet. Names that say less than a surname give no row. Names and persons that share no candidate are solved
    apart, so a group's matrix is as large as its confusable names, not as the sitting.
    """
    people = roster(register, typed) if typed is not None else _people_of_register(register)
    named = materialize(_clean_names(labels.select("id_session", "country", "label"), "label"), "label-names")
    costs = _costs(named.select("country", "clean").distinct(), _sounding(people))
    asked = named.select("id_session", "country", "clean").distinct().join(costs.hint("merge"), ["country", "clean"])

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for session, country, fits in zip(*(batch.column(c).to_pylist() for c in ("id_session", "country", "fits"))):
                edges: dict[str, dict[str, float]] = {}
                who: dict[str, tuple] = {}
                for f in fits:
                    edges.setdefault(f["clean"], {})[f["person"]] = f["cost"]
                    who[f["person"]] = (f["id_dep"], f["voice"])
                done = _assigned(edges)
                for n in sorted(edges):
                    for c, v in zip(out, (session, country, n, *who.get(done.get(n), (None, None)))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], names=["id_session", "country", "clean", "id_dep", "voice"])

    # A sitting's list holds its distinct names that sound like somebody, once for each such person.
    sittings = asked.groupBy("id_session", "country").agg(F.collect_list(F.struct("clean", "person", "id_dep", "voice", "cost")).alias("fits"))
    solved = sittings.mapInArrow(solve, "id_session string, country string, clean string, id_dep string, voice string")
    return named.join(solved.hint("merge"), ["id_session", "country", "clean"]).select("id_session", "label", "id_dep", "voice").distinct()


def _assigned(edges: dict[str, dict[str, float]]) -> dict[str, str]:
    """The person of each name that an optimal assignment, and then the nearest person for what is left, settles."""
    done: dict[str, str] = {}
    for names, people in _components(edges):
        cost = np.full((len(names), len(people) + len(names)), UNKNOWN)
        cost[:, : len(people)] = 99
        at = {p: j for j, p in enumerate(people)}
        for i, n in enumerate(names):
            for p, c in edges[n].items():
                cost[i, at[p]] = c
        for i, j in assign(cost):
            near = cost[i, : len(people)]
            if j >= len(people):
                j = int(np.argmin(near))
            if cost[i, j] < UNKNOWN and (np.abs(near - cost[i, j]) < 0.5).sum() == 1:
                done[names[i]] = people[j]
    return done


def _components(edges: dict[str, dict[str, float]]) -> Iterator[tuple[list[str], list[str]]]:
    """Names and persons that candidate pairs connect."""
    back: dict[str, list[str]] = {}
    for n, near in edges.items():
        for p in near:
            back.setdefault(p, []).append(n)
    seen: set[str] = set()
    for first in sorted(edges):
        if first in seen:
            continue
        names, people, todo = [], set(), [first]
        seen.add(first)
        while todo:
            n = todo.pop()
            names.append(n)
            for p in edges[n]:
                if p not in people:
                    people.add(p)
                    for other in back[p]:
                        if other not in seen:
                            seen.add(other)
                            todo.append(other)
        yield sorted(names), sorted(people)


#: Places of a sitting that are put in order by one task; a sitting of any length is many such slices.
SLICE = 4096


def clean_turns(rows: DataFrame, register: DataFrame) -> DataFrame:
    """(id_session, turn, id_dep, speaker, text, clock, n_segments): clean turns in sitting order.

    Segments are ordered by the row's place in the sitting, the last five digits of ``id_int``, then by segment.
    Rows whose id lacks the place come by their clock stamp, then by ``intervention_order``, which repeats and
    swaps. Stamps don't overrule a known place (README). ``clock`` is the last stamp heard when the turn begins, or the first in it. Successive
    segments of one speaker become one turn. A speaker is the row's ``id_dep``, else the person or voice of the
    roster its label is assigned to, else the typed name; a doubtful label the roster doesn't know is speech.
    Order, turn numbers and clocks are found within slices of a sitting and carried over between them. A null
    session or text gives no turn.
    """
    raw = materialize(segments(rows).where(F.col("id_session").isNotNull()), "turn-cuts")
    remarks = raw.select("id_session", F.explode("pieces").alias("p")).where(F.col("p.form").isNotNull()).select("id_session", "p.form", "p.set_off")
    forms = remarks.unionByName(raw.where(F.col("form").isNotNull()).select("id_session", "form", "set_off"))
    notes = {r["form"]: r["is_note"] for r in note_forms(forms).collect()}  # bounded by FORM_SHARE
    cut = materialize(spoken(raw, notes), "turn-segments").withColumn("said_by", F.coalesce("label", "speaker_raw"))
    facts = cut.drop("text")  # texts meet their turn numbers once, at the end
    typed = facts.where((F.col("label").isNotNull() | F.col("id_dep").isNull()) & F.col("said_by").isNotNull())
    names = typed_names(facts, facts.where(F.col("label").isNotNull() & (F.col("sure") == 2)))
    linked = resolve_labels(typed.select("id_session", "country", F.col("said_by").alias("label")).distinct(), register, names)
    who = facts.join(linked.withColumnsRenamed({"label": "said_by", "id_dep": "_d", "voice": "_v"}), ["id_session", "said_by"], "left")
    own = F.when(F.col("label").isNull(), F.col("id_dep"))
    spoken_by = F.coalesce(own, "_d", "_v", F.lower(F.trim("said_by")), F.lit("?"))
    restored = (F.col("sure") < 2) & F.col("_d").isNull() & F.col("_v").isNull()
    unknown = restored | F.col("joined")
    row_speaker = F.coalesce("id_dep", F.lower(F.trim("speaker_raw")), F.lit("?"))
    place = F.coalesce(F.expr("try_cast(right(id_int, 5) AS int)"), F.lit(1 << 20) + F.coalesce("clock", "row_order", F.lit(0)))
    at = F.struct(place.alias("place"), "row_order", "id_int", "segment")
    who = who.select(
        "id_session", at.alias("at"), F.floor(place / SLICE).alias("slice"), unknown.alias("unknown"), restored.alias("restored"), "joined", row_speaker.alias("row_speaker"), F.when(~unknown, spoken_by).alias("heard"),
        F.when(~unknown, F.coalesce(own, "_d")).alias("person"), F.when(unknown, F.col("speaker_raw")).otherwise(F.coalesce("_v", "said_by")).alias("said_by"), "clock", F.col("id_int").alias("_row"), F.col("id_dep").alias("_own"),
    )
    # What a doubtful label turned out to belong to: the segment before it in the row, else the row's own speaker.
    in_row = Window.partitionBy("id_session", "_row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    carried = lambda c: F.last(F.when(~F.col("unknown"), F.struct(F.col(c).alias("v"))), True).over(in_row)
    who = who.withColumn("speaker", F.coalesce(carried("heard")["v"], "row_speaker")).withColumn("_p", carried("person")).withColumn("person", F.when(F.col("_p").isNull(), F.col("_own")).otherwise(F.col("_p.v")))
    who = materialize(who.drop("_p", "_own", "heard", "row_speaker", "unknown", "_row"), "turn-speakers")

    order = Window.partitionBy("id_session", "slice").orderBy("at")
    runs = who.withColumn("change", F.when(F.lag("speaker").over(order) != F.col("speaker"), 1).otherwise(0)).withColumn("inner", F.sum("change").over(order)).withColumn("heard_at", F.last("clock", True).over(order))
    edge = runs.groupBy("id_session", "slice").agg(F.min_by("speaker", "at").alias("first"), F.max_by("speaker", "at").alias("last"), F.max("inner").alias("changes"), F.max_by("heard_at", "at").alias("left"))
    slices = Window.partitionBy("id_session").orderBy("slice")
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.when(F.lag("last").over(slices).eqNullSafe(F.col("first")), 0).otherwise(1)
    edge = edge.withColumn("opens", opens).withColumn("base", F.coalesce(F.sum(F.col("opens") + F.col("changes")).over(before), F.lit(0)) + F.col("opens")).withColumn("carry", F.last("left", True).over(before))
    numbered = runs.join(edge.select("id_session", "slice", "base", "carry"), ["id_session", "slice"]).withColumn("turn", F.col("base") + F.col("inner")).withColumn("clock", F.coalesce("heard_at", "carry"))
    placed = numbered.select("id_session", "turn", "at", "person", "said_by", "clock", "restored", "joined", F.col("at.id_int").alias("id_int"), F.col("at.segment").alias("segment"))
    whole = F.when(F.col("restored"), F.concat_ws(" ", "label", "text")).otherwise(F.col("text"))
    parts = cut.select("id_int", "segment", "label", "text").join(placed, ["id_int", "segment"]).withColumn("text", whole)
    turns = parts.groupBy("id_session", "turn").agg(
        F.first("person", True).alias("id_dep"),
        F.min_by("said_by", "at").alias("speaker"),
        F.array_sort(F.collect_list(F.struct("at", "text"))).alias("parts"),  # what one speaker says without a break: the row that is asked for
        F.min_by("clock", F.when(F.col("clock").isNotNull(), F.col("at"))).alias("clock"),
        F.count_if(~F.col("joined")).cast("int").alias("n_segments"),
    )
    return turns.select("id_session", "turn", "id_dep", "speaker", F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"), "clock", "n_segments")


_PIECE_COLUMNS = ["id_session", "country", "speaker_raw", "id_dep", "text"]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each piece in the text of a speech row that isn't speech of the turn."""
    return marked_pieces(speech_rows(spark, folder, _PIECE_COLUMNS), table(spark, folder, "deputies")).select("id_int", "kind", "start_char")


def p1_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The sittings as clean turns in order, each with its speaker."""
    rows = one_per_key(speech_rows(spark, folder, ["row_n", "intervention_order", *_PIECE_COLUMNS]), "id_int", "row_n", ["id_int", "intervention_order", *_PIECE_COLUMNS], payload=True)
    return clean_turns(rows, table(spark, folder, "deputies"))


QUERIES = {"p1_found": p1_found, "p1_turns": p1_turns}
SQL: dict[str, str] = {}
