"""Parsing, matching, mentions, word networks and themes on small fixtures with results worked out by hand."""

from __future__ import annotations

import datetime as dt
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from stenograph.functions.dates import any_date, event_window, nearest_month, weekday_agrees
from stenograph.operators import lexicon, mentions, networks, parsing, quality, register, rosters, sequence, spotting, texts

D = dt.date


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- phrases ---
def test_trie_finds_all_and_longest():
    t = spotting.Trie([("maria pereira".split(), "long"), (["pereira"], "short"), (["pereira", "gil"], "other"), ([], "none")])
    tokens = "maria pereira gil y pereira".split()
    assert list(t.every(tokens)) == [(0, 2, "long"), (1, 2, "short"), (1, 3, "other"), (4, 5, "short")]
    assert list(t.longest(tokens)) == [(0, 2, "long"), (1, 3, "other"), (4, 5, "short")]


def test_presence_of_many_names_and_excluded_phrases(spark):
    t = spark.createDataFrame([("1", "La Río Negro S.A. y el río"), ("2", "provincia de Río Negro"), ("3", None)], "id_int string, text string")
    names = [("river", "río"), ("province", "rio negro")] + [(f"n{k}", f"nombre{k} apellido{k}") for k in range(500)]
    assert rows(networks.entity_presence(t, names)) == [("1", "province"), ("1", "river"), ("2", "province")]
    assert rows(networks.entity_presence(t, names, ["Río Negro S.A."])) == [("1", "river"), ("2", "province")]


def test_expressions_overlap(spark):
    t = spark.createDataFrame([("a b a b a",), (None,), ("Á, b!",)], "text string")
    assert rows(spotting.count_expressions(t, ["a b", "b a", "a b a", "x y"])) == sorted([("a b", 3), ("a b a", 2), ("b a", 2)], key=repr)


def test_concordance_keeps_neighbouring_hits(spark):
    t = spark.createDataFrame([("1", "el agua potable y otra\n agua potable sirve")], "id_int string, text string")
    assert rows(texts.concordance(t, "agua potable", 12)) == [("1", 1, "el ", "agua potable", " y otra agua"), ("1", 2, "able y otra ", "agua potable", " sirve")]


# --- graphs ---
def test_communities_are_connected_and_good():
    r = random.Random(11)
    edges = [(f"{g}{a:02}", f"{g}{b:02}", 1.0) for g in "abcd" for a, b in combinations(range(12), 2) if r.random() < 0.6]
    edges += [(f"{x}{r.randrange(12):02}", f"{y}{r.randrange(12):02}", 1.0) for x, y in combinations("abcd", 2) for _ in range(3)]
    g = networks.Graph(edges)
    for seed in range(5):
        label = g.communities(seed=seed)
        assert {frozenset(x[0] for x, k in label.items() if k == c) for c in set(label.values())} == {frozenset(c) for c in "abcd"}
        for c in set(label.values()):  # every community hangs together
            members = {x for x, k in label.items() if k == c}
            seen, todo = set(), [min(members)]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += [y for y in g.near[x] if y in members]
            assert seen == members
    path = networks.Graph([(f"p{k:03}", f"p{k + 1:03}", 1.0) for k in range(60)])
    assert path.modularity(path.communities()) > 0.7
    assert networks.Graph([]).communities() == {}


def test_page_rank_converges(spark):
    e = spark.createDataFrame([("a", "b", 2), ("b", "c", 1), ("c", "a", 1), ("a", "d", 1), ("d", "d2", 3)], "source string, target string, turns int")
    x = {r[0]: r[1] for r in networks.page_rank(e).collect()}
    y = {r[0]: r[1] for r in networks.page_rank(e, driver_edges=1, tolerance=1e-4).collect()}
    assert abs(sum(x.values()) - 1) < 1e-9 and all(abs(x[k] - y[k]) < 1e-3 for k in x)
    out = {"a": {"b": 2, "d": 1}, "b": {"c": 1}, "c": {"a": 1}, "d": {"d2": 3}, "d2": {}}
    for v in x:  # a fixed point
        got = 0.15 / 5 + 0.85 * x["d2"] / 5 + 0.85 * sum(x[u] * w[v] / sum(w.values()) for u, w in out.items() if v in w)
        assert abs(got - x[v]) < 1e-9


# --- words and themes ---
def seeded(n=300, seed=7):
    """Turns of four subjects of six words each, every second one about the first two: two themes must come out."""
    r = random.Random(seed)
    words = [[f"{t}{k}" for k in "abcdef"] for t in ("agua", "banco", "campo", "deuda")]
    out = []
    for k in range(n):
        topic = r.choice([0, 1]) if k % 2 == 0 else r.choice([2, 3])
        said = r.sample(words[topic], 4) + [r.choice(words[r.randrange(4)])] + ["que", "la", "de"] * 2 + [f"x{r.randrange(400)}"]
        r.shuffle(said)
        out.append((str(k), k % 2 == 0, "PQ"[topic % 2], " ".join(said)))
    return out


def test_word_network_and_themes(spark):
    docs = spark.createDataFrame(seeded(), "id_int string, own boolean, party string, text string")
    every = lexicon.tokens_of(docs, "id_int", "own", "party")
    own = every.where("own")
    stop = lexicon.function_words(every)
    assert rows(stop) == [("de",), ("la",), ("que",)]
    v = lexicon.lexicon(lexicon.word_sums(own), lexicon.word_sums(every), stop, limit=50)
    terms = {r["fold"] for r in v.collect()}
    assert terms == {f"{t}{k}" for t in ("agua", "banco") for k in "abcdef"}
    edges = lexicon.word_network(own, v)
    want_n = own.count()
    held = [set(r["w"]) & terms for r in own.collect()]
    for r in edges.collect():
        co, a, b = sum({r["a"], r["b"]} <= h for h in held), sum(r["a"] in h for h in held), sum(r["b"] in h for h in held)
        assert r["co"] == co and abs(r["expected"] - a * b / want_n) < 1e-3 and abs(r["weight"] - co / (a * b / want_n)) < 1e-3 and r["a"][:-1] == r["b"][:-1]
    themes = lexicon.word_themes(edges, v)
    groups = {}
    for r in themes.collect():
        groups.setdefault(r["theme"], set()).add(r["fold"][:-1])
    assert sorted(map(sorted, groups.values())) == [["agua"], ["banco"]] and set(groups) == {0, 1}
    shares = lexicon.theme_shares(own, themes)
    assert shares.where("dominant").count() == want_n and shares.groupBy("id_int").count().where("count > 2").count() == 0
    stats = {r["theme"]: r for r in lexicon.theme_statistics(shares, want_n, own.agg(F.sum(F.size("w"))).first()[0]).collect()}
    assert abs(sum(r["weight_pct"] for r in stats.values()) - 100) < 0.2
    parties = lexicon.theme_parties(shares.where("dominant"), docs)
    assert parties.count() == 2 and lexicon.concentrated(parties).count() == 2
    assert {r["verdict"] for r in lexicon.stability(edges, 3).collect()} == {"robust"}
    linked = edges.limit(1).unionByName(spark.createDataFrame([("aguaa", "bancoa", 5, 1.0, 20.0, 2.5)], edges.schema))
    assert [(r["edges"], r["weight"]) for r in lexicon.theme_links(linked, themes).collect()] == [(1, 2.5)]
    over = {(r["grp"], r["fold"][:-1]) for r in lexicon.group_words(every, docs.select("id_int", F.col("party").alias("grp"))).collect()}
    assert over == {("P", "agua"), ("P", "campo"), ("Q", "banco"), ("Q", "deuda")}
    assert lexicon.word_network(own.limit(0), v).count() == 0
    with pytest.raises(ValueError):
        lexicon.lexicon(lexicon.word_sums(own), lexicon.word_sums(every), limit=0)


def test_fragments_years_passages_and_anchors(spark):
    t = spark.createDataFrame([("1", "a b c d e")], "id_int string, text string")
    assert [r["w"] for r in lexicon.fragments(lexicon.tokens_of(t, "id_int"), 2).collect()] == [["a", "b"], ["c", "d"], ["e"]]
    shares = spark.createDataFrame([("1", 0, True), ("2", 0, False), ("3", 0, True)], "id_int string, theme int, dominant boolean")
    dated = spark.createDataFrame([("1", D(2020, 1, 1)), ("2", D(2020, 5, 1)), ("3", None)], "id_int string, date date")
    assert rows(lexicon.theme_years(shares, dated)) == [(0, 2020, 2, 1)]
    p = spark.createDataFrame([("1", "uno agua dos tres cuatro cinco agua Água fin"), ("2", None), ("3", "nada")], "id_int string, text string")
    assert rows(lexicon.passages(p, ["agua"], width=3, most=2)) == [("1", 1, 2, "agua Água fin"), ("1", 2, 1, "agua dos tres")]
    codes = spark.createDataFrame([("c", "1", "uno  agua"), ("c", "1", "UNO AGUA"), ("d", "1", "vino"), ("d", "9", "x")], "code string, id_int string, anchor string")
    assert sorted(r["status"] for r in lexicon.check_anchors(codes, p).collect()) == ["differs", "missing", "no turn", "verbatim"]


# --- mentions ---
MEMBERS = [
    ("BR", "D1", "EDUARDO SOUZA", None, None, "PT", "M", "57"), ("BR", "D2", "MARIA SOUZA", None, None, "PSD", "F", "57"), ("BR", "D3", "DR. LUIZ TAVARES", None, None, "PL", "M", "57"),
    ("BR", "D4", "LUIZ LIMA", None, None, "PL", "M", "57"), ("BR", "D5", "ZECA DA FEDERAL", None, None, "PP", "M", "57"), ("BR", "D6", "JOAO ANTIGO", None, None, "PT", "M", "56"),
]


@pytest.fixture(scope="module")
def gazetteer(spark):
    raw = [(n, *m, D(2023, 2, 1) if m[7] == "57" else D(2019, 2, 1), None) for n, m in enumerate(MEMBERS)]
    terms = spark.createDataFrame(raw, "reg_n bigint, country string, id_dep string, speaker_name string, first_name string, last_name string, party string, sex string, legislature string, start_date date, end_date date")
    common = spark.createDataFrame([("BR", w) for w in "o a de que disse falou isso discorda dele e concordo com algo escutem votou".split()], "country string, fold string")
    return mentions.gazetteers(register.close_open_terms(terms), common, others=[("Tibério", ["presidente Tibério"])])["BR"]


DAY = D(2024, 3, 10)


@pytest.mark.parametrize(
    "text,want",
    [
        ("o deputado joão antigo falou", []),  # not in office that day
        ("a deputada Souza discorda dele; o deputado Souza disse isso", [("D2", "reference"), ("D1", "reference")]),
        ("o deputado federal fulano falou", []),  # no nickname
        ("o deputado Luiz disse algo", []),  # a given name
        ("o deputado Tavares disse algo", [("D3", "reference")]),
        ("o deputado Tavares Nogueira disse", []),  # the name goes on
        ("Souza falou", []),  # a surname counts behind a title only
        ("o líder Souza, do PSD, votou", []),
        ("Obrigado, Deputado Luiz Lima. (O Sr. Luiz Lima deixa a cadeira.) Concordo com o deputado Luiz Lima.", [("D4", "address"), ("D4", "editorial"), ("D4", "reference")]),
        ("Deputada Maria Souza e deputado Luiz Lima, escutem.", [("D2", "address"), ("D4", "address")]),
        ("o presidente Tibério e o deputado Eduardo Souza", [("ext:Tibério", "reference"), ("D1", "reference")]),
        ("", []),
    ],
)
def test_mentions(gazetteer, text, want):
    assert [(m.target, m.kind) for m in gazetteer.find(text, DAY)] == want


def test_homonyms_are_told_apart_or_left(gazetteer):
    settle = lambda behind: gazetteer._settle("souza" + behind, mentions.Mention(0, 5, "souza", None, ["D1", "D2"]), DAY)
    assert settle(", dona maria, votou") == "D2" and settle(" (pt) votou") == "D1" and settle(" votou") is None


def test_mention_network(spark, gazetteer):
    said = [
        ("1", "D2", "O deputado Eduardo Souza mentiu. O deputado Eduardo Souza!"), ("2", "D4", "A deputada Maria Souza e o deputado Eduardo Souza saíram."), ("3", "D2", "Concordo com o deputado Luiz Lima."),
        ("4", "D1", "O presidente Tibério ouviu a deputada Maria Souza."), ("5", "D1", "Obrigado, deputado Luiz Lima. Eduardo Souza sou eu."), ("6", None, "A deputada Maria Souza."), ("7", "D1", None),
    ]
    t = spark.createDataFrame([(i, "BR", d, DAY, x) for i, d, x in said], "id_int string, country string, id_dep string, date date, text string")
    found = mentions.find_mentions(t, {"BR": gazetteer})
    assert {k: n for k, n in rows(found.groupBy("kind").count())} == {"reference": 8, "address": 1, "self": 1}
    edges = mentions.mention_network(found)
    assert rows(edges.select("source", "target", "turns", "back")) == [("D1", "D2", 1, 1), ("D1", "ext:Tibério", 1, 0), ("D2", "D1", 1, 1), ("D2", "D4", 1, 1), ("D4", "D1", 1, 0), ("D4", "D2", 1, 1)]
    assert rows(mentions.asymmetric(edges, 1).select("source", "target")) == [("D1", "ext:Tibério"), ("D4", "D1")]
    groups = spark.createDataFrame([("D1", "X"), ("D2", "X"), ("D4", "Y")], "id string, grp string")
    blocks = mentions.block_matrix(edges, groups)
    assert rows(blocks) == [("X", "X", 2, 66.67), ("X", "Y", 1, 33.33), ("Y", "X", 2, 100.0)] and abs(mentions.e_i_index(blocks) - 0.2) < 1e-9
    assert mentions.find_mentions(t.limit(0), {"BR": gazetteer}).count() == 0


def test_mentions_take_linear_time(gazetteer):
    import time

    began = time.perf_counter()
    assert len(gazetteer.find("Concordo com o deputado Luiz Lima. (nota) " * 20_000, DAY)) == 20_000
    assert time.perf_counter() - began < 20


# --- parsing ---
def test_tagged_blocks(spark):
    t = spark.createDataFrame(
        [
            (1, 'Cabecera de la sesión, bastante larga.<int speaker="PÉREZ">Pido la palabra ahora. [[p. 3]]</int><int speaker="GIL">No.</int>'),
            (2, "<int>Ana Gil (PS)</int> Muito obrigada, Sr. Presidente.<int>PSD</int> Muito bem, muito bem!<int>RuiSantos (PSD): — Não é verdade, senhores.</int> Nunca foi."),
            (3, None), (4, "nada"),
        ],
        "id int, text string",
    )
    assert rows(parsing.tagged_blocks(t)) == [
        ("1", 1, "PÉREZ", "", "Pido la palabra ahora."), ("2", 1, "Ana Gil", "PS", "Muito obrigada, Sr. Presidente."), ("2", 2, "Rui Santos", "PSD", "Não é verdade, senhores. Nunca foi."),
    ]
    assert [r["speaker_raw"] for r in parsing.tagged_blocks(t.where("id = 1"), gaps=True, least_chars=3).orderBy("place").collect()] == ["", "PÉREZ", "GIL"]


def test_scored_markers(spark):
    lines = ["El señor PÉREZ GIL (Ana): Sí.", "Ana Gil.— Pido la palabra.", "Ana Gil, le pido calma", "Fulano Mengano: Hola.", "minúscula: no"]
    df = spark.createDataFrame([("a", k, x) for k, x in enumerate(lines)], "id string, line int, text string")
    got = {r["line"]: (r["kind"], r["score"], r["name"]) for r in parsing.marker_scores(df, spark.createDataFrame([("gil",)], "fold string")).collect()}
    assert got == {0: ("strict", 1.0, "PÉREZ GIL"), 1: ("likely", 1.0, "Ana Gil"), 3: ("likely", 0.7, "Fulano Mengano")}


def test_embedded_turns(spark):
    long = "y esto lo digo con toda claridad"
    t = spark.createDataFrame(
        [("1", f"Hablo yo. El señor GIL SANZ: No, {long}. La señora TORO (Ana).— Sí, {long}."), ("2", f"Dijo: «Vale. El señor GIL: no, {long}»."), ("3", "Índice. El señor GIL: 4. El señor PAZ: 5. El señor TORO: 6."), ("4", None)],
        "id_int string, text string",
    )
    got = [(r["id_int"], r["part"], r["label"]) for r in parsing.embedded_turns(t).orderBy("id_int", "part").collect()]
    assert got == [("1", 0, None), ("1", 1, "El señor GIL SANZ:"), ("1", 2, "La señora TORO (Ana).—"), ("2", 0, None), ("3", 0, None)]


def test_session_headers(spark):
    head = "CONGRESO\nSesión extraordinaria núm. 012-B\nMadrid, miércoles 3 de mayo de 2014\nPresidente: Sr. Ana Gil Toro, abogada\nX Legislatura"
    t = spark.createDataFrame([("s_2014-05-04", head), ("a20150102", "Acta No. CUARENTA Y NUEVE.\nsin fecha"), ("z", None), ("late", "x\n" * 60 + "1 de enero de 2001\n" + "y\n" * 60)], "id string, text string")
    periods = spark.createDataFrame([(D(2010, 1, 1), None, "Nueva")], "since date, until date, name string")
    got = {r["id"]: r for r in parsing.session_header(t, periods=periods).collect()}
    a, b, z = got["s_2014-05-04"], got["a20150102"], got["z"]
    assert (a["date"], a["date_source"], a["date_mismatch"], a["session_number"], a["session_type"], a["president"], a["legislature"], a["missing"]) == (D(2014, 5, 3), "text", True, "12-B", "extraordinaria", "Ana Gil Toro", "Nueva", "")
    assert (b["date"], b["date_source"], b["session_number"]) == (D(2015, 1, 2), "id", "49") and z["date_source"] == "missing" and got["late"]["date"] is None


@pytest.mark.parametrize(
    "text,want",
    [
        ("Madrid, 3 de mayo de 2014", [D(2014, 5, 3)]), ("mayo 3, 2014 y NOVIEMBRE 12 DEL 2007", [D(2014, 5, 3), D(2007, 11, 12)]), ("FEBRERO OCHO DE 1985", [D(1985, 2, 8)]), ("VEINTIUNO DE FEBRERO DE 1989", [D(1989, 2, 21)]),
        ("septiembre 19/85", [D(1985, 9, 19)]), ("3/5/2014; 04-06-99; 2020-02-31", [D(2014, 5, 3), D(1999, 6, 4)]), ("1º de abril de 1.986", [D(1986, 4, 1)]), ("2014-05-03", [D(2014, 5, 3)]), ("nada", []), (None, None),
    ],
)
def test_any_date(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(any_date(F.col("t"))).first()[0] == want


def test_months_weekdays_and_events(spark):
    m = spark.createDataFrame([("septimere",), ("junlo",), ("ju",), ("abrilll",), ("mayo",), ("xxxxxxx",)], "t string")
    assert [r[0] for r in m.select(nearest_month(F.col("t"))).collect()] == [9, None, None, 4, 5, None]
    w = spark.createDataFrame([("martes 3", D(2024, 9, 3)), ("lunes 3", D(2024, 9, 3)), ("terça-feira", D(2024, 9, 3)), ("hoy", D(2024, 9, 3))], "t string, d date")
    assert [r[0] for r in w.select(weekday_agrees(F.col("t"), F.col("d"))).collect()] == [True, False, True, None]
    assert [r[0] for r in w.select(event_window(F.col("d"), "2024-09-01", 1, 2)).limit(1).collect()] == [True]


def test_roll_calls_and_attendance(spark):
    t = spark.createDataFrame([("1", "VOTACIÓN\nGil Sanz, Ana: sí; Toro, Luis: no; Paz, Eva María: abstención.\nPresentes\n65\nAusentes: 3"), ("2", "nada"), ("3", None)], "id_int string, text string")
    assert [(r["place"], r["name"], r["vote"]) for r in parsing.roll_calls(t).orderBy("place").collect()] == [(1, "Gil Sanz, Ana", "yes"), (2, "Toro, Luis", "no"), (3, "Paz, Eva María", "abstained")]
    assert rows(parsing.attendance(t)) == [("1", 65, 3)]


def test_shapes_and_read_documents(spark):
    t = spark.createDataFrame([("s", "1", "El Sr. GIL: uno\nEl Sr. PAZ: dos\nEl Sr. TORO: tres\nArtículo 1. a\nArtículo 2. b\ntexto\n3) c\nfin")], "id_session string, id_int string, text string")
    assert rows(parsing.line_shapes(t))[0][1:] == (3, 1)
    assert rows(parsing.read_documents(t, 3)) == [("1", 1, 3, 6, 3)]


def test_narrated_turns_and_fronts(spark):
    t = spark.createDataFrame([("s", "1", "ACTA de la sesión. El señor GIL: Buenas tardes, señorías. Luego dijo el señor Gil Sanz: «no hay fondos» y respondió la diputada Ana de Toro: «los hay»."), ("s", "2", None), ("t", "3", "El señor GIL: Hola.")], "id_session string, id_int string, text string")
    assert [(r["place"], r["speaker"], r["text"]) for r in parsing.narrated_turns(t).orderBy("place").collect()] == [(1, "Gil Sanz", "no hay fondos"), (2, "Ana de Toro", "los hay")]
    assert [(r["id_session"], r["part"], r["text"][:12]) for r in parsing.front_of_sittings(t).orderBy("id_session", "part").collect()] == [("s", 0, "ACTA de la s"), ("s", 1, ". El señor G"), ("t", 1, "El señor GIL")]
    p = spark.createDataFrame([("el honorable representante Luis Gil Sanz, del partido X",), ("La diputada Ana de la Torre",), ("nadie",)], "p string")
    assert [r[0] for r in p.select(parsing.narrated_name(F.col("p"))).collect()] == ["Luis Gil Sanz", "Ana de la Torre", None]


def test_whole_texts_names_and_citations(spark, tmp_path):
    from stenograph.functions import text

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "acta.1.txt").write_text("uno\ndos")
    assert rows(parsing.read_texts(spark, f"file://{tmp_path}/in")) == [("acta.1", "uno\ndos")]
    folded, at = text.fold_map("Ñandú áé")
    assert folded == "nandu ae" and at[0] == 0 and at[-1] == 8 and "Ñandú áé"[at[6] : at[8]] == "áé"
    c = spark.createDataFrame([("Ana Gil", "PP", "ES", D(2014, 5, 3)), (None, " ", "ES", None)], "s string, p string, c string, d date").select(text.citation(*[F.col(x) for x in "spcd"]))
    assert [r[0] for r in c.collect()] == ["Ana Gil (PP), ES, 3/5/2014", "?, ES"]
    n = spark.createDataFrame([("GIL DE LA TORRE, Ana  María",), ("josé de souza e silva",)], "n string").select(text.display_name(F.col("n")), text.slug("n"))
    assert [tuple(r) for r in n.collect()] == [("Ana María Gil de la Torre", "gil-de-la-torre-ana-maria"), ("José de Souza e Silva", "jose-de-souza-e-silva")]


def test_sex_by_falling_authority_and_reviews(spark):
    reg = [("a", "Ana Gil", "F", None), ("b", "Eva Paz", None, "sexo: F"), ("c", "Ana Toro", None, None), ("d", "Luis Sanz", "M", None), ("e", "Luis Rey", "M", None), ("f", "Luis Sá", None, None), ("g", "Pedro Roa", None, None), ("h", "Noel X", None, None), ("i", "Zoe Y", "M", None)]
    register_ = spark.createDataFrame(reg, "id_dep string, speaker_name string, sex string, notes string")
    turns = spark.createDataFrame([("c", "La Sra. TORO"), ("h", "PAZ")], "id_dep string, speaker_raw string")
    got = {r["id_dep"]: (r["sex"], r["sex_source"]) for r in register.sex_cascade(turns, register_, spark.createDataFrame([("i", "F")], "id_dep string, sex string")).collect()}
    assert got == {"a": ("F", "register"), "b": ("F", "note"), "c": ("F", "honorific"), "d": ("M", "register"), "e": ("M", "register"), "f": ("M", "name"), "g": ("M", "ending"), "h": (None, None), "i": ("F", "manual")}
    sheet = spark.createDataFrame([("a", "M", "manual"), ("b", "M", "machine"), ("c", "F", "manual"), ("c", "M", "manual")], "id_dep string, sex string, source string")
    assert {r["id_dep"]: r["sex"] for r in register.apply_review(register_.select("id_dep", "sex"), sheet, "id_dep", "sex").where("id_dep in ('a', 'b', 'c')").collect()} == {"a": "M", "b": None, "c": None}


# --- matching ---
def test_match_cascade_and_presence(spark):
    r = spark.createDataFrame([("1", "s", "X", None), ("2", "s", "Y", " "), ("3", "t", "X", "own"), ("4", "t", "Z", "nan"), ("5", None, "X", None)], "id_int string, id_session string, speaker_raw string, id_dep string")
    m = spark.createDataFrame([("s", "X", "p"), ("t", "X", "q"), ("s", "Y", "u"), ("s", "Y", "v"), ("t", "Y", "u"), ("t", "Z", None)], "id_session string, speaker_raw string, id_dep string")
    got = rosters.match_cascade(r, m, [["id_session", "speaker_raw"], ["speaker_raw"]])
    assert rows(got.select("id_int", "id_dep", "match_level")) == [("1", "p", 1), ("2", None, None), ("3", "own", 0), ("4", None, None), ("5", None, None)]
    p = spark.createDataFrame([("s", "p", "Ana Gil Sanz"), ("s", "q", "Luis Gil Sanz"), ("s", "u", "Toro Paz"), ("t", "p", "Gil Sanz")], "id_session string, id_dep string, name string")
    t = spark.createDataFrame([("1", "s", "El Sr. LUIS GIL SANZ", None), ("2", "s", "La señora GIL SANZ", None), ("3", "s", "Dip. Eva Toro Paz (X)", None), ("4", "t", "GIL SANZ", None), ("5", "t", "GIL SANZ", "p"), ("6", "s", None, None)], r.schema.simpleString()[7:-1].replace(":", " ").replace("id_session", "id_session"))
    assert rows(rosters.match_present(t, p)) == [("1", "q"), ("3", "u"), ("4", "p")]
    assert rows(rosters.match_rate(t.withColumn("g", F.lit("x")), "g")) == [("x", 6, 5, 1, 20.0)]


def test_exact_names_in_office_and_mended_names(spark):
    reg = spark.createDataFrame([("ES", "p", "Ana Gil Sanz", "Gil Sorguren", D(2010, 1, 1), D(2014, 1, 1)), ("ES", "q", "Luis Toro", "Toro Paz", D(2010, 1, 1), None), ("ES", "u", "LUIS TORO", "Toro", D(2015, 1, 1), None), ("PT", "v", "Luis Toro", "Toro", D(2010, 1, 1), None)], "country string, id_dep string, speaker_name string, last_name string, start_date date, end_date date")
    t = spark.createDataFrame([("1", "ES", D(2012, 1, 1), "La Sra. ANA GIL SANZ (X)", None), ("2", "ES", D(2015, 1, 1), "Ana Gil Sanz", None), ("3", "ES", D(2012, 1, 1), "LUIS TORO", None), ("4", "ES", D(2016, 1, 1), "LUIS TORO", None), ("5", "ES", None, "LUIS TORO", None), ("6", "PT", D(2016, 1, 1), "Luis Toro", "x"), ("7", "ES", D(2012, 1, 1), None, None)], "id_int string, country string, date date, speaker_raw string, id_dep string")
    assert rows(rosters.match_names(t, reg)) == [("1", "p"), ("3", "q")]
    m = spark.createDataFrame([("ES", "SRA. SORG UREN:"), ("ES", "Toro Paz"), ("PT", "SORG UREN"), ("ES", None)], "country string, speaker_raw string")
    assert rows(rosters.mend_names(m, reg)) == [("ES", "SRA. SORG UREN:", "SRA. SORGUREN:")]


def test_trimmed_networks_types_and_dossiers(spark):
    e = spark.createDataFrame([("a", "b", 5), ("b", "c", 4), ("c", "d", 1)], "a string, b string, co int")
    assert rows(networks.trim_nodes(e, "co", 3).select("a", "b")) == [("a", "b"), ("b", "c")] and networks.trim_nodes(e, "co", 0).count() == 0
    w = spark.createDataFrame([("agua",), ("de",), ("la",), ("12",), ("tres",), ("ab",)], "w string").select(lexicon.term_type(F.col("w"), ["de", "la"], ["de"], ["tres"]))
    assert [r[0] for r in w.collect()] == ["content", "connector", "cut", "cut", "cut", "cut"]
    themes = spark.createDataFrame([(0, "agua", 1.0), (0, "rio", 3.0), (None, "x", 0.0)], "theme int, fold string, inner double")
    stats = spark.createDataFrame([(0, 7)], "theme int, turns int")
    reading = spark.createDataFrame([(0, "t2", 2), (0, "t1", 1)], "theme int, id_int string, place int")
    quotes = spark.createDataFrame([("t1", 1, "el agua"), ("t1", 2, "otra"), ("t2", 1, "el río")], "id_int string, place int, passage string")
    assert [(r["label"], r["turns"], r["read"], r["said"]) for r in lexicon.dossier(themes, stats, reading, quotes.withColumnRenamed("place", "p").withColumnRenamed("p", "place")).collect()] == [("rio · agua", 7, ["t1", "t2"], "el agua")]


def test_standardize(spark):
    raw = [("s1", "i1", "012", "2020-01-02", "Ordinaria", "Mujer", "ana gil", "PP", "p", "56", "2", "1", "hola"), ("s1", "i2", "12.0", "02/01/2020", " ", "H", None, None, "q", None, "1", "x", "hola"), ("s2", "i3", "7-b", "2020-01-09", "EXTRAORDINÁRIA", "?", None, None, None, None, "1", "0", None)]
    df = spark.createDataFrame(raw, "id_session string, id_int string, numero string, date string, session_type string, sex string, speaker_name string, party string, id_dep string, legislature string, intervention_order string, dm_speech string, text string")
    out = rosters.standardize(df, {"session_number": ["n", "numero"]}, "ES")
    got = {r["id_int"]: r for r in out.collect()}
    assert [got[i]["session_number"] for i in ("i1", "i2", "i3")] == ["12", "12", "7-B"] and [got[i]["sex"] for i in ("i1", "i2", "i3")] == ["F", "M", None]
    assert [got[i]["legislature"] for i in ("i1", "i2", "i3")] == ["56", "56", "56"] and [got[i]["new_order"] for i in ("i1", "i2", "i3")] == [2, 1, 1]
    assert got["i2"]["date"] is None and got["i1"]["speaker_name"] == "ANA GIL" and got["i3"]["session_type"] == "extraordinaria" and got["i2"]["dm_speech"] is None
    with pytest.raises(rosters.EmptyRegister):
        rosters.standardize(df.withColumn("party", F.lit(None).cast("string")).withColumn("speaker_name", F.lit("")), {}, "ES")


def test_names_notes_and_presidency(spark):
    n = spark.createDataFrame([("Gil Sanz,  Ana",), ("Ana Gil",), ("Ana Gil Sanz",), ("Ana María de la Torre Sanz",), (" ",), (None,)], "n string").select(rosters.name_parts(F.col("n")).alias("p")).select("p.*")
    assert [tuple(r) for r in n.collect()] == [("Ana", "Gil Sanz"), ("Ana", "Gil"), ("Ana", "Gil Sanz"), ("Ana María", "de la Torre Sanz"), (None, None), (None, None)]
    notes = spark.createDataFrame([("p", "legislaturas: X, XI y XII"), ("q", "legislatura: 56 | 57"), ("r", "otra cosa"), ("s", None)], "id_dep string, notes string")
    assert rows(rosters.legislatures_of_notes(notes)) == [("p", "X"), ("p", "XI"), ("p", "XII"), ("q", "56"), ("q", "57")]
    reg = spark.createDataFrame([("ES", "p", "Ana Gil Sanz", "Gil Sanz"), ("ES", "q", "Luis Toro Paz", "Toro Paz"), ("ES", "u", "Eva Toro Paz", "Toro Paz")], "country string, id_dep string, speaker_name string, last_name string")
    t = [("1", "X", "antes"), ("2", "El señor PRESIDENTE (Gil Sanz)", "abro"), ("3", "X", "hola"), ("4", "X", "Asume la presidencia el señor Luis Toro Paz."), ("5", "X", None), ("6", "PRESIDENTE (Toro Paz)", "x")]
    df = spark.createDataFrame([("s", "ES", *x) for x in t], "id_session string, country string, id_int string, speaker_raw string, text string")
    assert [(r["id_int"], r["chair_id"]) for r in rosters.presidency(df, reg).orderBy("id_int").collect()] == [("2", "p"), ("3", "p"), ("4", "q"), ("5", "q"), ("6", None)]
    assert rows(rosters.declared_chairs(df).select("id_int", "declared")) == [("4", "Luis Toro Paz.")] or rows(rosters.declared_chairs(df).select("id_int", "declared")) == [("4", "Luis Toro Paz")]
    assert rosters.without_chair(df).count() == 0 and rows(rosters.without_chair(df.where("id_int in ('1', '3')"))) == [("s", 2)]


def test_numbers_days_modes_and_edges(spark):
    s = spark.createDataFrame([(f"s{k}", "ES", "1", n) for k, n in enumerate([None, 4, None, 6, None, None])], "id_session string, country string, legislature string, number int")
    assert [r["imputed"] for r in rosters.number_tail(s).orderBy("id_session").collect()] == [None, 4, None, 6, 7, 8]
    gaps = spark.createDataFrame([("s", 2, 6, 3)], "id_session string, after int, before int, missing int")
    gone = spark.createDataFrame([("s", 3), ("s", 3), ("s", 5), ("s", 9), ("t", 4)], "id_session string, intervention_order int")
    assert rows(rosters.explained_gaps(gaps, gone)) == [("s", 2, 6, 3, 2, 1)]
    d = spark.createDataFrame([("ES", D(2020, 1, 1), "b", 1, "1"), ("ES", D(2020, 1, 1), "a", 2, "2"), ("ES", D(2020, 1, 1), "a", 1, "3"), ("ES", None, "a", 1, "4")], "country string, date date, id_session string, intervention_order int, id_int string")
    assert rows(rosters.regroup_days(d)) == [("1", 3), ("2", 2), ("3", 1)]
    m = spark.createDataFrame([("p", "X"), ("p", "Y"), ("p", None), ("q", "Z")], "k string, v string")
    assert rows(rosters.mode_per_key(m, "k", "v")) == [("p", "X", 1), ("q", "Z", 1)]
    e = spark.createDataFrame([("1", "la comisión de la comisión y la comisión sigue la funda\nción y"), ("2", "uno comi\nsión dos"), ("3", "uno sigue\nla mesa")], "id_int string, text string")
    assert rows(rosters.edge_losses(e)) == [("cut", 1), ("split", 1), ("word", 1)]


# --- pages ---
def test_page_furniture(spark):
    from stenograph.operators import pages

    body = "una línea de prosa que no se repite {} y que sigue"
    t = [("d", p, "\n".join([f"DIARIO DE SESIONES {p}", *[body.format(f"{p} {k} " + "abcdefghij"[(p * 7 + k) % 10]) + "xyz"[k % 3] * k for k in range(8)], f"— {p} —"])) for p in range(1, 7)]
    found = pages.paged_furniture(spark.createDataFrame(t, "id string, page int, text string"))
    assert {r["line"] for r in found.collect()} >= {"DIARIO DE SESIONES 1", "— 6 —"} and found.where("line LIKE 'una%'").count() == 0
    whole = spark.createDataFrame([("d", p, "x\ny\nz") for p in range(6)], "id string, page int, text string")
    assert pages.paged_furniture(whole).count() == 0  # it would take everything
    u = spark.createDataFrame([("1", "Acta 1\nprosa.\nActa 2\nprosa.\nActa 3"), ("2", None)], "id string, text string")
    assert rows(pages.unpaged_furniture(u)) == [("1", "acta 9", 3)]
    f = spark.createDataFrame([("1", D(2020, 5, 3), "texto\n— 45 —\nDiario 02/05/2020\ntexto\nvisto 03/05/2020\nfin")], "id_int string, date date, text string")
    assert rows(pages.folio_lines(f)) == [("1", 1, "folio"), ("1", 2, "dated")]
    stripped = u.where("id = '1'").select(pages.strip_patterns(F.col("text"), [r"Acta \d\n"], [r"Acta \d"], ["pro"])).first()[0]
    assert stripped == "sa.\nsa.\n"


def test_cut_words_and_lines(spark):
    from stenograph.operators import pages

    t = [(str(k), "La fundación sigue y el plan técnico-administrativo sigue.") for k in range(5)] + [("x", "La Funda-\nción y lo técnico-\nadministrativo."), ("n", None)]
    df = spark.createDataFrame(t, "id string, text string")
    told = pages.cut_words(df)
    assert {(r["head"], r["joins"]) for r in told.collect()} == {("funda", True), ("técnico", False)}
    assert {r["id"]: r["text"] for r in pages.join_cut_words(df, told).collect()}["x"] == "La Fundación y lo técnico-administrativo."
    one = lambda f, x: spark.createDataFrame([(x,)], "t string").select(f(F.col("t"))).first()[0]
    assert one(pages.trim_leaders, "Índice ........ 45\nfin.") == "Índice\nfin." and one(pages.drop_junk, "bien dicho\n#~|..-_ a\nok") == "bien dicho\nok"
    assert one(pages.reflow, "la ley\nsigue.\nOtra\n\nfin") == "la ley sigue.\nOtra\n\nfin" and one(pages.join_titles, "ORDEN DEL DIA\nPRIMERA PARTE\nx") == "ORDEN DEL DIA PRIMERA PARTE\nx"
    assert one(pages.box_width, "\n".join("x" * k for k in range(1, 11))) == 9 and one(pages.box_width, None) is None
    assert tuple(one(pages.commentary, "Sí. (Aplausos.) Sigue ( pausa ).")) == ("Sí. Sigue .", ["Aplausos.", "pausa"])


def test_front_matter_and_repetitions(spark):
    from stenograph.operators import pages

    turn = "Señorías, se abre la sesión de hoy con el orden del día."
    docs = spark.createDataFrame([("d", D(2020, 1, 1), f"CONGRESO. Año 2020.\n{turn.upper()} Y más."), ("e", D(2020, 1, 1), turn), ("f", D(2021, 1, 1), turn)], "id string, date date, text string")
    t = spark.createDataFrame([("s", D(2020, 1, 1), "1", turn), ("s", D(2020, 1, 1), "2", "otra")], "id_session string, date date, id_int string, text string")
    assert rows(pages.front_matter(docs, t)) == [("d", "s", len("CONGRESOAño2020"))]
    long = "una frase bastante larga que se repite " * 3
    r = spark.createDataFrame([("s", long), ("s", long.upper()), ("s", long + "x"), ("t", long)], "id_session string, text string")
    assert rows(pages.repetitions(r)) == [("s", 1, 1)]


# --- publishing ---
def test_checked_writes_logs_and_settings(spark, tmp_path):
    from stenograph.sources import publishing

    path = f"file://{tmp_path}/t"
    good = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    assert publishing.publish(good, path, "k") == 2 and publishing.publish(good.limit(1), path, "k") == 1
    for bad in (good.unionByName(good), good.withColumn("k", F.lit(None).cast("string")), good.limit(0)):
        with pytest.raises(publishing.BadTable):
            publishing.publish(bad, path, "k")
    assert spark.read.parquet(path).count() == 1 and [p.name for p in tmp_path.iterdir()] == ["t"]
    for n in range(3):
        publishing.log_query(spark, f"file://{tmp_path}/log", "ngram" if n else "search", {"terms": f"t{n}"}, n)
    note = publishing.methods_note(spark, f"file://{tmp_path}/log")
    assert note.splitlines()[0].startswith("ngram: 2 queries since ") and '"t2"' in note
    base = {"a": {"b": 1, "c": 2}, "d": 3}
    assert publishing.merged(base, {"a": {"c": 5}}, {"d": {"e": 1}}) == {"a": {"b": 1, "c": 5}, "d": {"e": 1}} and base["d"] == 3
    for entities in ([("", "x")], [("a", "x"), ("a", "y")], [("a", "--")]):
        with pytest.raises(ValueError):
            publishing.checked_entities(entities)
    with pytest.raises(ValueError):
        publishing.checked_entities([("a", "x"), ("b", " ")])


def test_networks_and_alerts(spark, tmp_path):
    from stenograph.sources import publishing

    nodes, edges = spark.createDataFrame([("a&b",), ("c",)], "id string"), spark.createDataFrame([("a&b", "c", 2.0)], "source string, target string, weight double")
    publishing.export_network(nodes, edges, f"file://{tmp_path}/n")
    xml = "\n".join(r[0] for r in spark.read.text(f"file://{tmp_path}/n/graphml").collect())
    import xml.etree.ElementTree as ET

    assert len(ET.fromstring(xml)[1]) == 3 and spark.read.option("header", True).csv(f"file://{tmp_path}/n/edges").count() == 1
    t = spark.createDataFrame([("1", "la ley de Ley"), ("2", "una ley y Marta"), ("3", "Marta")], "id_int string, text string")
    names = [("law", "ley"), ("marta", "Marta")]
    assert rows(publishing.ambiguity_alerts(networks.entity_presence(t, names), t, names, most=0.5)) == [("law", "common word"), ("law", "frequent"), ("law", "short"), ("marta", "frequent")]


def test_subsets_by_country_by_query_and_by_name(spark, tmp_path):
    from stenograph.functions.terms import Selection, since
    from stenograph.operators import libraries

    t = spark.createDataFrame([("1", "PT", D(2020, 1, 1), "hospital"), ("2", "BR", D(2020, 1, 1), "hospital escola"), ("3", "BR", D(2010, 1, 1), "escola"), ("4", "ES", None, "hospital")], "id_int string, country string, date date, text string")
    shared, own = {"variants": ["hospital"]}, {"BR": {"variants": ["escola"], "event": ("2010-01-05", 10, 0)}, "ES": {"variants": [], "selection": Selection(since("2000"))}}
    assert rows(libraries.create_by_country(t, shared, own).select("id_int")) == [("1",), ("3",)]
    assert rows(libraries.create_from_query(spark, "SELECT id_int FROM x WHERE country = 'BR'", t, {"x": t}).select("id_int")) == [("2",), ("3",)]
    with pytest.raises(ValueError):
        libraries.create_from_query(spark, "SELECT country FROM x", t, {"x": t})
    store, made = f"file://{tmp_path}/s", libraries.create_by_country(t, shared)
    libraries.save(made, store, "one", {"terms": ["hospital"]})
    with pytest.raises(Exception):
        libraries.save(made, store, "one", {})
    assert [(r["name"], r["turns"], r["countries"]) for r in libraries.listing(spark, store).collect()] == [("one", 3, ["BR", "ES", "PT"])]
    assert libraries.delete(spark, store, "one") and not libraries.delete(spark, store, "one")
    d = spark.createDataFrame([("A", 100, 30, 10.0, 0, D(2000, 1, 1), D(2020, 1, 1)), ("B", 5, 0, 30.0, 2, D(2001, 1, 1), D(2020, 1, 1))], "country string, turns int, long_turns int, chair_pct double, undated int, first_date date, last_date date")
    assert {(c, n.split()[0]) for c, n in rows(libraries.notes(d))} == {("A", "over"), ("B", "ten"), ("B", "over"), ("B", "undated"), ("B", "another")}


# --- duplicates at the published limits ---
def test_planted_duplicates(spark):
    long = "señorías pido la palabra por una cuestión de orden " * 9
    t = [("L", D(2020, 1, 1), "X", long, "1"), ("L", D(2020, 1, 1), "X", long, "2"), ("L", D(2020, 1, 2), "X", long, "3"), ("L", D(2020, 1, 1), "X", "corto", "4"), ("L", D(2020, 1, 1), "X", "corto", "5")]
    got = sequence.exact_repeats(spark.createDataFrame(t, "legislature string, date date, speaker_raw string, text string, id_int string"))
    assert [(r["copies"], r["first_id"]) for r in got.collect()] == [(2, "1")]
    said = lambda s, n, k, number: [("ES", D(2020, 1, 1), s, number, f"un texto bastante largo sobre el asunto número {i}") for i in range(k, k + n)]
    day = said("a", 10, 0, None) + said("b", 8, 3, None) + said("c", 9, 0, "7") + said("d", 3, 50, "7") + said("e", 10, 0, "8")
    df = spark.createDataFrame(day, "country string, date date, id_session string, session_number string, text string")
    assert [(r["keeper"], r["redundant"], r["reason"]) for r in sequence.same_day_duplicates(df).orderBy("keeper", "redundant").collect()] == [
        ("a", "b", "texts"), ("a", "c", "texts"), ("a", "e", "texts"), ("c", "b", "texts"), ("c", "d", "number"), ("e", "b", "texts"),
    ]
    same = spark.createDataFrame([("ES", "p", "Ana Gil Sanz"), ("ES", "q", "SANZ GIL, Ana"), ("PT", "r", "Ana Gil Sanz"), ("ES", "s", "Ana Gil")], "country string, id_dep string, speaker_name string")
    assert rows(quality.register_duplicates(same)) == [("ES", "p", "q", "ana gil sanz")]
    seats = spark.createDataFrame([("ES", g, f"{g}{k}") for g, n in (("1", 10), ("2", 10), ("3", 15)) for k in range(n)], "country string, legislature string, id_dep string")
    assert rows(register.seats_check(seats)) == [("ES", "3", 15, 10.0)]
