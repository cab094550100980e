"""A subset's characteristic words, their network, its themes and what these say about the turns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .analysis import keyness
from .networks import Graph
from .spotting import token_lists

#: A theme of fewer terms is no theme: its terms are loose.
LEAST_TERMS = 3
#: A vocabulary has at most this many terms; it bounds what is sent to executors and the graph on the driver.
MOST_TERMS = 2_000


def tokens_of(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, w): the folded words of each turn's text; turns without words are left out."""
    return token_lists(rows, *keep).where(F.size("w") > 0)


def word_sums(tokens: DataFrame) -> DataFrame:
    """(fold, n) over all turns."""
    return tokens.select(F.explode("w").alias("fold")).groupBy("fold").agg(F.count("*").alias("n"))


def function_words(tokens: DataFrame, share: float = 0.25) -> DataFrame:
    """(fold): words in at least this share of all turns; they carry grammar, not subject."""
    n = tokens.count()
    used = tokens.select(F.explode(F.array_distinct("w")).alias("fold")).groupBy("fold").agg(F.count("*").alias("n"))
    return used.where(F.col("n") >= n * share).select("fold")


def term_type(word: Column, stop: Sequence[str], connectors: Sequence[str], numerals: Sequence[str] = ()) -> Column:
    """What a folded word is in an expression: ``connector``, ``content`` (three letters or more, no number, no function word) or ``cut``."""
    content = (F.length(word) >= 3) & ~word.isin([*stop, *numerals, ""]) & ~word.rlike(r"^\d+$")
    return F.when(content, "content").when(word.isin([*connectors, ""]) & (word != ""), "connector").otherwise("cut")


def dossier(themes: DataFrame, statistics: DataFrame, reading: DataFrame, quotes: DataFrame) -> DataFrame:
    """One row per theme with what a reader needs: its terms by strength, its statistics, what to read and what is said.

    ``themes``: ``word_themes``; ``statistics``: ``theme_statistics``; ``reading``: theme, id_int, place; ``quotes``: id_int, place,
    passage. A theme's terms and its reading are bounded lists.
    """
    terms = themes.where(F.col("theme").isNotNull()).groupBy("theme").agg(F.sort_array(F.collect_list(F.struct((-F.col("inner")).alias("k"), "fold"))).alias("l")).select("theme", F.transform("l", lambda x: x["fold"]).alias("terms"))
    read = reading.groupBy("theme").agg(F.sort_array(F.collect_list(F.struct("place", "id_int"))).alias("l")).select("theme", F.transform("l", lambda x: x["id_int"]).alias("read"))
    said = reading.join(quotes.where(F.col("place") == 1).select("id_int", "passage"), "id_int").groupBy("theme").agg(F.min_by("passage", "place").alias("said"))
    return terms.join(statistics, "theme", "left").join(read, "theme", "left").join(said, "theme", "left").withColumn("label", F.array_join(F.slice("terms", 1, 3), " · "))


def lexicon(own: DataFrame, everything: DataFrame, stop: DataFrame | None = None, exclude: Sequence[str] = (), least: int = 5, threshold: float = 10.83, limit: int = 250) -> DataFrame:
    """(rank, fold, a, b, g2, log_ratio): the ``limit`` words a subset over-uses most against the rest.

    ``own`` and ``everything``: (fold, n) of the subset and of the whole it is part of; the rest is their difference.
    Words of one letter, numbers, ``stop`` and ``exclude`` are left out after the test. Ties go by the word.
    """
    if not 0 < limit <= MOST_TERMS:
        raise ValueError(f"a vocabulary has 1 to {MOST_TERMS} terms")
    sums = own.groupBy("fold").agg(F.sum("n").alias("own"))
    rest = everything.groupBy("fold").agg(F.sum("n").alias("n")).join(sums, "fold", "left").select("fold", F.greatest(F.col("n") - F.coalesce("own", F.lit(0)), F.lit(0)).alias("n"))
    found = keyness(own, rest, least, threshold).where((F.length("fold") >= 2) & ~F.col("fold").rlike(r"^\p{N}+$") & ~F.col("fold").isin([*exclude, ""]))
    if stop is not None:
        found = found.join(stop.select("fold"), "fold", "left_anti")
    top = found.orderBy(F.desc("g2"), "fold").limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("g2"), "fold")))  # at most MOST_TERMS rows


def fragments(tokens: DataFrame, size: int) -> DataFrame:
    """(id_int, w): each turn's words in runs of ``size``, the last one shorter."""
    cut = F.transform(F.sequence(F.lit(1), F.size("w"), F.lit(size)), lambda k: F.slice("w", k, size))
    return tokens.select("id_int", F.explode(cut).alias("w"))


def signed_g2(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Log-likelihood of (a of c) against (b of d), negative for under-use; a, b hits, c, d sizes."""
    n, k = c + d, a + b
    cell = lambda o, e: F.when(o > 0, o * F.log1p((o - e) / e)).otherwise(0.0)
    e1, e2 = c * k / n, d * k / n
    g2 = F.greatest(2 * (cell(a, e1) + cell(b, e2) + cell(c - a, c - e1) + cell(d - b, d - e2)), F.lit(0.0))
    return F.when(a * d >= b * c, g2).otherwise(-g2)


def word_network(units: DataFrame, vocabulary: DataFrame, neighbours: int = 10, least_g2: float = 10.83) -> DataFrame:
    """(a, b, co, expected, g2, weight): pairs of terms that share units more often than by chance, a before b.

    ``units``: one row per turn or fragment with its words ``w``. ``vocabulary``: fold, rank (``lexicon``). With N units
    and the units of each term, a pair stays if its common units pass expectation with a G2 of ``least_g2`` and it
    is among the ``neighbours`` strongest of either term. The weight is observed over expected.

    Each unit is brought down to its distinct terms first; its pairs are combined map-side, and there are at
    most half the square of the vocabulary of them.
    """
    n = units.count()
    terms = F.broadcast(vocabulary.select("fold", "rank"))  # at most MOST_TERMS rows
    held = units.withColumn("_unit", F.monotonically_increasing_id()).select("_unit", F.explode(F.array_distinct("w")).alias("fold")).join(terms, "fold")
    lists = held.groupBy("_unit").agg(F.array_sort(F.collect_list("rank")).alias("l"))
    df = held.groupBy("rank").agg(F.count("*").alias("df"))
    pairs = lists.where(F.size("l") > 1).select("l", F.posexplode("l").alias("at", "i")).select("i", F.explode(F.slice("l", F.col("at") + 2, F.size("l"))).alias("j")).groupBy("i", "j").agg(F.count("*").alias("co"))
    j = pairs.join(F.broadcast(df.withColumnsRenamed({"rank": "i", "df": "df_i"})), "i").join(F.broadcast(df.withColumnsRenamed({"rank": "j", "df": "df_j"})), "j")
    real = lambda c: F.col(c).cast("double")
    expected = real("df_i") * real("df_j") / F.lit(float(n or 1))
    g2 = signed_g2(real("co"), real("df_j") - real("co"), real("df_i"), F.lit(float(n)) - real("df_i"))
    kept = j.withColumn("expected", expected).withColumn("g2", g2).where((F.col("co") > F.col("expected")) & (F.col("g2") >= least_g2))
    ends = kept.select("i", "j", "g2", F.explode(F.array("i", "j")).alias("end"))
    place = F.row_number().over(Window.partitionBy("end").orderBy(F.desc("g2"), "i", "j"))
    near = ends.withColumn("k", place).where(F.col("k") <= neighbours).select("i", "j").distinct()
    name = lambda c: F.broadcast(vocabulary.select(F.col("rank").alias(c), F.col("fold").alias("a" if c == "i" else "b")))
    edges = kept.join(near, ["i", "j"], "left_semi").join(name("i"), "i").join(name("j"), "j")
    return edges.select("a", "b", "co", F.round("expected", 3).alias("expected"), F.round("g2", 2).alias("g2"), F.round(F.col("co") / F.col("expected"), 4).alias("weight"))


def word_themes(edges: DataFrame, vocabulary: DataFrame, resolution: float = 1.0, seed: int = 1) -> DataFrame:
    """(theme, fold, g2, strength, inner, degree): communities of a word network; loose terms have a null theme.

    The graph has at most MOST_TERMS nodes and ``neighbours`` edges each, so it is found on the driver. Themes
    are numbered by the mean G2 of their terms, then by size, then by their first term.
    """
    spark = edges.sparkSession
    g = Graph.collect(edges, "a", "b", "weight")
    g2 = {r["fold"]: float(r["g2"]) for r in vocabulary.select("fold", "g2").collect()}  # at most MOST_TERMS rows
    label = g.communities(resolution, seed)
    groups: dict[int, list[str]] = {}
    for term in sorted(g2):
        if term in label:
            groups.setdefault(label[term], []).append(term)
    ranked = sorted((m for m in groups.values() if len(m) >= LEAST_TERMS), key=lambda m: (-sum(g2[t] for t in m) / len(m), -len(m), m[0]))
    theme = {t: k for k, m in enumerate(ranked) for t in m}
    rows = []
    for t, score in sorted(g2.items()):
        near = g.near.get(t, {})
        rows.append((theme.get(t), t, score, round(sum(near.values(), 0.0), 3), round(sum((w for o, w in near.items() if label[o] == label[t]), 0.0), 3), len(near)))
    return spark.createDataFrame(rows, "theme int, fold string, g2 double, strength double, inner double, degree int")


def theme_shares(tokens: DataFrame, themes: DataFrame) -> DataFrame:
    """(id_int, theme, hits, terms, share, dominant, words): each theme a turn touches.

    ``hits`` are uses, ``terms`` distinct terms, ``share`` their share of the theme's. A theme dominates a turn with
    two of its terms or more and the largest share, unless another theme has the same.
    """
    member = themes.where(F.col("theme").isNotNull()).select("theme", "fold")
    size = F.broadcast(member.groupBy("theme").agg(F.count("*").alias("size")))
    hit = tokens.select("id_int", F.size("w").alias("words"), F.explode("w").alias("fold")).join(F.broadcast(member), "fold")  # a vocabulary
    per = hit.groupBy("id_int", "theme").agg(F.count("*").alias("hits"), F.countDistinct("fold").alias("terms"), F.max("words").alias("words"))
    w = Window.partitionBy("id_int")
    fit = F.when(F.col("terms") >= 2, F.col("share"))
    best = F.max(fit).over(w)
    out = per.join(size, "theme").withColumn("share", F.col("terms") / F.col("size"))
    out = out.withColumn("_fit", fit).withColumn("_best", best).withColumn("_ties", F.sum(F.when(F.col("_fit") == F.col("_best"), 1).otherwise(0)).over(w))
    dominant = F.coalesce((F.col("_fit") == F.col("_best")) & (F.col("_ties") == 1), F.lit(False))
    return out.select("id_int", "theme", "hits", "terms", F.round("share", 6).alias("share"), dominant.alias("dominant"), "words")


def theme_statistics(shares: DataFrame, n_turns: int, total_words: int) -> DataFrame:
    """(theme, turns, pct_turns, words_dominated, weight_pct) of each theme."""
    g = shares.groupBy("theme").agg(F.count("*").alias("turns"), F.coalesce(F.sum(F.when(F.col("dominant"), F.col("words"))), F.lit(0)).cast("bigint").alias("words_dominated"))
    pct = lambda c, n: F.round(F.col(c) * 100.0 / F.lit(float(n or 1)), 1)
    return g.select("theme", "turns", pct("turns", n_turns).alias("pct_turns"), "words_dominated", pct("words_dominated", total_words).alias("weight_pct"))


def theme_parties(shares: DataFrame, rows: DataFrame) -> DataFrame:
    """(theme, party, turns, hits, pct): who speaks of a theme; blank, ``?`` and unidentified parties are left out."""
    party = F.trim("party")
    named = rows.select("id_int", party.alias("party")).where((party != "") & ~party.rlike(r"(?i)^(\?|sin identificar)$"))
    g = shares.join(named, "id_int").groupBy("theme", "party").agg(F.count("*").alias("turns"), F.sum("hits").cast("bigint").alias("hits"))
    return g.withColumn("pct", F.round(F.col("hits") * 100.0 / F.sum("hits").over(Window.partitionBy("theme")), 2))


def concentrated(parties: DataFrame, least: float = 50.0) -> DataFrame:
    """Themes of which one party says half or more."""
    return parties.where(F.col("pct") >= least)


def theme_years(shares: DataFrame, rows: DataFrame) -> DataFrame:
    """(theme, year, turns, dominated): a theme over time; undated turns are left out."""
    dated = rows.where(F.col("date").isNotNull()).select("id_int", F.year("date").alias("year"))
    return shares.join(dated, "id_int").groupBy("theme", "year").agg(F.count("*").alias("turns"), F.count_if("dominant").alias("dominated"))


def theme_links(edges: DataFrame, themes: DataFrame) -> DataFrame:
    """(theme_a, theme_b, edges, weight): how themes hang together, lower number first."""
    of = lambda c, t: themes.where(F.col("theme").isNotNull()).select(F.col("fold").alias(c), F.col("theme").alias(t))
    j = edges.join(of("a", "x"), "a").join(of("b", "y"), "b").where(F.col("x") != F.col("y"))
    g = j.groupBy(F.least("x", "y").alias("theme_a"), F.greatest("x", "y").alias("theme_b")).agg(F.count("*").alias("edges"), F.sum("weight").alias("weight"))
    return g.withColumn("weight", F.round("weight", 3))


def group_words(tokens: DataFrame, groups: DataFrame, least_docs: int = 5, least: int = 5, threshold: float = 10.83) -> DataFrame:
    """(grp, fold, a, b, g2): words a group over-uses against all others. ``groups``: id_int, grp; groups of fewer turns are left out."""
    grouped = tokens.join(groups.where(F.col("grp").isNotNull()), "id_int")
    enough = grouped.groupBy("grp").agg(F.count("*").alias("docs"), F.sum(F.size("w")).cast("double").alias("c")).where(F.col("docs") >= least_docs)
    per = grouped.select("grp", F.explode("w").alias("fold")).groupBy("grp", "fold").agg(F.count("*").alias("a"))
    total = per.groupBy("fold").agg(F.sum("a").alias("t"))
    whole = float(grouped.agg(F.sum(F.size("w"))).first()[0] or 0)
    j = per.where(F.col("a") >= least).join(enough, "grp").join(total, "fold").withColumn("b", F.col("t") - F.col("a"))
    g2 = signed_g2(F.col("a").cast("double"), F.col("b").cast("double"), F.col("c"), F.lit(whole) - F.col("c"))
    out = j.where(F.col("c") < whole).withColumn("g2", F.round(g2, 2))
    return out.where((F.col("g2") >= threshold) & (F.length("fold") > 1)).select("grp", "fold", "a", F.col("b").cast("bigint").alias("b"), "g2")


def stability(edges: DataFrame, runs: int = 10, resolution: float = 1.0, seed: int = 1) -> DataFrame:
    """(theme, size, jaccard, verdict): how well each community is found again under other seeds and resolutions.

    The best Jaccard overlap, averaged over ``runs`` seeds and the resolutions 0.6 and 1.6 times as large: robust from
    0.8, fragile below 0.5. The graph is bounded as in ``word_themes``.
    """
    g = Graph.collect(edges, "a", "b", "weight")

    def groups(label: dict[str, int]) -> dict[int, set[str]]:
        out: dict[int, set[str]] = {}
        for t, k in label.items():
            out.setdefault(k, set()).add(t)
        return out

    first = groups(g.communities(resolution, seed))
    others = [groups(g.communities(resolution, seed + k)) for k in range(1, runs)] + [groups(g.communities(resolution * f, seed)) for f in (0.6, 1.6)]
    rows = []
    for k, m in sorted(first.items()):
        if len(m) >= LEAST_TERMS:
            score = sum(max(len(m & o) / len(m | o) for o in run.values()) for run in others) / len(others)
            rows.append((k, len(m), round(score, 6), "robust" if score >= 0.8 else "fragile" if score < 0.5 else "middling"))
    return edges.sparkSession.createDataFrame(rows, "theme int, size int, jaccard double, verdict string")


def passages(rows: DataFrame, terms: Sequence[str], width: int = 60, most: int = 3, longest: int = 900) -> DataFrame:
    """(id_int, place, hits, passage): the densest stretches of a turn's text, not overlapping, at most ``most``.

    A stretch is ``width`` words that begin at a hit; those with most hits come first, the earlier on a tie. What is
    shown of a stretch has at most ``longest`` characters.
    """
    import re
    from collections.abc import Iterable, Iterator

    import pyarrow as pa

    from ..functions.text import fold_text, word_list

    wanted = {w for t in terms for w in word_list(t)}
    token = re.compile(r"\w+")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for identity, text in zip(batch.column("id_int").to_pylist(), batch.column("text").to_pylist()):
                at = [m.span() for m in token.finditer(text)]
                hits = [k for k, (a, b) in enumerate(at) if fold_text(text[a:b]) in wanted]
                ends, j = [], 0
                for i, h in enumerate(hits):
                    j = max(j, i)
                    while j < len(hits) and hits[j] < h + width:
                        j += 1
                    ends.append(j - i)
                taken: list[int] = []
                for i in sorted(range(len(hits)), key=lambda i: (-ends[i], i)):
                    if len(taken) == most:
                        break
                    if all(abs(hits[i] - t) >= width for t in taken):
                        taken.append(hits[i])
                        last = at[min(hits[i] + width, len(at)) - 1][1]
                        shown = " ".join(text[at[hits[i]][0] : last].split())[:longest]
                        for c, v in zip(out, (identity, len(taken), ends[i], shown)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int32(), pa.int32(), pa.string()))], names=["id_int", "place", "hits", "passage"])

    return rows.select("id_int", "text").where(F.col("text").isNotNull()).mapInArrow(run, "id_int string, place int, hits int, passage string")


def check_anchors(codes: DataFrame, rows: DataFrame) -> DataFrame:
    """(code, id_int, anchor, status): whether each quotation that anchors a code stands in its turn (``quote_status``)."""
    from .texts import quote_status

    j = codes.join(rows.select("id_int", "text"), "id_int", "left")
    return j.select("code", "id_int", "anchor", F.when(F.col("text").isNull(), "no turn").otherwise(quote_status(F.col("anchor"), F.col("text"))).alias("status"))
