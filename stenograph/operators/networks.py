"""Co-mention and mention networks: pair statistics in Spark, small-graph algorithms on bounded graphs."""

from __future__ import annotations

import random
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_list
from ..session import materialize
from .spotting import Trie, token_lists

#: Small-graph algorithms run on the driver; a graph may have at most this many edges there.
DRIVER_EDGES = 200_000


def entity_presence(rows: DataFrame, entities: Sequence[tuple[str, str]], exclude: Sequence[str] = ()) -> DataFrame:
    """(id_int, entity): which entities a turn names. ``entities``: name and phrase; one name may have several.

    A match strictly inside a longer match doesn't count, nor one inside a phrase of ``exclude``. Whole words, case
    and accents ignored. One pass over the tokens with all phrases in a trie, however many there are.
    """
    trie = Trie([(word_list(p), n) for n, p in entities] + [(word_list(p), None) for p in exclude])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, names = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for name in sorted({n for _, _, n in trie.longest(word_list(text)) if n is not None}):
                    at.append(row)
                    names.append(name)
            yield pa.RecordBatch.from_arrays([batch.column("id_int").take(pa.array(at, pa.int64())), pa.array(names, pa.string())], names=["id_int", "entity"])

    return rows.select("id_int", "text").where(F.col("text").isNotNull()).mapInArrow(run, "id_int string, entity string")


def pair_network(presence: DataFrame, n_units: int, least: int = 5, least_npmi: float = 0.1) -> DataFrame:
    """(a, b, co, n_a, n_b, npmi, jaccard) of entities named in the same units.

    NPMI = ln(p_ab / (p_a p_b)) / -ln p_ab, 1 where every unit has both; the threshold holds for the
    unrounded value. A unit's entities are a short list from a fixed dictionary.
    """
    single = presence.groupBy("entity").agg(F.count("*").alias("n"))
    lists = presence.groupBy("id_int").agg(F.sort_array(F.collect_set("entity")).alias("l")).where(F.size("l") > 1)
    pairs = lists.select("l", F.posexplode("l").alias("at", "a")).select("a", F.explode(F.slice("l", F.col("at") + 2, F.size("l"))).alias("b")).groupBy("a", "b").agg(F.count("*").alias("co"))
    j = pairs.join(single.withColumnsRenamed({"entity": "a", "n": "n_a"}), "a").join(single.withColumnsRenamed({"entity": "b", "n": "n_b"}), "b")
    p = F.col("co") / F.lit(float(n_units or 1))
    npmi = F.when(F.col("co") == n_units, 1.0).otherwise(F.log(p / (F.col("n_a") / F.lit(float(n_units or 1)) * F.col("n_b") / F.lit(float(n_units or 1)))) / -F.log(p))
    kept = j.withColumn("raw", npmi).where((F.col("co") >= least) & (F.col("raw") >= least_npmi))
    return kept.select("a", "b", "co", "n_a", "n_b", F.round("raw", 6).alias("npmi"), F.round(F.col("co") / (F.col("n_a") + F.col("n_b") - F.col("co")), 6).alias("jaccard"))


def prune_neighbours(edges: DataFrame, weight: str, k: int) -> DataFrame:
    """Edges (a, b, ...) among the ``k`` heaviest of either end; ties by the other end."""
    ends = edges.select("a", "b", weight, F.explode(F.array("a", "b")).alias("end"))
    rank = F.row_number().over(Window.partitionBy("end").orderBy(F.desc(weight), "a", "b"))
    keep = ends.withColumn("r", rank).where(F.col("r") <= k).select("a", "b").distinct()
    return edges.join(keep, ["a", "b"], "left_semi")


def trim_nodes(edges: DataFrame, weight: str, most: int) -> DataFrame:
    """Edges among the ``most`` nodes of greatest strength (the sum of their edges' weights); ties by name."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node"), weight).groupBy("node").agg(F.sum(weight).alias("strength"))
    kept = ends.orderBy(F.desc("strength"), "node").limit(most).select("node")
    return edges.join(kept.withColumnRenamed("node", "a"), "a", "left_semi").join(kept.withColumnRenamed("node", "b"), "b", "left_semi")


def mention_edges(rows: DataFrame, aliases: Sequence[tuple[str, str]], least: int = 1) -> DataFrame:
    """(source, target, turns): who names whom; naming oneself is left out. ``aliases``: id and folded phrase."""
    named = entity_presence(rows.where(F.col("id_dep").isNotNull()), aliases)
    j = named.join(rows.select("id_int", "id_dep"), "id_int").where(F.col("id_dep") != F.col("entity"))
    return j.groupBy(F.col("id_dep").alias("source"), F.col("entity").alias("target")).agg(F.countDistinct("id_int").alias("turns")).where(F.col("turns") >= least)


def page_rank(edges: DataFrame, damping: float = 0.85, rounds: int = 200, tolerance: float = 1e-12, driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """(node, rank) by power iteration until the ranks change by less than ``tolerance`` in all, at most ``rounds`` times.

    The mass of nodes without outgoing edges is spread evenly. A graph of at most ``driver_edges`` edges (counted
    first) is iterated on the driver. A larger one is iterated by joins, each round written to the shared folder, so
    that no round repeats the ones before. Both give the same ranks.
    """
    spark = edges.sparkSession
    some = edges.select("source", "target", F.col("turns").cast("double")).limit(driver_edges + 1).collect()
    if len(some) <= driver_edges:
        nodes = sorted({r[0] for r in some} | {r[1] for r in some})
        n, total = len(nodes) or 1, defaultdict(float)
        for r in some:
            total[r[0]] += r[2]
        rank = dict.fromkeys(nodes, 1.0 / n)
        for _ in range(rounds):
            spread = sum(v for k, v in rank.items() if k not in total) * damping / n + (1 - damping) / n
            got = dict.fromkeys(nodes, spread)
            for a, b, w in some:
                got[b] += damping * rank[a] * w / total[a]
            change, rank = sum(abs(got[k] - rank[k]) for k in nodes), got
            if change < tolerance:
                break
        return spark.createDataFrame([(k, v) for k, v in rank.items()], "node string, rank double")
    out = materialize(edges.groupBy("source").agg(F.sum("turns").alias("total")), "rank-out")
    share = materialize(edges.join(out, "source").select("source", "target", (F.col("turns") / F.col("total")).alias("p")), "rank-edges")
    nodes = materialize(edges.select(F.col("source").alias("node")).union(edges.select("target")).distinct(), "rank-nodes")
    n = nodes.count() or 1
    rank = nodes.withColumn("rank", F.lit(1.0 / n))
    for _ in range(rounds):
        dangling = rank.join(out, rank.node == out.source, "left_anti").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        got = share.join(rank, share.source == rank.node).groupBy("target").agg(F.sum(F.col("p") * F.col("rank")).alias("g"))
        fresh = F.lit((1 - damping) / n + damping * dangling / n) + damping * F.coalesce("g", F.lit(0.0))
        step = materialize(rank.withColumnRenamed("rank", "_old").join(got, F.col("node") == F.col("target"), "left").select("node", fresh.alias("rank"), F.abs(fresh - F.col("_old")).alias("moved")), "rank-round")
        rank = step.select("node", "rank")
        if (step.agg(F.sum("moved")).first()[0] or 0.0) < tolerance:
            break
    return rank


def _move(near: dict, degree: dict, label: dict, gamma: float, rng: random.Random) -> None:
    """Move nodes to the neighbouring community that gains most until none gains; changes ``label``."""
    mass: dict = defaultdict(float)
    for a in near:
        mass[label[a]] += degree[a]
    queue = deque(rng.sample(sorted(near), len(near)))
    waiting = set(queue)
    while queue:
        a = queue.popleft()
        waiting.discard(a)
        links: dict = defaultdict(float)
        for b, w in near[a].items():
            links[label[b]] += w
        own = label[a]
        mass[own] -= degree[a]
        best, gain = own, links.get(own, 0.0) - gamma * degree[a] * mass[own]
        for c in sorted(links):
            g = links[c] - gamma * degree[a] * mass[c]
            if g > gain + 1e-12:
                best, gain = c, g
        mass[best] += degree[a]
        if best != own:
            label[a] = best
            for b in near[a]:
                if label[b] != best and b not in waiting:
                    queue.append(b)
                    waiting.add(b)


def _refine(near: dict, degree: dict, label: dict, gamma: float, rng: random.Random) -> dict:
    """The part of each node: single nodes of a community merged where they and the part are well connected to it."""
    part = {a: k for k, a in enumerate(sorted(near))}
    community: dict = defaultdict(float)
    for a in near:
        community[label[a]] += degree[a]
    outer = {a: sum(w for b, w in near[a].items() if label[b] == label[a]) for a in near}  # links into the rest of the community
    mass, cut, size = {part[a]: degree[a] for a in near}, {part[a]: outer[a] for a in near}, {part[a]: 1 for a in near}
    for a in rng.sample(sorted(near), len(near)):
        own, whole = part[a], community[label[a]]
        if size[own] > 1 or cut[own] < gamma * degree[a] * (whole - degree[a]) - 1e-12:
            continue
        links: dict = defaultdict(float)
        for b, w in near[a].items():
            if label[b] == label[a]:
                links[part[b]] += w
        best, gain = own, 0.0
        for p in sorted(links):
            if p != own and cut[p] >= gamma * mass[p] * (whole - mass[p]) - 1e-12:
                g = links[p] - gamma * degree[a] * mass[p]
                if g > gain + 1e-12:
                    best, gain = p, g
        if best != own:
            part[a] = best
            mass[best] += degree[a]
            cut[best] += outer[a] - 2 * links[best]
            size[best] += 1
            size[own], mass[own], cut[own] = 0, 0.0, 0.0
    return part


class Graph:
    """A bounded undirected weighted graph on the driver."""

    def __init__(self, edges: Iterable[tuple[str, str, float]]) -> None:
        self.near: dict[str, dict[str, float]] = defaultdict(dict)
        for a, b, w in edges:
            if a != b:
                self.near[a][b] = self.near[a].get(b, 0) + w
                self.near[b][a] = self.near[b].get(a, 0) + w
        self.nodes = sorted(self.near)

    @classmethod
    def collect(cls, edges: DataFrame, a: str, b: str, weight: str) -> "Graph":
        rows = edges.select(a, b, F.col(weight).cast("double")).limit(DRIVER_EDGES + 1).collect()
        if len(rows) > DRIVER_EDGES:
            raise ValueError(f"more than {DRIVER_EDGES} edges: prune the network first")
        return cls(sorted((r[0], r[1], r[2]) for r in rows))

    def communities(self, resolution: float = 1.0, seed: int = 1, rounds: int = 10) -> dict[str, int]:
        """Leiden communities of modularity: queued local moving, refinement, aggregation of the refined parts.

        Refinement starts from single nodes within each community and merges only nodes that are well connected to
        it, so that no part, and hence no community, can fall apart. The next round begins from the unrefined
        communities. Visiting order comes from the seed and ties go to the lowest label, so the same graph gives the
        same result. Communities are numbered by falling size, then by their first node.
        """
        rng = random.Random(seed)
        total = sum(w for n in self.near.values() for w in n.values()) or 1.0
        near: dict = {a: dict(n) for a, n in self.near.items()}
        loops: dict = defaultdict(float)
        inside: dict = {a: [a] for a in self.nodes}
        label: dict = {a: k for k, a in enumerate(sorted(near))}
        for _ in range(rounds):
            degree = {a: sum(near[a].values()) + loops[a] for a in near}
            _move(near, degree, label, resolution / total, rng)
            parts = _refine(near, degree, label, resolution / total, rng)
            if len(set(parts.values())) == len(near):
                break
            order = {p: k for k, p in enumerate(sorted(set(parts.values())))}
            name = {a: order[parts[a]] for a in near}
            merged: dict = {k: defaultdict(float) for k in order.values()}
            folded: dict = defaultdict(float)
            members: dict = {k: [] for k in order.values()}
            held: dict = {}
            for a in sorted(near):
                members[name[a]] += inside[a]
                held[name[a]] = label[a]
                folded[name[a]] += loops[a]
                for b, w in near[a].items():
                    if name[a] == name[b]:
                        folded[name[a]] += w
                    else:
                        merged[name[a]][name[b]] += w
            near, loops, inside, label = {k: dict(v) for k, v in merged.items()}, folded, members, held
        groups: dict = defaultdict(list)
        for a, nodes in inside.items():
            groups[label[a]] += nodes
        ranked = sorted((sorted(g) for g in groups.values()), key=lambda g: (-len(g), g[0]))
        return {x: k for k, g in enumerate(ranked) for x in g}

    def modularity(self, label: dict[str, int], resolution: float = 1.0) -> float:
        total = sum(w for n in self.near.values() for w in n.values()) or 1.0
        own, mass = defaultdict(float), defaultdict(float)
        for a, n in self.near.items():
            for b, w in n.items():
                mass[label[a]] += w
                if label[a] == label[b]:
                    own[label[a]] += w
        return sum(own[c] / total - resolution * (mass[c] / total) ** 2 for c in mass)

    def betweenness(self) -> dict[str, float]:
        """Brandes' betweenness over distances 1 / weight, divided by (n - 1)(n - 2)."""
        import heapq

        score = dict.fromkeys(self.nodes, 0.0)
        for s in self.nodes:
            dist, paths, before, order = {s: 0.0}, defaultdict(float, {s: 1.0}), defaultdict(list), []
            heap, done = [(0.0, s)], set()
            while heap:
                d, x = heapq.heappop(heap)
                if x in done:
                    continue
                done.add(x)
                order.append(x)
                for y, w in self.near[x].items():
                    nd = d + 1 / w
                    if y not in dist or nd < dist[y] - 1e-12:
                        dist[y], paths[y], before[y] = nd, paths[x], [x]
                        heapq.heappush(heap, (nd, y))
                    elif abs(nd - dist[y]) <= 1e-12 and y not in done:
                        paths[y] += paths[x]
                        before[y].append(x)
            back = defaultdict(float)
            for y in reversed(order):
                for x in before[y]:
                    back[x] += paths[x] / paths[y] * (1 + back[y])
                if y != s:
                    score[y] += back[y]
        n = len(self.nodes)
        return {x: v / ((n - 1) * (n - 2)) if n > 2 else 0.0 for x, v in score.items()}


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(n, agreement, kappa) of two coders; kappa is null where chance agreement is 1."""
    ok = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    n = ok.count()
    table = ok.groupBy(F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count("*").alias("c"))
    agree = table.agg(F.coalesce(F.sum(F.when(F.col("x") == F.col("y"), F.col("c"))), F.lit(0)).alias("o"))
    ma, mb = table.groupBy("x").agg(F.sum("c").alias("m")), table.groupBy(F.col("y").alias("x")).agg(F.sum("c").alias("k"))
    chance = ma.join(mb, "x").agg(F.coalesce(F.sum(F.col("m") * F.col("k")), F.lit(0)).alias("e")).first()["e"]
    po = F.col("o") / F.lit(float(n or 1))
    pe = F.lit(float(chance) / float(n or 1) ** 2)
    return agree.select(F.lit(n).cast("bigint").alias("n"), F.round(po, 6).alias("agreement"), F.round(F.when(pe < 1, (po - pe) / (1 - pe)), 6).alias("kappa"))


def wilson(k: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    """Wilson's interval of a share."""
    p = k / n
    centre = (p + F.lit(z * z) / (2 * n)) / (1 + F.lit(z * z) / n)
    half = F.lit(z) * F.sqrt(p * (1 - p) / n + F.lit(z * z) / (4 * n * n)) / (1 + F.lit(z * z) / n)
    return centre - half, centre + half


def reading_list(rows: DataFrame, weights: DataFrame, per_group: int = 25) -> DataFrame:
    """(theme, id_int, score, place): turns that best show a theme, by saturating weights of its terms.

    ``weights``: theme, term, g2. Score = sum of ln(1 + g2) tf 2.2 / (tf + 1.2 (0.25 + 0.75 length / average)).
    """
    lists = materialize(token_lists(rows, "id_int").where(F.size("w") > 0), "reading-words")
    average = lists.agg(F.avg(F.size("w"))).first()[0] or 1.0
    tokens = lists.select("id_int", F.size("w").alias("length"), F.explode("w").alias("term"))
    tf = tokens.join(weights, "term").groupBy("theme", "id_int", "length", "term", "g2").agg(F.count("*").alias("tf"))
    part = F.log1p("g2") * F.col("tf") * 2.2 / (F.col("tf") + 1.2 * (0.25 + 0.75 * F.col("length") / F.lit(average)))
    scored = tf.groupBy("theme", "id_int").agg(F.round(F.sum(part), 6).alias("score"))
    rank = F.row_number().over(Window.partitionBy("theme").orderBy(F.desc("score"), "id_int"))
    return scored.withColumn("place", rank).where(F.col("place") <= per_group)
