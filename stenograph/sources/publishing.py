"""Tables and results brought out: checked writes, whole folders in, indexes, SQL functions, networks, a log of queries."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import MARKED_WORD, WORD, _bases
from . import corpus


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class BadTable(ValueError):
    """A table that fails its checks and wasn't published."""


def publish(df: DataFrame, path: str, key: str, least_rows: int = 1) -> int:
    """Write a table beside its place, check it, then move it there; the number of its rows.

    Fewer than ``least_rows`` rows, a null or repeated ``key`` leave the old table as it is and raise ``BadTable``. Readers
    see the old table or the new one.
    """
    spark = df.sparkSession
    beside = f"{path}.new-{uuid.uuid4().hex[:8]}"
    df.write.parquet(beside)
    new = spark.read.parquet(beside)
    facts = new.agg(F.count("*").alias("n"), F.count_if(F.col(key).isNull()).alias("nulls")).first()
    repeated = new.groupBy(key).count().where("count > 1").limit(1).count()
    fault = "too few rows" if facts["n"] < least_rows else f"null {key}" if facts["nulls"] else f"repeated {key}" if repeated else None
    source, fs = _path(spark, beside)
    if fault:
        fs.delete(source, True)
        raise BadTable(fault)
    target, old = _path(spark, path)[0], _path(spark, f"{path}.old-{uuid.uuid4().hex[:8]}")[0]
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(source, target):
        raise OSError(f"could not move {beside}")
    if fs.exists(old):
        fs.delete(old, True)
    return facts["n"]


def import_folder(spark: SparkSession, folder: str, target: str, aliases: dict[str, list[str]] | None = None) -> list[str]:
    """Import every ``XX*.csv`` of a folder as country XX into a table partitioned by country; the countries, in order.

    A country's partition is replaced as a whole. Files are listed on the driver; their rows aren't brought there.
    """
    where, fs = _path(spark, folder)
    files = sorted(s.getPath().getName() for s in fs.listStatus(where) if s.getPath().getName().endswith(".csv"))
    done: dict[str, list[str]] = {}
    for name in files:
        if m := re.match(r"([A-Z]{2})", name):
            done.setdefault(m[1], []).append(f"{folder}/{name}")
    for country, paths in sorted(done.items()):
        parts = [corpus.canonical(corpus.resolve_aliases(corpus.read_csv(spark, p), aliases or {}), country) for p in paths]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        corpus.import_country(corpus.number_rows(whole), target)
    return sorted(done)


def reindex(rows: DataFrame, datasets: DataFrame, folder: str) -> list[str]:
    """Write the word counts, the vocabulary and the catalog of all turns anew."""
    tables = {"unigrams": corpus.index_unigrams(rows), "vocab": corpus.index_vocab(rows), "catalog": corpus.catalog(rows, datasets)}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return sorted(tables)


def register_functions(spark: SparkSession) -> list[str]:
    """``st_fold``, ``st_words`` and ``st_count_words`` for SQL: expressions, so they run in the JVM and are optimized."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    source, target = _bases()
    fold = f"trim(regexp_replace(translate(lower(t), {quote(source)}, {quote(target)}), '\\\\p{{Mn}}+', ''))"
    defined = {
        "st_fold": ("STRING", fold), "st_words": ("ARRAY<STRING>", f"regexp_extract_all({fold}, {quote(WORD)}, 0)"), "st_count_words": ("INT", f"coalesce(size(regexp_extract_all(lower(t), {quote(MARKED_WORD)}, 0)), 0)"),
    }
    for name, (kind, body) in defined.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {kind} RETURN {body}")
    return sorted(defined)


def export_network(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """A network as ``nodes`` and ``edges`` in CSV, and as GraphML. ``nodes``: id and attributes; ``edges``: source, target, weight."""
    nodes.write.mode("error").option("header", True).csv(f"{folder}/nodes")
    edges.write.mode("error").option("header", True).csv(f"{folder}/edges")
    safe = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c.cast("string"), "&", "&amp;"), "<", "&lt;"), '"', "&quot;")
    head = ['<?xml version="1.0" encoding="UTF-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">', '<key id="w" for="edge" attr.name="weight" attr.type="double"/>', '<graph edgedefault="directed">']
    spark = nodes.sparkSession
    fixed = spark.createDataFrame([(0, "", x) for x in head] + [(3, "", "</graph>"), (4, "", "</graphml>")], "part int, k string, line string")
    lines = nodes.select(F.lit(1).alias("part"), F.col("id").cast("string").alias("k"), F.concat(F.lit('<node id="'), safe(F.col("id")), F.lit('"/>')).alias("line"))
    ends = [F.lit('<edge source="'), safe(F.col("source")), F.lit('" target="'), safe(F.col("target")), F.lit('"><data key="w">'), F.col("weight").cast("string"), F.lit("</data></edge>")]
    links = edges.select(F.lit(2).alias("part"), F.concat_ws(" ", "source", "target").alias("k"), F.concat(*ends).alias("line"))
    # One file, in order: a network that is drawn is a report of bounded size.
    fixed.withColumn("k", F.monotonically_increasing_id().cast("string")).unionByName(lines).unionByName(links).orderBy("part", F.length("k"), "k").select("line").coalesce(1).write.mode("error").text(f"{folder}/graphml")


def log_query(spark: SparkSession, folder: str, tool: str, arguments: dict, rows: int | None = None) -> None:
    """Add one entry to the log of queries: a file of its own, so that writers don't wait for each other."""
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")
    where, fs = _path(spark, f"{folder}/{now.replace(':', '')}-{uuid.uuid4().hex[:6]}.json")
    stream = fs.create(where, False)
    stream.write(bytearray(json.dumps({"at": now, "tool": tool, "arguments": arguments, "rows": rows}, ensure_ascii=False, sort_keys=True).encode()))
    stream.close()


def methods_note(spark: SparkSession, folder: str) -> str:
    """What was asked of the data, as text for a methods section: each kind of query, how often, with its last arguments."""
    log = spark.read.json(folder)
    g = log.groupBy("tool").agg(F.count("*").alias("n"), F.max_by(F.to_json("arguments"), "at").alias("last"), F.min("at").alias("since"))
    return "\n".join(f"{r['tool']}: {r['n']} queries since {r['since'][:10]}, last with {r['last']}" for r in g.orderBy("tool").collect())  # one row per kind of query


def whitelist(rows: DataFrame, column: str, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose value is listed (``allowed``: one column), and the values that aren't, with their rows' number."""
    listed = allowed.select(F.col(allowed.columns[0]).alias(column)).distinct()
    rest = rows.join(listed, column, "left_anti").groupBy(column).agg(F.count("*").alias("n"))
    return rows.join(listed, column, "left_semi"), rest


def merged(base: dict, *over: dict) -> dict:
    """Settings laid over one another: dictionaries merge key by key, anything else replaces; inputs stay as they are."""
    out = dict(base)
    for layer in over:
        for key, value in layer.items():
            out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def checked_entities(entities: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """Entities as given, or an error that names the first fault: a blank or repeated name, a pattern without a word."""
    seen: set[str] = set()
    out = []
    for name, pattern in entities:
        if not name.strip():
            raise ValueError("an entity has no name")
        if name in seen:
            raise ValueError(f"two entities are named {name!r}")
        if not re.search(r"[^\W_]", pattern):
            raise ValueError(f"the pattern of {name!r} has no word")
        seen.add(name)
        out.append((name, pattern))
    return out


def ambiguity_alerts(presence: DataFrame, rows: DataFrame, entities: Sequence[tuple[str, str]], shortest: int = 4, most: float = 0.8, lower: float = 0.5) -> DataFrame:
    """(entity, alert): names that may mean several things: ``short``, in nearly all turns (``frequent``), or mostly in lower case (``common word``)."""
    spark = rows.sparkSession
    n = rows.count()
    named = spark.createDataFrame([(e, p) for e, p in checked_entities(entities)], "entity string, pattern string")
    short = named.where(F.length(F.regexp_replace("pattern", r"[^\p{L}\p{N}]", "")) < shortest).select("entity", F.lit("short").alias("alert"))
    often = presence.groupBy("entity").agg(F.countDistinct("id_int").alias("c")).where(F.col("c") > n * most).select("entity", F.lit("frequent").alias("alert"))
    uses = rows.where(F.col("text").isNotNull()).select(F.explode(F.array(*[F.struct(F.lit(e).alias("entity"), F.regexp_count("text", F.lit(rf"(?iu)(?<!\p{{L}}){re.escape(p)}(?!\p{{L}})")).alias("every"), F.regexp_count("text", F.lit(rf"(?<!\p{{L}}){re.escape(p.lower())}(?!\p{{L}})")).alias("small")) for e, p in entities])).alias("u"))
    common = uses.groupBy("u.entity").agg(F.sum("u.every").alias("e"), F.sum("u.small").alias("s")).where((F.col("e") > 0) & (F.col("s") > F.col("e") * lower)).select("entity", F.lit("common word").alias("alert"))
    return short.unionByName(often).unionByName(common)
