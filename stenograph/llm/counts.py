"""Problem 6: frequency of every distinct term, kept up to date by signed deltas."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold
from ..session import scratch_path
from ..sources.tables import table

SCHEMA = "term string, n bigint, records bigint"
#: Terms of one partition; the number of partitions is doubled before they hold more.
PER_BUCKET = 500_000
#: Versions kept readable behind the newest, for readers that began before it.
KEPT = 1


class TermCounts:
    """Persistent (term, n, records), hash-partitioned by term, changed only through deltas.

    A delta is a table (record columns, term, n, sign): sign +1 for the content of an added record,
    -1 for the content a deleted record had, and both for a changed one. It is reduced to one row of
    changes per term before it meets the stored counts, and only the partitions that hold a changed
    term are rewritten.

    Every state is a version: a small file that names the folder of each partition, the deltas it holds and the
    number of partitions. Data are written to new folders first; then the version's file is created under a
    number nobody has used, which fails if another writer took it (that merge must be repeated). The newest
    readable version counts, so a merge that ends anywhere before has changed nothing, a delta with an id is applied
    once however often it is repeated, and no state is ever deleted before a later one is there.
    """

    def __init__(self, spark: SparkSession, path: str, per_bucket: int = PER_BUCKET) -> None:
        self.spark, self.path, self.per_bucket = spark, path.rstrip("/"), per_bucket

    def _file(self, name: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where, fs = self._file(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def _load(self, name: str) -> dict | None:
        where, fs = self._file(f"versions/{name}")
        stream = fs.open(where)
        try:
            return json.loads(bytes(b & 0xFF for b in bytearray(stream.readAllBytes())).decode())
        except ValueError:
            return None  # its writer ended before the file was whole
        finally:
            stream.close()

    def state(self) -> dict:
        """The newest readable version: number, buckets, parts (folder and terms of each partition), deltas."""
        for name in reversed(self._names("versions")):
            if name.endswith(".json") and (found := self._load(name)):
                return found
        return {"number": 0, "buckets": 1, "parts": {}, "deltas": []}

    def _publish(self, state: dict) -> None:
        used = [int(n[:10]) for n in self._names("versions") if n.endswith(".json")]
        if used and max(used) >= state["number"] and self._load(f"{max(used):010}.json"):
            raise RuntimeError("another merge was published meanwhile; repeat this one")
        number = max([state["number"] - 1, *used]) + 1
        where, fs = self._file(f"versions/{number:010}.json")
        stream = fs.create(where, False)  # refused if the number is taken
        stream.write(bytearray(json.dumps(state | {"number": number}).encode()))
        stream.close()

    def clean(self) -> None:
        """Remove the folders and versions that none of the newest versions needs."""
        versions = [n for n in self._names("versions") if n.endswith(".json")]
        kept = [(n, v) for n in reversed(versions) if (v := self._load(n))][: KEPT + 1]
        if not kept:
            return
        needed = {part["folder"] for _, v in kept for part in v["parts"].values()}
        for name in self._names(""):
            if name.startswith("data-") and name not in needed:
                where, fs = self._file(name)
                fs.delete(where, True)
        for name in versions:
            if name < kept[-1][0]:
                where, fs = self._file(f"versions/{name}")
                fs.delete(where, False)

    def read(self, only: set[int] | None = None) -> DataFrame:
        """The stored counts: term, n, records."""
        parts = self.state()["parts"]
        paths = [f"{self.path}/{part['folder']}/bucket={b}" for b, part in parts.items() if only is None or int(b) in only]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*paths)

    def merge(self, delta: DataFrame, record: list[str], delta_id: str | None = None) -> "TermCounts":
        """Apply a signed delta with columns ``record``, term, n (null counts 0), sign.

        Rows of one record and term are summed first, so a record counts once per term however many
        rows spell it out. A term whose record count falls to 0 or below is removed. Null terms are
        ignored; an empty delta changes nothing. A ``delta_id`` that was merged before is skipped.
        """
        state = self.state()
        if delta_id is not None and delta_id in state["deltas"]:
            return self
        per_record = delta.where(F.col("term").isNotNull()).groupBy(*record, "term", "sign").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
        change = per_record.groupBy("term").agg(F.sum(F.col("sign") * F.col("n")).alias("n"), F.sum("sign").cast("bigint").alias("records"))
        staged = f"delta-{uuid.uuid4().hex[:12]}"
        change.write.option("compression", "zstd").parquet(f"{self.path}/{staged}")
        change = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{staged}")
        buckets = state["buckets"]
        while buckets * self.per_bucket < sum(p["terms"] for p in state["parts"].values()) + change.count():
            buckets *= 2
        bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
        touched = {r[0] for r in change.select(bucket).distinct().collect()} if buckets == state["buckets"] else set(range(buckets))
        if touched:
            old = self.read(touched if buckets == state["buckets"] else None)
            merged = old.unionByName(change).groupBy("term").agg(F.sum("n").alias("n"), F.sum("records").alias("records")).where(F.col("records") > 0) if state["parts"] else change.where(F.col("records") > 0)
            folder = f"data-{uuid.uuid4().hex[:12]}"
            merged.withColumn("bucket", bucket).repartition(len(touched), "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/{folder}")
            written = [int(n.split("=")[1]) for n in self._names(folder) if n.startswith("bucket=")]
            sizes = {r[0]: r[1] for r in self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{folder}/bucket={b}" for b in written]).groupBy(bucket).count().collect()} if written else {}
            kept = {b: p for b, p in state["parts"].items() if buckets == state["buckets"] and int(b) not in touched}
            parts = kept | {str(b): {"folder": folder, "terms": sizes.get(b, 0)} for b in written}
            self._publish({"number": state["number"] + 1, "buckets": buckets, "parts": parts, "deltas": [*state["deltas"], *([delta_id] if delta_id is not None else [])]})
        where, fs = self._file(staged)
        fs.delete(where, True)
        self.clean()
        return self


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Rows as one side of a delta: +1 for content that comes, -1 for content that goes."""
    return rows.withColumn("sign", F.lit(sign))


def folded_terms(rows: DataFrame, record: list[str]) -> DataFrame:
    """(record, term, n) with properly folded terms; blank terms are no terms."""
    return rows.select(*record, fold("fold").alias("term"), "n").where(F.col("term") != "")


def mark(vocabulary: DataFrame, usage: DataFrame, n_records: int, rare_most: int = 2, common_percent: int = 90) -> DataFrame:
    """(term, n, records, kind): ``rare`` if n is at most ``rare_most``, else ``common`` if the term is
    in at least ``common_percent`` % of the records, else null. Terms are those of ``vocabulary``."""
    seen = usage.select("term", F.col("records").alias("_records"))
    out = vocabulary.select("term", "n").join(seen, "term", "left").withColumn("records", F.coalesce("_records", F.lit(0)))
    common = (F.col("records") * 100 >= n_records * common_percent) & F.lit(n_records > 0)
    return out.select("term", "n", "records", F.when(F.col("n") <= rare_most, "rare").when(common, "common").alias("kind"))


def p6_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every term of vocab with its total n, its number of country-years and its mark."""
    vocab, unigrams = table(spark, folder, "vocab"), table(spark, folder, "unigrams")
    listed = TermCounts(spark, scratch_path(spark, "vocab-counts"))
    listed.merge(signed(folded_terms(vocab, ["country"]), 1), ["country"])
    used = TermCounts(spark, scratch_path(spark, "unigram-counts"))
    used.merge(signed(folded_terms(unigrams, ["country", "year"]), 1), ["country", "year"])
    n = unigrams.select("country", "year").distinct().count()
    return mark(listed.read(), used.read(), n)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_counts(spark, folder).where(F.col("kind").isNotNull()).select(F.col("term").alias("fold"), "kind")


def p6_updated(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of unigrams after each country's last year is withdrawn and its first year is corrected (one more use
    of every term), by deltas of these records alone, one of them repeated."""
    record = ["country", "year"]
    rows = folded_terms(table(spark, folder, "unigrams"), record)
    ends = rows.groupBy("country").agg(F.min("year").alias("first"), F.max("year").alias("last"))
    marked = rows.join(F.broadcast(ends), "country")  # one row per country
    store = TermCounts(spark, scratch_path(spark, "updated-counts")).merge(signed(rows, 1), record, "all")
    gone = signed(marked.where(F.col("year") == F.col("last")).select(*record, "term", "n"), -1)
    old = marked.where((F.col("year") == F.col("first")) & (F.col("year") != F.col("last"))).select(*record, "term", "n")
    new = old.groupBy(*record, "term").agg((F.sum(F.coalesce("n", F.lit(0))) + 1).alias("n"))
    store.merge(gone, record, "withdrawn")
    for _ in range(2):  # the second time changes nothing
        store.merge(signed(old, -1).unionByName(signed(new, 1)), record, "corrected")
    return store.read()


_SQL = """
WITH v AS (
  SELECT trim(strip_accents(lower(fold))) AS term, sum(coalesce(n, 0))::BIGINT AS n FROM vocab
  WHERE trim(strip_accents(lower(fold))) <> '' GROUP BY 1),
u AS (
  SELECT trim(strip_accents(lower(fold))) AS term, count(DISTINCT (country, year)) AS records FROM unigrams GROUP BY 1),
c AS (SELECT count(DISTINCT (country, year)) AS total FROM unigrams),
m AS (
  SELECT term, n, coalesce(records, 0) AS records,
    CASE WHEN n <= 2 THEN 'rare' WHEN coalesce(records, 0) * 100 >= total * 90 THEN 'common' END AS kind
  FROM v LEFT JOIN u USING (term), c)
"""
_UPDATED_SQL = """
WITH u AS (
  SELECT country, year, trim(strip_accents(lower(fold))) AS term, sum(coalesce(n, 0)) AS n FROM unigrams
  WHERE trim(strip_accents(lower(fold))) <> '' GROUP BY ALL),
e AS (SELECT country, min(year) AS a, max(year) AS b FROM u GROUP BY 1)
SELECT term, sum(n + CASE WHEN year = a THEN 1 ELSE 0 END)::BIGINT AS n, count(*) AS records
FROM u JOIN e USING (country) WHERE year <> b GROUP BY 1
"""
QUERIES = {"p6_found": p6_found, "p6_counts": p6_counts, "p6_updated": p6_updated}
SQL = {"p6_found": _SQL + "SELECT term AS fold, kind FROM m WHERE kind IS NOT NULL", "p6_counts": _SQL + "SELECT * FROM m", "p6_updated": _UPDATED_SQL}
