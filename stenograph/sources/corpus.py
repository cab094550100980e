"""Loading corpora: CSV scans, the canonical projection, word indexes, partitioned import, catalog, guarded SQL and export."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import MARKED_WORD, count_words, fold

CANONICAL = ["id_session", "id_int", "legislature", "legislative_session", "session_number", "date", "session_type", "intervention_order", "speaker_raw", "id_dep", "speaker_name", "sex", "party", "district", "dm_speech", "text"]


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The separator that occurs most in a file's first line."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0][0] if head else ""
    return max(",;\t|", key=lambda s: (line.count(s), s == ","))


def read_csv(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Every column as string; quoted fields may span lines and hold doubled quotes.

    Such fields make a file one task, since a line end may lie inside a field: a large table should come as many files.
    """
    sep = separator or sniff_separator(spark, path)
    return spark.read.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=True, inferSchema=False)


def resolve_aliases(raw: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Rename, for each canonical column, the fullest of its alias columns (ties: the first listed)."""
    names = [a for options in aliases.values() for a in options if a in raw.columns]
    full = raw.agg(*[F.count_if(F.trim(F.col(n)) != "").alias(n) for n in names]).first() if names else {}
    out = raw
    for target, options in aliases.items():
        there = [a for a in options if a in raw.columns]
        if there:
            best = max(there, key=lambda a: (full[a], -there.index(a)))
            out = out.withColumnRenamed(best, target) if best != target else out
    return out


def canonical(raw: DataFrame, country: str) -> DataFrame:
    """The canonical projection of an all-string table: casts that give null instead of failing, word counts."""
    col = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    casts = {"date": "date", "intervention_order": "int", "dm_speech": "tinyint"}
    out = raw.select(F.lit(country).alias("country"), *[col(c).try_cast(casts[c]).alias(c) if c in casts else col(c).alias(c) for c in CANONICAL])
    return out.withColumn("n_words", count_words("text"))


def number_rows(df: DataFrame) -> DataFrame:
    """``row_n`` 1..n in reading order, without bringing rows together: positions within a partition plus its offset."""
    # A row's number is its place in its partition plus the sizes of the partitions before; both come from one plan
    # over the same splits. No row leaves the JVM; the sizes (one number a split) go over the driver.
    placed = df.drop("row_n").withColumn("_split", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted((r["_split"], r["count"]) for r in placed.groupBy("_split").count().collect())
    before, rows = 0, []
    for split, n in sizes:
        rows.append((split, before))
        before += n
    offsets = df.sparkSession.createDataFrame(rows or [(0, 0)], "_split int, _before bigint")
    return placed.join(F.broadcast(offsets), "_split").withColumn("row_n", F.col("_before") + F.col("_at") + 1).drop("_split", "_at", "_before")


def order_digest(df: DataFrame, key: str, by: str = "row_n") -> str:
    """SHA-256 over the digests of 100,000-row blocks of keys in order: equal for equal key sequences."""
    blocks = df.groupBy((F.col(by) / 100_000).cast("bigint").alias("b")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, key))), lambda s: F.coalesce(s[key], F.lit(""))), "\n"), 256).alias("d"))
    level = lambda g: g.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))), lambda s: s["d"]), ""), 256).alias("d"))
    # 100,000 blocks are brought together first, so no row holds more digests than that up to 10^15 rows.
    return level(level(blocks.groupBy(F.floor(F.col("b") / 100_000).alias("c"))).withColumnRenamed("c", "b")).first()[0]


def import_country(df: DataFrame, path: str) -> None:
    """Replace the partitions of the countries in ``df``; other countries' partitions stay untouched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("country").parquet(path)


def remove_country(spark: SparkSession, path: str, country: str) -> None:
    """Drop one country's partition."""
    if not re.fullmatch(r"[A-Z]{2}", country):
        raise ValueError("a country is two capital letters")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/country={country}")
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def index_unigrams(rows: DataFrame) -> DataFrame:
    """(country, year, sex, fold, n): yearly word counts of dated speech rows."""
    w = rows.where((F.col("dm_speech") == 1) & F.col("date").isNotNull()).select("country", F.year("date").cast("smallint").alias("year"), "sex", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(MARKED_WORD), F.lit(0))).alias("word"))
    # Distinct spellings are folded, not every token.
    spelled = w.groupBy("country", "year", "sex", "word").agg(F.count("*").alias("k"))
    return spelled.groupBy("country", "year", "sex", fold("word").alias("fold")).agg(F.sum("k").alias("n"))


def index_vocab(rows: DataFrame) -> DataFrame:
    """(country, fold, word, n): each folded word with its commonest spelling; ties to the first in the alphabet."""
    w = rows.where(F.col("dm_speech") == 1).select("country", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(MARKED_WORD), F.lit(0))).alias("word"))
    spelled = w.groupBy("country", "word").agg(F.count("*").alias("k"))
    return spelled.groupBy("country", fold("word").alias("fold")).agg(F.min_by("word", F.struct(-F.col("k"), "word")).alias("word"), F.sum("k").alias("n"))


def catalog(rows: DataFrame, datasets: DataFrame) -> DataFrame:
    """Each dataset with its real counts and span beside what it declares."""
    real = rows.groupBy("country").agg(F.count("*").alias("turns"), F.countDistinct("id_session").alias("sessions"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return datasets.select("country", "version", "n_rows").join(real, "country", "left").withColumn("stale", ~F.col("n_rows").eqNullSafe(F.col("turns")))


class RefusedQuery(ValueError):
    """The statement isn't a single read of registered tables."""


def guarded_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame], max_rows: int = 10_000) -> tuple[DataFrame, bool]:
    """Run one SELECT over the given tables only; the rows (at most ``max_rows``) and whether more were cut.

    The statement is parsed, not searched: any plan but a query, any relation that isn't one of the
    tables or a CTE (files, catalogs) and any call into the JVM is refused.
    """
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        plan = parser.parsePlan(sql)
    except Exception as e:
        raise RefusedQuery(str(e).splitlines()[0]) from None
    text = plan.toString()
    if re.search(r"^'?(?:Create|Insert|Drop|Alter|Set|Add|Cache|Refresh|Describe|Show|Explain|Use|Truncate|Delete|Update|Merge|Replace|Clear|Reset|Load|Repair|Unresolved(?:Namespace|Identifier)\b)", text.strip()) or "Command" in text:
        raise RefusedQuery("only SELECT is allowed")
    ctes = set(re.findall(r"(?:WITH|,)\s*(\w+)\s*(?:\([^)]*\))?\s*AS\s*\(", sql, re.IGNORECASE))
    for name in re.findall(r"UnresolvedRelation \[([^\]]*)\]", text):
        if name not in tables and name not in ctes:
            raise RefusedQuery(f"unknown table {name}")
    if re.search(r"(?i)\b(?:java_method|reflect|try_reflect|input_file_name|read_files|transform\s*\()", sql) or "UnresolvedTableValuedFunction" in text:
        raise RefusedQuery("this function is not allowed")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        out = spark.sql(sql)
    except Exception as e:
        raise RefusedQuery(str(e).splitlines()[0]) from None
    cut = out.limit(max_rows + 1)
    return cut.limit(max_rows), cut.count() > max_rows


def qualify(df: DataFrame, partition: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each partition (SQL's QUALIFY row_number() <= k)."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def export(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Write a result as CSV or Parquet; an existing target is refused."""
    if form not in ("csv", "parquet"):
        raise ValueError("csv or parquet")
    writer = df.write.mode("error")
    writer.option("header", True).csv(path) if form == "csv" else writer.parquet(path)
