"""Readers of the canonical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; Catalyst pushes filters and columns into the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt over the cores; a larger one as it is.

    For work that costs more than moving the rows (texts read by Python or by regular expressions), where a
    small table of one row group would otherwise be one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Repeated keys that may be sent to executors; with more of them a bitmap of bounded size is sent instead.
SENT_KEYS = 200_000
#: Bits of that bitmap at most (2^28 bits are 32 MB), and bits for each repeated key.
BITS, BITS_PER_KEY = 1 << 28, 16
_PAGE = 1 << 15  # bits of one row of Spark's bitmaps


def one_per_key(df: DataFrame, key: str, order: str, keep: list[str], payload: bool = False) -> DataFrame:
    """One row per ``key``, the one lowest in ``order``; rows with a null key are dropped.

    A group-by rather than a window, so that many copies of one key are combined before the shuffle.
    Ties in ``order`` go to the smallest remaining values. With ``payload`` (texts or other wide columns) only
    keys are shuffled first, and then none but the rows of repeated keys; see ``_keys_first``.
    """
    rows = df.where(F.col(key).isNotNull())
    return _keys_first(rows, key, order, keep) if payload else _grouped(rows, key, order, keep)


def _grouped(rows: DataFrame, key: str, order: str, keep: list[str]) -> DataFrame:
    rest = [c for c in keep if c != key]
    if not rest:
        return rows.select(key).distinct()
    chosen = F.min_by(F.struct(*rest), F.struct(F.col(order).isNull(), F.col(order), *[F.col(c) for c in rest]))
    return rows.groupBy(key).agg(chosen.alias("_row")).select(key, "_row.*").select(*keep)


def _keys_first(rows: DataFrame, key: str, order: str, keep: list[str]) -> DataFrame:
    """``_grouped`` without a shuffle of all rows: the keys that occur twice or more are found from the key column.

    Up to SENT_KEYS of them are broadcast with their lowest ``order``, and one scan drops the other rows; keys with
    three rows or more, or with a tie, are grouped. Beyond that a bitmap of hashed keys, BITS at most, tells
    which rows can have copies; those are grouped, the others pass. So what is sent is bounded at any size, and a
    full bitmap costs time, never rows.
    """
    first = F.struct(F.col(order).isNull().alias("absent"), F.col(order).alias("order"))
    counted = rows.select(key, order).groupBy(key).agg(F.count("*").alias("_n"), F.min(first).alias("_first"), F.max(first).alias("_last"))
    copies = materialize(counted.where(F.col("_n") > 1).select(key, "_first", ((F.col("_n") > 2) | (F.col("_first") == F.col("_last"))).alias("_many")), "repeated-keys")
    sizes = copies.agg(F.count("*").alias("n"), F.count_if("_many").alias("many")).first()
    if not sizes["n"]:
        return rows.select(*keep)
    if sizes["n"] <= SENT_KEYS:
        joined = rows.join(F.broadcast(copies), key, "left")
        lowest = F.col("_first.absent").eqNullSafe(F.col(order).isNull()) & F.col("_first.order").eqNullSafe(F.col(order))
        single = joined.where(F.col("_first").isNull() | (~F.col("_many") & lowest)).select(*keep)
        if not sizes["many"]:
            return single
        return single.unionByName(_grouped(rows.join(F.broadcast(copies.where("_many").select(key)), key, "left_semi"), key, order, keep))
    pages = max(1, min(BITS, sizes["n"] * BITS_PER_KEY) // _PAGE)
    place = F.pmod(F.xxhash64(key), F.lit(pages * _PAGE))
    bits = F.broadcast(copies.groupBy(F.floor(place / _PAGE).alias("_page")).agg(F.bitmap_construct_agg(F.pmod(place, F.lit(_PAGE))).alias("_bits")))
    joined = rows.withColumn("_place", place).withColumn("_page", F.floor(F.col("_place") / _PAGE)).join(bits, "_page", "left")
    bit = F.pmod("_place", F.lit(_PAGE)).cast("int")
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(pmod(_place, 32768) AS INT) DIV 8 + 1, 1)")), 16, 10).cast("int")
    maybe = F.coalesce(F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return joined.where(~maybe).select(*keep).unionByName(_grouped(joined.where(maybe).select(*rows.columns), key, order, keep))
