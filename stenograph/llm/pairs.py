"""Problem 5: items that appear together (heavy-light decomposition)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import one_per_key
from .terms import speech_rows, with_distinct

#: Items counted by bit matrix. Bounds what is sent to executors and each task's matrix of counts
#: (HEAVY^2 * 8 bytes = 2 MB); every other item is counted exactly by the light paths.
HEAVY = 512
#: Records of one bit block.
BLOCK = 8192


def bit_matrix_counts(batches: Iterable[pa.RecordBatch], names: list[str], column: str) -> np.ndarray:
    """Common-record counts of every pair of ``names``: one bit per record, rows ANDed, bits counted."""
    known = pa.array(names, pa.string())
    h = len(names)
    counts = np.zeros((h, h), dtype=np.int64)
    bits = np.zeros((h, BLOCK), dtype=bool)
    used = 0

    def flush() -> None:
        if not used:
            return
        packed = np.packbits(bits[:, :used], axis=1)
        pad = -packed.shape[1] % 8
        rows = np.ascontiguousarray(np.pad(packed, ((0, 0), (0, pad)))).view(np.uint64)
        for i in range(h):
            counts[i, i:] += np.bitwise_count(rows[i] & rows[i:]).sum(axis=1, dtype=np.int64)
        bits[:, :used] = False

    for batch in batches:
        array = batch.column(column)
        items = pc.index_in(array.flatten(), value_set=known)
        records = pc.list_parent_indices(array).to_numpy()
        present = items.is_valid().to_numpy(zero_copy_only=False)
        items = items.drop_null().to_numpy(zero_copy_only=False)
        records = records[present]
        begin = 0
        while begin < batch.num_rows:
            end = min(batch.num_rows, begin + BLOCK - used)
            here = (records >= begin) & (records < end)
            bits[items[here], records[here] - begin + used] = True
            used += end - begin
            begin = end
            if used == BLOCK:
                flush()
                used = 0
    flush()
    return counts


def item_pairs(baskets: DataFrame, key: str, items: str, n_records: int, least_together: int = 1, least_lift: float = 0.0, heavy: int = HEAVY) -> DataFrame:
    """(term_a, term_b, n_ab, n_a, n_b, lift) of pairs with ``term_a`` < ``term_b`` that occur together.

    ``baskets`` has one row per record with the array ``items`` of distinct values; it is read several
    times, so pass a stored table. A pair needs ``least_together`` common records and a lift
    n_ab * N / (n_a * n_b) of ``least_lift``. Two bounds lose nothing and cut most of the work: both
    items need ``least_together`` records, and since n_ab <= min(n_a, n_b), neither may have more than
    N / ``least_lift``.

    The ``heavy`` most frequent of the remaining items are counted against each other by dense bit
    matrices, merged once per task. Every light item's list of records is probed for the heavy items
    of the same records; these mixed pairs are combined map-side before their shuffle, so no task holds all
    records of an item. Pairs of light items are formed per record, piece by piece, and hash-counted.
    ``n_records`` may be any number up to 10^18.

    Null items are ignored; empty baskets count in N only; an empty table gives no rows.
    """
    spark = baskets.sparkSession
    if not 0 < heavy < 1 << 15:
        raise ValueError("heavy items are numbered in 15 bits")
    single = baskets.select(F.explode(items).alias("item")).where(F.col("item").isNotNull())
    most = n_records / least_lift if least_lift else float("inf")
    # Numbered once they are stored, so that numbers, not words, go through the shuffles below.
    counted = materialize(single.groupBy("item").agg(F.count("*").alias("n")).where((F.col("n") >= least_together) & (F.col("n") <= most)), "item-counts")
    frequency = materialize(counted.withColumn("id", F.monotonically_increasing_id()), "item-frequency")
    chosen = frequency.orderBy(F.desc("n"), "item").limit(heavy).collect()
    names = [r["item"] for r in chosen]
    sizes = [r["n"] for r in chosen]
    light_frequency = frequency.where((F.col("n") < sizes[-1]) | ((F.col("n") == sizes[-1]) & ~F.col("item").isin(names))) if len(sizes) == heavy else frequency.where(F.lit(False))

    schema = "a int, b int, n_ab bigint"

    def dense(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.triu(bit_matrix_counts(batches, names, items), 1)
        a, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[a, b])], names=["a", "b", "n_ab"])

    lookup = spark.createDataFrame([(k, w, n) for k, (w, n) in enumerate(zip(names, sizes))], "h int, item string, n bigint")
    heavy_pairs = (
        baskets.select(items).mapInArrow(dense, schema).groupBy("a", "b").agg(F.sum("n_ab").alias("n_ab")).where(F.col("n_ab") >= least_together)
        .join(F.broadcast(lookup.select(F.col("h").alias("a"), F.col("item").alias("x"), F.col("n").alias("nx"))), "a")
        .join(F.broadcast(lookup.select(F.col("h").alias("b"), F.col("item").alias("y"), F.col("n").alias("ny"))), "b")
        .select("x", "nx", "y", "ny", "n_ab")
    )

    parts = f"record {baskets.schema[key].dataType.simpleString()}, h array<smallint>, rest array<string>"
    known = names

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .arrow import lists

        index = pa.array(known, pa.string())
        for batch in batches:
            array = batch.column(items)
            flat = array.flatten()
            at = pc.index_in(flat, value_set=index)
            parent = pc.list_parent_indices(array).to_numpy()
            inside = at.is_valid().to_numpy(zero_copy_only=False)
            outside = ~inside & flat.is_valid().to_numpy(zero_copy_only=False)
            ids = lists(at.drop_null().cast(pa.int16()), np.bincount(parent[inside], minlength=batch.num_rows))
            rest = lists(flat.filter(pa.array(outside)), np.bincount(parent[outside], minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(key), ids, rest], names=["record", "h", "rest"])

    postings = materialize(
        baskets.select(key, items).mapInArrow(split, parts).select("record", "h", F.explode("rest").alias("item")).join(light_frequency.select("item", "id"), "item").drop("item"),
        "light-postings",
    )
    numbered = light_frequency.select(F.col("id"), F.col("item").alias("x"), F.col("n").alias("nx"))
    mixed = (
        postings.select("id", "h").mapInArrow(_mixed_counts, "id bigint, h smallint, n bigint").groupBy("id", "h").agg(F.sum("n").alias("n_ab")).where(F.col("n_ab") >= least_together)
        .join(F.broadcast(lookup.select(F.col("h").cast("smallint").alias("h"), F.col("item").alias("y"), F.col("n").alias("ny"))), "h")
        .join(numbered, "id").select("x", "nx", "y", "ny", "n_ab")
    )
    together = postings.groupBy("record").agg(F.sort_array(F.collect_list("id")).alias("l")).where(F.size("l") > 1)
    light = together.select("l").mapInArrow(_list_pairs, "a bigint, b bigint").groupBy("a", "b").agg(F.count("*").alias("n_ab")).where(F.col("n_ab") >= least_together)
    light = (
        light.join(numbered.withColumnRenamed("id", "a"), "a")
        .join(numbered.select(F.col("id").alias("b"), F.col("x").alias("y"), F.col("nx").alias("ny")), "b").select("x", "nx", "y", "ny", "n_ab")
    )
    swap = F.col("x") > F.col("y")
    out = heavy_pairs.unionByName(mixed).unionByName(light).select(
        F.when(swap, F.col("y")).otherwise(F.col("x")).alias("term_a"),
        F.when(swap, F.col("x")).otherwise(F.col("y")).alias("term_b"),
        "n_ab",
        F.when(swap, F.col("ny")).otherwise(F.col("nx")).alias("n_a"),
        F.when(swap, F.col("nx")).otherwise(F.col("ny")).alias("n_b"),
    )
    # Products of counts pass 2^63 at a few billion records: whole numbers of 38 digits, so the bound stays exact.
    whole = lambda c: c.cast("decimal(19,0)")
    common, product = whole(F.col("n_ab")) * whole(F.lit(n_records)), whole(F.col("n_a")) * whole(F.col("n_b"))
    enough = common >= product * F.lit(int(least_lift)).cast("decimal(9,0)") if float(least_lift).is_integer() else common.cast("double") >= product.cast("double") * least_lift
    return out.where(enough).withColumn("lift", common.cast("double") / product.cast("double"))


#: Mixed pairs that are held and counted together in a task before they go on.
_HELD = 1 << 22


def _mixed_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, h, n) of light items and the heavy ones of the same records, counted a few millions at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def counted() -> pa.RecordBatch:
        ids, codes = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        keys, n = np.unique(codes * (1 << 15) + np.concatenate([h for _, h in held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(ids[keys >> 15]), pa.array((keys & 0x7FFF).astype(np.int16)), pa.array(n)], names=["id", "h", "n"])

    for batch in batches:
        lists = batch.column("h")
        parents = pc.list_parent_indices(lists).to_numpy()
        held.append((batch.column("id").to_numpy()[parents], lists.flatten().to_numpy().astype(np.int64)))
        size += len(parents)
        if size >= _HELD:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


#: Pairs of one Arrow batch at most, so that a record of any length is handed on piece by piece.
_PAIRS_PER_BATCH = 1 << 18


def _list_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every pair of a record's sorted items, lower number first."""
    for batch in batches:
        array = batch.column("l")
        flat, offsets = array.flatten().to_numpy(), array.offsets.to_numpy()
        offsets = offsets - offsets[0]
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for begin, end in zip(offsets[:-1], offsets[1:]):
            n = int(end - begin)
            step = max(1, _PAIRS_PER_BATCH // max(n, 1))
            for low in range(0, n - 1, step):
                high = min(low + step, n - 1)
                counts = np.arange(n - 1 - low, n - 1 - high, -1)  # partners of each first item
                first = np.repeat(np.arange(low, high), counts)
                second = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts) + first + 1
                held.append((flat[begin + first], flat[begin + second]))
                size += len(first)
                if size >= _PAIRS_PER_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["a", "b"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["a", "b"])


def speech_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """One row per speech row (``id_int``) with its distinct content words; stored."""
    rows = one_per_key(speech_rows(spark, folder, ["row_n", "text"]), "id_int", "row_n", ["id_int", "text"], payload=True)
    return materialize(with_distinct(rows), "baskets")


def p5_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of words with at least 8 common speech rows and 20 times as many as by chance."""
    baskets = speech_baskets(spark, folder)
    return item_pairs(baskets, "id_int", "words", baskets.count(), least_together=8, least_lift=20)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_pairs(spark, folder).select("term_a", "term_b")


_SQL = r"""
WITH rows AS (
  SELECT DISTINCT ON (id_int) id_int, text FROM interventions WHERE dm_speech = 1 ORDER BY id_int, row_n),
size AS (SELECT count(*) AS big_n FROM rows),
w AS (SELECT DISTINCT id_int, unnest(regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+')) AS t FROM rows),
u AS (SELECT * FROM w WHERE length(t) >= 4 AND regexp_full_match(t, '\p{L}+')),
f AS (SELECT t, count(*) AS n FROM u GROUP BY 1 HAVING count(*) >= 8),
k AS (SELECT u.*, n FROM u JOIN f USING (t)),
p AS (
  SELECT a.t AS term_a, b.t AS term_b, count(*) AS n_ab, any_value(a.n) AS n_a, any_value(b.n) AS n_b
  FROM k a JOIN k b ON a.id_int = b.id_int AND a.t < b.t GROUP BY 1, 2)
"""
_WHERE = "FROM p, size WHERE n_ab >= 8 AND n_ab * big_n >= 20 * n_a * n_b"
QUERIES = {"p5_found": p5_found, "p5_pairs": p5_pairs}
SQL = {
    "p5_found": _SQL + "SELECT term_a, term_b " + _WHERE,
    "p5_pairs": _SQL + "SELECT term_a, term_b, n_ab, n_a, n_b, n_ab * big_n / (n_a * n_b) AS lift " + _WHERE,
}
