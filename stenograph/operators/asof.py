"""Attributes as they were known at an event's time (bitemporal as-of join)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

DAY = 86400
#: Bounds how many pieces one interval can be exploded into, whatever the span of dates.
MAX_BUCKETS = 4096


def flexible_date(text: Column) -> Column:
    """A date written ``YYYY-MM-DD`` or ``DD/MM/YYYY``; anything else, null or blank gives null."""
    clean = F.trim(text.cast("string"))
    return F.coalesce(
        F.when(clean.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(clean, F.lit("yyyy-MM-dd")).cast("date")),
        F.when(clean.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_timestamp(clean, F.lit("dd/MM/yyyy")).cast("date")),
    )


def validity_intervals(
    changes: DataFrame,
    entity: list[str],
    valid_from: str,
    valid_to: str,
    known_from: str,
    priority: list[str],
    attributes: list[str],
    span: tuple[int, int],
    bucket_days: int = 64,
) -> DataFrame:
    """Disjoint half-open intervals with the one change that wins in each, cut at bucket bounds.

    A change is active on the days ``max(valid_from, known_from) <= day < valid_to + 1``; a null
    ``valid_to`` is open, a null start or knowledge date never becomes active. Between two successive
    change times of an entity the active change highest in ``priority`` (then its attributes) wins.

    Work is keyed by (entity, bucket), never by entity alone, so an entity that holds most of the
    changes is spread over its buckets, and a bucket's changes are swept once, not compared with each other. Columns: entity, ``_bucket``, ``_from``, ``_to`` (day
    numbers), attributes. Days with no active change are left out.
    """
    first, last = span
    day = lambda c: F.unix_date(F.col(c))
    start = F.when(F.col(valid_from).isNotNull() & F.col(known_from).isNotNull(), F.greatest(day(valid_from), day(known_from), F.lit(first)))
    end = F.least(F.coalesce(day(valid_to) + 1, F.lit(last + 1)), F.lit(last + 1))
    rows = (
        changes.select(*entity, start.alias("_lo"), end.alias("_hi"), F.struct(*priority, *attributes).alias("_rank"), F.struct(*attributes).alias("_attr"))
        .where(F.col("_lo") < F.col("_hi"))
        .withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_lo") / bucket_days), F.floor((F.col("_hi") - 1) / bucket_days))))
        .withColumn("_lo", F.greatest("_lo", F.col("_bucket") * bucket_days))
        .withColumn("_hi", F.least("_hi", (F.col("_bucket") + 1) * bucket_days))
    )
    key = [*entity, "_bucket"]
    laid = rows.repartition(*key).sortWithinPartitions(*key, F.desc("_rank")).select(*key, F.col("_lo").cast("bigint").alias("_lo"), F.col("_hi").cast("bigint").alias("_hi"), *[F.col(f"_attr.{a}").alias(a) for a in attributes])
    kinds = {f.name: f.dataType.simpleString() for f in laid.schema}
    names = [*key, "_from", "_to", *attributes]
    schema = ", ".join(f"`{n}` {kinds.get(n, 'bigint')}" for n in names)
    return laid.mapInArrow(_swept(len(key), names, schema), schema)


def _swept(n_key: int, names: list[str], schema: str):
    """Rows of (key, lo, hi, attributes), by key and falling priority, as the steps between the times of their key.

    Each row takes the steps in its span that nothing before it took. A pointer leads from every step to the next
    free one, so each step is taken once and passed over at most once more: the work is that of sorting, however many
    changes one key has.
    """
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def steps(rows: list[tuple]) -> Iterator[tuple]:
        times = sorted({r[n_key] for r in rows} | {r[n_key + 1] for r in rows})
        at = {t: k for k, t in enumerate(times)}
        free = list(range(len(times)))  # the first free step from here on; the last time begins none

        def first(k: int) -> int:
            end = k
            while free[end] != end:
                end = free[end]
            while free[k] != end:
                free[k], k = end, free[k]
            return end

        for r in rows:
            k, stop = first(at[r[n_key]]), at[r[n_key + 1]]
            while k < stop:
                yield (*r[:n_key], times[k], times[k + 1], *r[n_key + 2 :])
                free[k] = k + 1
                k = first(k + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:n_key] != key:
                    out += steps(held) if held else ()
                    key, held = r[:n_key], []
                held.append(r)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        out += steps(held) if held else ()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return run


def attributes_as_of(
    events: DataFrame,
    changes: DataFrame,
    event_entity: list[str],
    event_date: str,
    change_entity: list[str],
    valid_from: str,
    valid_to: str,
    known_from: str,
    priority: list[str],
    attributes: list[str],
    prefix: str = "known_",
    bucket_days: int = 64,
    how: str = "left",
) -> DataFrame:
    """Each event with the attributes valid, and already on record, on its date.

    Validity intervals come from successive change times (``validity_intervals``); events and
    intervals are equi-joined by entity and time bucket, and the event's day must lie in the
    half-open interval. The intervals of an entity don't overlap, so an event matches at most one and
    no later de-duplication is needed. A busy entity's events are spread over its buckets.

    Events with a null date or entity, or without an active change, keep null attributes (``how`` =
    "left") or are dropped ("inner"). Attribute columns are prefixed; a column of ``events`` that
    already has such a name is replaced. An empty table of changes or events gives a result with the same columns.
    """
    bounds = events.agg(F.min(F.unix_date(event_date)).alias("a"), F.max(F.unix_date(event_date)).alias("b")).first()
    first, last = (bounds["a"], bounds["b"]) if bounds["a"] is not None else (0, 0)
    width = max(bucket_days, -(-(last - first + 1) // MAX_BUCKETS))
    ranges = validity_intervals(changes, change_entity, valid_from, valid_to, known_from, priority, attributes, (first, last), width)
    right = ranges.select(
        *[F.col(c).alias(f"_r{k}") for k, c in enumerate(change_entity)],
        F.col("_bucket").alias("_rb"),
        F.col("_from").alias("_rf"),
        F.col("_to").alias("_rt"),
        *[F.col(a).alias(f"{prefix}{a}") for a in attributes],
    )
    events = events.drop(*[f"{prefix}{a}" for a in attributes], "_rb", "_rf", "_rt", *[f"_r{k}" for k in range(len(event_entity))])
    at = F.unix_date(F.col(event_date))
    on = (F.floor(at / width) == F.col("_rb")) & (F.col("_rf") <= at) & (at < F.col("_rt"))
    for k, c in enumerate(event_entity):
        on = on & (F.col(c) == F.col(f"_r{k}"))
    return events.join(right, on, how).drop("_rb", "_rf", "_rt", *[f"_r{k}" for k in range(len(event_entity))])


def same_label(a: Column, b: Column) -> Column:
    """Whether two labels agree when case, dots and outer spaces are ignored; nulls equal blanks."""
    clean = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\.", "")))
    return clean(a) == clean(b)
