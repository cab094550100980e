"""Arrow-batch helpers: whole columns in, whole columns out, nothing per row through pickling."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str | T.StructType) -> DataFrame:
    """Apply ``function`` to every Arrow batch; it returns the output columns by name."""
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                yield pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def lists(flat: pa.Array, lengths: list[int]) -> pa.ListArray:
    """A list column from its flattened values and the length of each list."""
    import numpy as np

    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), flat)
