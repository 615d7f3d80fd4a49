"""Functions over Arrow batches that give columns instead of batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

Columns = Mapping[str, object]


def map_columns(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[Columns]],
    schema: str | T.StructType,
) -> DataFrame:
    """``mapInArrow`` over a function that yields a mapping of columns for each output batch."""
    kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kinds)

    def column(values, kind: pa.DataType) -> pa.Array:
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(given):
            yield pa.RecordBatch.from_arrays(
                [column(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(batches, kinds)
