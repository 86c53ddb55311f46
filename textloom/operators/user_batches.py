"""User functions on column batches.

For what built-in expressions cannot say. The function gets a dict of lists, one
list per column, and returns such a dict; the number of rows may differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BatchFunction = Callable[..., Mapping[str, list]]


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def map_batches(df: DataFrame, function: BatchFunction, schema: T.StructType | str,
                batch_size: int = 10_000, fn_kwargs: Mapping | None = None,
                remove_columns: list[str] | None = None) -> DataFrame:
    """Apply ``function`` to batches of ``batch_size`` rows.

    Rows are carried over from one Arrow batch to the next: whatever the session's
    limits for those, only the last batch of a partition may be shorter. ``schema``
    describes the columns that the function returns. Columns that are neither in it nor in
    ``remove_columns`` stay; all must be removed if the number of rows changes.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    produced = _as_schema(schema)
    removed = set(remove_columns or ()) | set(produced.fieldNames())
    kept = [field for field in df.schema.fields if field.name not in removed]
    out_schema = T.StructType(kept + produced.fields)
    arrow_schema = to_arrow_schema(out_schema)
    kept_names = [field.name for field in kept]
    kwargs = dict(fn_kwargs or {})

    def as_columns(held: list[pa.RecordBatch]) -> dict[str, list]:
        """The rows held, as lists; the Arrow batches are let go."""
        columns = pa.Table.from_batches(held).to_pydict()
        held.clear()
        return columns

    def full_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        held: list[pa.RecordBatch] = []
        missing = batch_size
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, missing)
                batch = batch.slice(part.num_rows)
                held.append(part)
                missing -= part.num_rows
                del part
                if missing == 0:
                    yield as_columns(held)
                    missing = batch_size
        if held:
            yield as_columns(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in full_batches(batches):
            result = function(columns, **kwargs)
            values = {**{name: columns[name] for name in kept_names}, **result}
            done = pa.RecordBatch.from_pydict(values, schema=arrow_schema)
            del columns, result, values         # one batch of rows at a time, not the last one beside the next
            yield done

    return df.mapInArrow(run, out_schema)
