"""Running batch functions that add columns to each row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harborlight.session import ship


def spare(name: str, columns: list[str]) -> str:
    """The name, or it with underscores before it, that no column has in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def add_columns(df: DataFrame, text: str, fields: list[T.StructField], function: Callable[..., list[pa.Array]], also: tuple[str, ...] = ()) -> DataFrame:
    """df with `fields` computed from its `text` column and the `also` columns, batch by batch and without a shuffle.

    Columns of df that have the name of a new field are replaced.
    """
    names = {f.name.lower() for f in fields}
    kept = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in names or c == text or c in also])
    schema = T.StructType([f for f in kept.schema.fields if f.name.lower() not in names] + fields)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = function(*[batch.column(batch.schema.get_field_index(c)) for c in (text, *also)])
            old = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n.lower() not in names]
            yield pa.RecordBatch.from_arrays([c for _, c in old] + new, [n for n, _ in old] + [f.name for f in fields])

    return kept.mapInArrow(run, schema)
