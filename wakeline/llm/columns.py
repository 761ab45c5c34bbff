"""Schema and record batch helpers for operators that pass all columns through Python."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def cleared(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame without columns of these names: an operator's output replaces an input column of its name."""
    return df.drop(*[c for c in df.columns if c in names])


def extended(df: DataFrame, fields: list[tuple[str, str]]) -> StructType:
    """The frame's schema plus the named fields."""
    more = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))
    return StructType(list(df.schema.fields) + list(more.fields))


def appended(batch: pa.RecordBatch, names: list[str], columns: list) -> pa.RecordBatch:
    """The batch with columns added at its end."""
    return pa.RecordBatch.from_arrays(list(batch.columns) + columns, list(batch.schema.names) + names)
