"""Null handling: text nulls to '' (R7) and dropping columns that hold a null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fill_text(df: DataFrame, value: str = "") -> DataFrame:
    """Null -> '' on string columns only; numeric nulls stay null."""
    return df.na.fill(value)


def _missing(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_columns(df: DataFrame) -> list[str]:
    """Names of columns holding at least one null (or NaN) — one aggregate pass, one row back."""
    fields = df.schema.fields
    if not fields:
        return []
    row = df.agg(*[F.max(F.when(_missing(f), 1).otherwise(0)).alias(f"c{i}") for i, f in enumerate(fields)]).first()
    return [f.name for i, f in enumerate(fields) if row[f"c{i}"]]


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Keep only the columns without any null/NaN (pandas ``dropna(axis=1)``).

    The decision needs one aggregate pass (its result is one row of 0/1
    flags, independent of the data size); the projection itself is lazy.
    """
    drop = set(null_columns(df))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in drop])
