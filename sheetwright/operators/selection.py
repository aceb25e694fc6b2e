"""Column subsets (R9, R10), the primary-key predicate (R11) and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import PK_FLAG
from .nulls import fill_text


def non_flag_columns(df: DataFrame, flags: Sequence[str]) -> list[str]:
    """All columns that are not flags, in table order."""
    skip = set(flags)
    return [c for c in df.columns if c not in skip]


def select_columns(df: DataFrame, cols: str | Sequence[str] | None = None) -> DataFrame:
    """Select by name: nothing = all columns, one name, or several names."""
    names = [cols] if isinstance(cols, str) else list(cols or ["*"])
    return df.select(*["*" if n == "*" else f"`{n}`" for n in names])


def select_from(spark: SparkSession, name: str, cols: str | Sequence[str] | None = None) -> DataFrame:
    """Columns of a stored table or view, text nulls shown as ''."""
    return fill_text(select_columns(spark.table(name), cols))


def pk_rows(df: DataFrame, flag: str = PK_FLAG) -> DataFrame:
    """Rows flagged as primary-key columns."""
    return df.filter(F.col(f"`{flag}`") == 1)


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL over stored tables and views, text nulls shown as '' (R13)."""
    return fill_text(spark.sql(sql))
