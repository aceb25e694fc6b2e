"""Yes/No flags (R1) and dropping rows that are not fully flagged (R2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import NO, YES


def yes_no(c: Column | str) -> Column:
    """'Yes' -> 1, 'No' -> 0, anything else (case, spaces, blanks, null) -> null. Exact match."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == F.lit(YES), F.lit(1)).when(c == F.lit(NO), F.lit(0)).cast("int")


def yes_no_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Turn every flag column into int 1/0/null in one projection."""
    return df.withColumns({f: yes_no(F.col(f"`{f}`")) for f in flags})


def drop_incomplete(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Drop rows where any flag is null (R2); this also removes preamble, header and blank lines."""
    return df.dropna(how="any", subset=list(flags))
