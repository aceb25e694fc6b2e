"""Split a dotted view-object path into four levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LEVELS, VIEW_OBJECT


def path_levels(path: Column | str, n_levels: int = 4) -> list[Column]:
    """Level i is part i of ``path.split('.')``, else the last part.

    The third level (index 2) is '' when the path has exactly three parts;
    parts beyond the fourth are ignored.  A null path gives null levels.
    """
    path = F.col(path) if isinstance(path, str) else path
    parts = F.split(path, r"\.", -1)
    last = F.element_at(parts, -1)
    out = []
    for i in range(n_levels):
        level = F.coalesce(F.get(parts, F.lit(i)), last)
        if i == 2:
            level = F.when(F.size(parts) == 3, F.lit("")).otherwise(level)
        out.append(level)
    return out


def split_path(df: DataFrame, source: str = VIEW_OBJECT, names: Sequence[str] = LEVELS) -> DataFrame:
    """Append the level columns to ``df`` (one narrow projection, no shuffle)."""
    levels = path_levels(F.col(f"`{source}`"), len(names))
    return df.withColumns(dict(zip(names, levels)))
