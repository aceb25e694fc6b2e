"""Object rollup (A1), primary-key view (J1) and the primary-key catalogue.

Plan shape (see README "Scale"):

* rollup: one hash aggregate on the four levels, partial (map-side) + final.
* PK view: the left outer join "rollup LEFT JOIN pk rows" is written as
  ``pk rows INNER JOIN rollup`` plus ``rollup rows without PK``.  Both are
  exactly the outer join (an object has no PK row iff its PK sum is 0), but
  the inner form lets AQE broadcast the (aggregated) rollup or split a hot
  object's PK rows across tasks; a left outer join could not split the
  preserved side's partner.  The join is null-safe with a null-key flag
  from the aggregate, so both branches share one rollup exchange.
* catalogue: one scan and one aggregate per (object, table) with its counts
  and its PK entries, shared by all branches.  The object's totals are an
  aggregate of its counts; they join the narrow rows (object, table), and
  these the lists, which stay where the aggregate put them: no list is
  shuffled by object, so a hot object over many tables is spread by table.
  A list record is one value, so its list is as long as the group has PK
  rows; ``pk_entries`` has the same entries as rows, each with its exact
  position, for groups too large for one record.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ATTRIBUTE, CATALOGUE_ORDER, COL_CNT, COL_CNT_PK, COLUMN, LEVELS, PK_FLAG, ROW_INDEX, SHEET, TABLE
from .selection import pk_rows


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _null_key(levels: Sequence[str]) -> Column:
    return reduce(or_, [F.col(f"`{lv}`").isNull() for lv in levels])


def _position(mappings: DataFrame) -> list[str]:
    """What orders the rows of a group: the sheet (where there are several), the position in it, and the texts."""
    return [SHEET] * (SHEET in mappings.columns) + [ROW_INDEX, ATTRIBUTE, COLUMN]


def object_rollup(mappings: DataFrame, levels: Sequence[str] = LEVELS, flag: str = PK_FLAG) -> DataFrame:
    """COUNT(*) as colCnt and the 64-bit sum of the PK flag as colCntPK, per object (A1)."""
    return mappings.groupBy(*_cols(levels)).agg(
        F.count(F.lit(1)).alias(COL_CNT),
        F.sum(F.col(f"`{flag}`")).cast("long").alias(COL_CNT_PK),
    )


def pk_view(mappings: DataFrame, levels: Sequence[str] = LEVELS, flag: str = PK_FLAG,
            keep_row_index: bool = True) -> DataFrame:
    """Every object's rollup with each of its PK rows; one row with nulls when it has none.

    The join uses null-safe equality plus a "key has a null" flag computed
    by the aggregate: rows with a null level never match (as with ``=``),
    Spark infers no not-null filters for one branch only, and so both
    branches read the very same rollup (one shared exchange).
    """
    levels = list(levels)
    rollup = mappings.groupBy(*_cols(levels)).agg(
        F.count(F.lit(1)).alias(COL_CNT),
        F.sum(F.col(f"`{flag}`")).cast("long").alias(COL_CNT_PK),
        F.max(_null_key(levels)).alias("_nullKey"),
    )
    carried = [ATTRIBUTE, TABLE, COLUMN] + ([ROW_INDEX] if keep_row_index else [])
    pk = pk_rows(mappings, flag).select(*_cols(levels + carried))
    r, p = rollup.alias("r"), pk.alias("p")
    cond = [F.col(f"r.`{lv}`").eqNullSafe(F.col(f"p.`{lv}`")) for lv in levels]
    with_pk = r.filter(~F.col("r._nullKey")).join(p, on=cond, how="inner").select(
        *[F.col(f"r.`{lv}`") for lv in levels], F.col(f"r.{COL_CNT}"), F.col(f"r.{COL_CNT_PK}"),
        *[F.col(f"p.`{c}`") for c in carried])
    types = dict(pk.dtypes)
    without = rollup.filter((F.coalesce(F.col(COL_CNT_PK), F.lit(0)) == 0) | F.col("_nullKey")).select(
        *_cols(levels + [COL_CNT, COL_CNT_PK]), *[F.lit(None).cast(types[c]).alias(c) for c in carried])
    return with_pk.unionByName(without)


def pk_lists(mappings: DataFrame, levels: Sequence[str] = LEVELS, flag: str = PK_FLAG) -> DataFrame:
    """Rows, PK rows and the ordered attribute/column lists of the PK rows per (object, table) (A2).

    Lists are sorted by sheet, rowIndex, attribute and column, so ties in
    rowIndex cannot change the order; they are empty where no row is flagged.
    """
    return _grouped_lists(mappings, [*levels, TABLE], flag)


def _grouped_lists(mappings: DataFrame, group: Sequence[str], flag: str) -> DataFrame:
    is_pk = F.col(f"`{flag}`") == 1
    entry = F.struct(*_cols(_position(mappings)))
    grouped = mappings.groupBy(*_cols(group)).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col(f"`{flag}`")).cast("long").alias("_npk"),
        F.sort_array(F.collect_list(F.when(is_pk, entry))).alias("_l"),
    )
    return grouped.select(
        *_cols([*group, "_n", "_npk"]),
        F.transform("_l", lambda e: e[ATTRIBUTE]).alias("cols"),
        F.transform("_l", lambda e: e[COLUMN]).alias("colsDB"),
    )


def pk_catalogue(mappings: DataFrame, levels: Sequence[str] = LEVELS, flag: str = PK_FLAG) -> DataFrame:
    """One record per (object, table) with its ordered PK attribute and column lists.

    Objects without any PK row (or with a null level, which joins nothing)
    give one record whose table and lists are null (A4); ``colCnt`` and
    ``colCntPK`` are always the object's totals.  Only tables with PK rows
    are listed.
    """
    levels = list(levels)
    # keys as records are never null themselves: no filter is inferred for one branch only, and equal nulls are equal
    keyed = mappings.select("*", F.struct(*_cols(levels)).alias("_key"), F.struct(F.col(f"`{TABLE}`").alias("t")).alias("_table"))
    groups = _grouped_lists(keyed, ["_key", "_table"], flag)
    # one expression over the list, so that no part of it moves below the aggregate in one branch only
    listed = F.when(reduce(or_, [F.col("_key").getField(lv).isNull() for lv in levels]), 0).otherwise(F.size("cols")) > 0
    # every branch reads all columns of a group, so that all share one aggregate and one scan
    whole = (F.col("_n") >= F.size("cols")) & (F.size("cols") == F.size("colsDB")) & (F.col("_npk").isNotNull() | (F.size("cols") >= 0))
    narrow = groups.where(whole).select("_key", "_table", "_n", "_npk", listed.alias("_listed"))
    totals = narrow.groupBy("_key").agg(F.sum("_n").alias(COL_CNT), F.sum("_npk").alias(COL_CNT_PK), F.max("_listed").alias("_any"))
    tables = narrow.where("_listed").select("_key", "_table").join(
        totals.where("_any").select("_key", COL_CNT, COL_CNT_PK), "_key")
    lists = groups.where(whole & listed).select("_key", "_table", "cols", "colsDB")
    records = lists.join(tables.hint("shuffle_hash"), ["_key", "_table"])
    has_pk = F.coalesce(F.col(COL_CNT_PK), F.lit(0)) != 0
    shown = {TABLE: F.when(has_pk, F.col("_table.t")), "cols": F.when(has_pk, F.col("cols")), "colsDB": F.when(has_pk, F.col("colsDB"))}
    none = {TABLE: F.lit(None).cast(dict(mappings.dtypes)[TABLE])} | {c: F.lit(None).cast(dict(groups.dtypes)[c]) for c in ("cols", "colsDB")}

    def fields(own: dict) -> list[Column]:
        out = {lv: F.col("_key").getField(lv) for lv in levels} | {COL_CNT: F.col(COL_CNT), COL_CNT_PK: F.col(COL_CNT_PK)} | own
        return [out[c].alias(c) for c in (*levels, *CATALOGUE_ORDER[len(LEVELS):])]

    return records.select(*fields(shown)).unionByName(totals.where("NOT _any").select(*fields(none)))


def pk_entries(mappings: DataFrame, levels: Sequence[str] = LEVELS, flag: str = PK_FLAG,
               bucket_width: int = 100_000) -> DataFrame:
    """The catalogue's lists as rows: one per PK entry with its exact 0-based position in its list.

    Rows are numbered inside buckets of ``bucket_width`` sheet positions, and
    running totals over the (small) bucket counts of a group shift each
    bucket, so no task sees a whole group.  All keys are data values: the
    result does not depend on partitioning or retries.
    """
    keys = [*levels, TABLE]
    order = _position(mappings)
    place = [c for c in order if c == SHEET] + ["_b"]
    rows = pk_rows(mappings, flag).select(*_cols(keys + order)).withColumn("_b", F.floor(F.col(ROW_INDEX) / bucket_width))
    counts = rows.groupBy(*_cols(keys + place)).agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(*_cols(keys)).orderBy(*_cols(place)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*_cols(keys + place), F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_off")).alias("o")
    within = Window.partitionBy(*_cols(keys + place)).orderBy(*_cols(order))
    ranked = rows.withColumn("_at", F.row_number().over(within) - 1).alias("r")
    same = reduce(lambda x, y: x & y, [F.col(f"r.`{c}`").eqNullSafe(F.col(f"o.`{c}`")) for c in keys + place])
    return ranked.join(offsets, same).select(
        *[F.col(f"r.`{c}`") for c in keys], (F.col("_off") + F.col("_at")).alias("position"),
        F.col(f"r.{ATTRIBUTE}").alias(ATTRIBUTE), F.col(f"r.{COLUMN}").alias(COLUMN))


def sort_catalogue(catalogue: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Output order by group key (O3) — use at the sink only; it is a range shuffle."""
    return catalogue.orderBy(*_cols([*levels, TABLE]))


def distinct_collapse(df: DataFrame, group: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """Distinct values per group; one value stays a scalar, several become a sorted JSON list (A3).

    Values are made distinct per (group, value) first (combined before the
    shuffle), so repeated values never reach the list.
    """
    pairs = df.select(*_cols([*group, value])).distinct()
    values = pairs.groupBy(*_cols(group)).agg(F.array_sort(F.collect_list(F.col(f"`{value}`"))).alias("_v"))
    return values.select(
        *_cols(group), F.when(F.size("_v") == 1, F.col("_v")[0]).otherwise(F.to_json("_v")).alias(alias or value))
