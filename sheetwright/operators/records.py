"""Record cleaning (R5) and flattening (R6) as schema walks over pure Spark expressions.

Python-truthiness rules of the original cleaner, per Spark type:

* text: null, '' and the text 'None' are empty
* numbers, decimals, intervals: zero is empty (``drop_zero``); NaN is kept
* booleans: always kept (False too); binary: empty bytes are empty
* array / map: cleaned element-wise, empty ones dropped; an empty container is empty
* struct (a nested record): cleaned field-wise; empty when every field is
* a top-level record that ends up empty is removed

Dictionaries whose keys differ from record to record (maps) are JSON text
unless their keys are given or discovered; then each key is a column.

A Spark row has a fixed schema, so a removed key becomes null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfmt import KEEP_NULLS, encodable, let

#: Keys of dictionary columns, by flattened name.
Keys = Mapping[str, Sequence]
#: Distinct dictionary keys that may become columns.
MAX_KEYS = 2000

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def clean_value(c: Column, dtype: T.DataType, drop_zero: bool = True) -> Column:
    """The cleaned value, or null when it is empty."""
    if isinstance(dtype, T.StringType):
        return F.when((c != "") & (c != "None"), c)
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, _NUMERIC):
        return F.when(c != 0, c) if drop_zero else c
    if isinstance(dtype, T.DayTimeIntervalType):
        return F.when(c != F.expr("INTERVAL '0' SECOND"), c) if drop_zero else c
    if isinstance(dtype, T.BinaryType):
        return F.when(F.length(c) > 0, c)
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(F.transform(c, lambda x: clean_value(x, dtype.elementType, drop_zero)),
                        lambda x: x.isNotNull())
        return let(kept, lambda k: F.when(F.size(k) > 0, k))
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(F.transform_values(c, lambda _k, v: clean_value(v, dtype.valueType, drop_zero)),
                            lambda _k, v: v.isNotNull())
        return let(kept, lambda k: F.when(F.size(k) > 0, k))
    if isinstance(dtype, T.StructType):
        if not dtype.fields:
            return F.lit(None).cast(dtype)
        # each cleaned child is bound once, so the expression grows with the schema, not with its depth
        kids = F.struct(*[clean_value(c[f.name], f.dataType, drop_zero).alias(f.name) for f in dtype.fields])
        return let(kids, lambda k: F.when(reduce(or_, [k[f.name].isNotNull() for f in dtype.fields]), k))
    return c  # timestamps, dates and other objects are truthy


def _column(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def clean_empties(df: DataFrame, drop_zero: bool = True) -> DataFrame:
    """Clean every column and drop records that end up empty."""
    cols = [clean_value(_column(f.name), f.dataType, drop_zero).alias(f.name) for f in df.schema.fields]
    out = df.select(*cols)
    if not out.columns:
        return out
    keep = F.coalesce(*[F.when(_column(n).isNotNull(), F.lit(1)) for n in out.columns]).isNotNull()
    return out.filter(keep)


def _flat(c: Column, dtype: T.DataType, name: str, keys: Keys) -> list[tuple[str, Column]]:
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            out.extend(_flat(c[f.name], f.dataType, f"{name}_{f.name}" if name else f.name, keys))
        return out
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.StringType):
            return [(name, F.when(F.size(c) > 0, F.array_join(c, ">")))]
        return [(name, F.when(F.size(c) > 0, F.to_json(encodable(c, dtype), KEEP_NULLS)))]
    if isinstance(dtype, T.MapType):
        if name in keys:
            out = []
            for key in keys[name]:
                out.extend(_flat(_value(c, dtype, key), dtype.valueType, f"{name}_{key}", keys))
            return out
        return [(name, F.when(F.size(c) > 0, F.to_json(encodable(c, dtype), KEEP_NULLS)))]  # the dict as JSON text
    return [(name, c)]


def _value(c: Column, dtype: T.MapType, key) -> Column:
    """The value of a dictionary under ``key``, null where it has none."""
    return F.element_at(c, F.lit(key).cast(dtype.keyType))


def _dictionaries(c: Column, dtype: T.DataType, name: str, keys: Keys) -> list[tuple[str, Column, T.MapType]]:
    """(flattened name, value, type) of the dictionaries that ``keys`` does not open; those inside lists stay closed."""
    if isinstance(dtype, T.StructType):
        return [d for f in dtype.fields for d in _dictionaries(c[f.name], f.dataType, f"{name}_{f.name}" if name else f.name, keys)]
    if isinstance(dtype, T.MapType):
        if name not in keys:
            return [(name, c, dtype)]
        return [d for key in keys[name] for d in _dictionaries(_value(c, dtype, key), dtype.valueType, f"{name}_{key}", keys)]
    return []


def _named_keys(c: Column, name: str) -> Column:
    """The keys of a dictionary as a list of (name, key)."""
    named = F.transform(F.map_keys(c), lambda k: F.struct(F.lit(name).alias("name"), k.cast("string").alias("key")))
    return F.coalesce(named, F.array().cast("array<struct<name:string,key:string>>"))


def discover_keys(df: DataFrame, clean: bool = True, drop_zero: bool = True, max_keys: int = MAX_KEYS) -> dict[str, list[str]]:
    """The keys of every dictionary column, by its flattened name, in ascending order.

    One aggregate for each level of nesting: distinct (dictionary, key) pairs,
    combined before the shuffle; only they reach the driver, and more than
    ``max_keys`` of them raise (they are to become columns).  With ``clean``
    a key counts only where its value is not empty.
    """
    keys: dict[str, list[str]] = {}
    left = max_keys
    while found := [d for f in df.schema.fields for d in _dictionaries(_column(f.name), f.dataType, f.name, keys)]:
        entries = []
        for name, value, dtype in found:
            kept = clean_value(value, dtype, drop_zero) if clean else value
            entries.append(_named_keys(kept, name))
        pairs = df.select(F.explode(F.concat(*entries)).alias("e")).select("e.*").distinct().limit(left + 1).collect()
        left -= len(pairs)
        if left < 0:
            raise ValueError(f"more than {max_keys} different keys in {[name for name, _, _ in found]}: they cannot all become columns")
        for name, _, _ in found:
            keys[name] = sorted(p["key"] for p in pairs if p["name"] == name)
    return keys


def flatten_columns(df: DataFrame, keys: Keys | None = None) -> DataFrame:
    """Nested records become ``parent_child`` columns; text lists are '>'-joined, other lists JSON text.

    A dictionary whose flattened name is in ``keys`` gives a column for each
    key listed there (null in records without it); others stay JSON text.
    """
    pairs = []
    for f in df.schema.fields:
        pairs.extend(_flat(_column(f.name), f.dataType, f.name, keys or {}))
    names = [n for n, _ in pairs]
    same = str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    folded = [same(n) for n in names]
    if len(set(folded)) != len(names):
        raise ValueError(f"flattened names collide: {sorted(n for n, f in zip(names, folded) if folded.count(f) > 1)}")
    return df.select(*[c.alias(n) for n, c in pairs])


def flatten_records(df: DataFrame, clean: bool = True, drop_zero: bool = True, keys: Keys | str | None = None) -> DataFrame:
    """Flatten (R6), then clean (R5); values inside joined or encoded lists are not cleaned.

    ``keys`` opens dictionaries with dynamic keys into columns: lists of keys
    by flattened name, or ``"discover"`` for all keys the data have.
    """
    if keys == "discover":
        keys = discover_keys(df, clean, drop_zero)
    flat = flatten_columns(df, keys)
    return clean_empties(flat, drop_zero) if clean else flat
