"""JSON text of records and lists as Spark expressions (F5 layout, F7, F8, F9, F11).

Two layouts:

* ``record_json`` — Spark's compact JSON (``to_json``), with the original
  tool's value rules applied first: timestamps as ISO-8601 with offset
  (micro-seconds only when non-zero), dates as ISO dates, day-time intervals
  as seconds.
* ``python_json`` — byte-exact text of Python's ``json.dumps`` default
  layout (", " and ": " separators, non-ASCII escaped as ``\\uXXXX``,
  ``NaN``/``Infinity``, shortest float repr with Python's exponent rule).
  Used to hash records exactly like the original tool.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ``to_json`` option: a key whose value is null stays, as ``null``.
KEEP_NULLS = {"ignoreNullFields": "false"}

_PRINTABLE = r"\x{20}-\x{7e}"


def walk(c: Column, dtype: T.DataType, leaf) -> Column:
    """Rebuild a (nested) value, applying ``leaf(col, type)`` to every non-container value."""
    if isinstance(dtype, T.StructType):
        if not dtype.fields:
            return c
        rebuilt = F.struct(*[walk(c[f.name], f.dataType, leaf).alias(f.name) for f in dtype.fields])
        return F.when(c.isNotNull(), rebuilt)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: walk(x, dtype.elementType, leaf))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _k, v: walk(v, dtype.valueType, leaf))
    return leaf(c, dtype)


def iso_timestamp(c: Column, naive: bool = False) -> Column:
    """ISO-8601 with offset; fraction printed only when micro-seconds are non-zero.

    An instant (TIMESTAMP) shows the session time zone's offset; a naive
    value (TIMESTAMP_NTZ) is taken as UTC and always ends in ``+00:00``.
    """
    if naive:
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
        return F.replace(text, F.lit(".000000+"), F.lit("+"))  # one format call, then drop a zero fraction
    text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.regexp_replace(text, r"\.000000(?=[+-])", "")


def _encodable(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(c, naive=isinstance(dtype, T.TimestampNTZType))
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.DayTimeIntervalType):
        return c.cast("decimal(18,6)").cast("double")
    return c


def encodable(c: Column, dtype: T.DataType) -> Column:
    """Value with datetimes/intervals turned into their JSON form (ComplexEncoder rules)."""
    return walk(c, dtype, _encodable)


def record_json(df_cols: list[str], schema: T.StructType, pretty: bool = False, drop_nulls: bool = False) -> Column:
    """JSON text of the row made of ``df_cols`` (F7); null fields are kept unless ``drop_nulls``."""
    fields = {f.name: f.dataType for f in schema.fields}
    struct = F.struct(*[encodable(F.col(f"`{n}`"), fields[n]).alias(n) for n in df_cols])
    return F.to_json(struct, ({} if drop_nulls else KEEP_NULLS) | ({"pretty": "true"} if pretty else {}))


def join_list(c: Column | str, sep: str = ">") -> Column:
    """Text list joined with ``sep``; an empty (or null) list gives null (F8, F11 with ', ')."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.size(c) > 0, F.array_join(c, sep))


def encode_list(c: Column | str) -> Column:
    """Non-text list as JSON text (F9); an empty list gives null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.size(c) > 0, F.to_json(c, KEEP_NULLS))


# --- Python json.dumps layout ---------------------------------------------------

def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (keeps generated code small)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def py_string(c: Column) -> Column:
    """JSON string literal as Python writes it with ensure_ascii=True.

    Short escapes first; any character outside printable ASCII then becomes
    ``\\uXXXX`` (UTF-16 code units, so astral characters give surrogate
    pairs).  Text that is printable ASCII after the short escapes takes the
    cheap branch; whole-stage codegen evaluates the shared subexpression once.
    """
    s = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    s = F.replace(s, F.lit('"'), F.lit('\\"'))
    for raw, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        s = F.replace(s, F.lit(raw), F.lit(esc))
    tokens = F.regexp_extract_all(s, F.lit(rf"([{_PRINTABLE}]+|[^{_PRINTABLE}])"), 1)
    escaped = F.array_join(
        F.transform(
            tokens,
            lambda t: F.when(t.rlike(rf"^[{_PRINTABLE}]"), t).otherwise(
                F.regexp_replace(F.lower(F.hex(F.encode(t, "UTF-16BE"))), "(.{4})", r"\\u$1")
            ),
        ),
        "",
    )
    return F.concat(F.lit('"'), F.when(s.rlike(rf"[^{_PRINTABLE}]"), escaped).otherwise(s), F.lit('"'))


def _py_float_layout(d: Column) -> Column:
    """``d`` = struct(neg, digits, point): value = 0.<digits> x 10^point, digits without outer zeros."""
    digits, point = d["digits"], d["point"]
    n = F.length(digits)
    sci_e = point - 1
    positional = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0")))
        .otherwise(F.concat(digits.substr(F.lit(1), point), F.lit("."), digits.substr(point + 1, n)))
    )
    sci = F.concat(
        F.substring(digits, 1, 1),
        F.when(n > 1, F.concat(F.lit("."), F.substring(digits, 2, 1 << 30))).otherwise(F.lit("")),
        F.lit("e"),
        F.when(sci_e < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(sci_e) >= 10, F.abs(sci_e).cast("string")).otherwise(F.concat(F.lit("0"), F.abs(sci_e).cast("string"))),
    )
    body = F.when(n == 0, F.lit("0.0")).when((sci_e >= -4) & (sci_e < 16), positional).otherwise(sci)
    return F.concat(F.when(d["neg"], F.lit("-")).otherwise(F.lit("")), body)


def _py_float_parts(s: Column) -> Column:
    """Split ``Double.toString`` or ``%e`` text into sign, significant digits and decimal point position."""
    a = F.regexp_replace(s, "^-", "")
    mant = F.regexp_extract(a, r"^([0-9.]+)", 1)
    exp = F.coalesce(F.nullif(F.regexp_extract(a, r"[eE]([-+]?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    ipart = F.substring_index(mant, ".", 1)
    allds = F.regexp_replace(mant, r"\.", "")
    stripped = F.regexp_replace(allds, "^0+", "")
    lead = F.length(allds) - F.length(stripped)
    parts = F.struct(
        s.startswith("-").alias("neg"),
        F.regexp_replace(stripped, "0+$", "").alias("digits"),
        (F.length(ipart) + exp - lead).alias("point"),
    )
    return let(parts, _py_float_layout)


def _significant(s: Column) -> Column:
    mant = F.regexp_extract(s, r"^-?([0-9.]+)", 1)
    return F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(mant, r"\.", ""), "^0+", ""), "0+$", ""))


def py_float(c: Column) -> Column:
    """Python ``repr`` of a double: the shortest digits that read back as the same double.

    Java's ``Double.toString`` is shortest for nearly all values; when it
    prints 16 or more significant digits, the shortest round-tripping
    ``%.Ne`` form is searched instead.  Positional when -4 <= exponent < 16,
    else ``d.ddde+XX``; NaN/Infinity as Python's json writes them.
    """
    def layout(p: Column) -> Column:
        x, s = p["x"], p["s"]
        candidates = [
            let(F.format_string(f"%.{k - 1}e", x), lambda t: F.when(t.cast("double") == x, t)) for k in range(1, 18)
        ]
        search = (_significant(s) >= 16) | ((F.abs(x) < 2.3e-308) & (x != 0))  # long output or subnormal
        chosen = F.when(search, F.coalesce(*candidates, s)).otherwise(s)
        return (
            F.when(s == "NaN", F.lit("NaN"))
            .when(s == "Infinity", F.lit("Infinity"))
            .when(s == "-Infinity", F.lit("-Infinity"))
            .otherwise(_py_float_parts(chosen))
        )
    x = c.cast("double")
    s = x.cast("string")
    # Java and Python print the same text for plain positional numbers with
    # at most 15 digits (|x| in [1e-3, 1e7) or zero): no parsing needed.
    plain = (~s.contains("E")) & (F.length(s) <= 16) & (s != "NaN") & (~s.contains("Infinity"))
    return F.when(x.isNull(), F.lit(None)).when(plain, s).otherwise(
        let(F.struct(x.alias("x"), s.alias("s")), layout))


def python_json(c: Column, dtype: T.DataType) -> Column:
    """Text of Python's ``json.dumps(value)`` for a Spark value of type ``dtype``."""
    if isinstance(dtype, T.StructType):
        items = [F.concat(F.lit(_py_key(f.name) + ": "), python_json(c[f.name], f.dataType)) for f in dtype.fields]
        body = F.concat_ws(", ", *items) if items else F.lit("")
        out = F.concat(F.lit("{"), body, F.lit("}"))
    elif isinstance(dtype, T.ArrayType):
        out = F.concat(
            F.lit("["), F.array_join(F.transform(c, lambda x: python_json(x, dtype.elementType)), ", "), F.lit("]")
        )
    elif isinstance(dtype, T.MapType):
        key = (lambda k: py_string(k)) if isinstance(dtype.keyType, T.StringType) else (
            lambda k: F.concat(F.lit('"'), python_json(k, dtype.keyType), F.lit('"')))
        out = F.concat(
            F.lit("{"),
            F.array_join(
                F.transform(F.map_entries(c), lambda e: F.concat(key(e["key"]), F.lit(": "),
                                                                  python_json(e["value"], dtype.valueType))),
                ", ",
            ),
            F.lit("}"),
        )
    elif isinstance(dtype, T.StringType):
        out = py_string(c)
    elif isinstance(dtype, T.BooleanType):
        out = F.when(c, F.lit("true")).otherwise(F.lit("false"))
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        out = c.cast("string")
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        out = py_float(c)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DayTimeIntervalType)):
        enc = _encodable(c, dtype)
        # ISO date/time text is printable ASCII: it needs quotes but no escaping
        out = py_float(enc) if isinstance(dtype, T.DayTimeIntervalType) else F.concat(F.lit('"'), enc, F.lit('"'))
    else:
        raise TypeError(f"no JSON form for {dtype.simpleString()}")
    return F.when(c.isNull(), F.lit("null")).otherwise(out)


def _py_key(name: str) -> str:
    import json

    return json.dumps(name)
