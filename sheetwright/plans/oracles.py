"""DuckDB SQL equivalents of the registered queries (run by the correctness check on the same tables).

Every statement reads the pre-registered views of the given tables and
recomputes the query's result independently of Spark.
"""

from __future__ import annotations

from ..sources.fixtures import HEADER_LINE, SHEET_HEADER, SHEET_PREAMBLE, SHEET_TITLE, VARIANT_COLUMNS

_CELLS = """
  concat_ws('.', concat('Top', CAST(l_suppkey % 5 AS VARCHAR)),
    CASE WHEN l_partkey % 5 >= 1 THEN concat('Mod', CAST(l_partkey % 7 AS VARCHAR)) END,
    CASE WHEN l_partkey % 5 >= 2 THEN concat('Svc', CAST(l_partkey % 3 AS VARCHAR)) END,
    CASE WHEN l_partkey % 5 >= 3 THEN concat('Vo', CAST(l_partkey % 11 AS VARCHAR)) END,
    CASE WHEN l_partkey % 5 >= 4 THEN 'Tail' END) AS viewObject,
  concat('Attr', CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR)) AS viewObjectAttribute,
  concat('TAB_', CAST(l_suppkey % 4 AS VARCHAR)) AS databaseTable,
  concat('COL_', CAST(l_linenumber AS VARCHAR)) AS databaseColumn,
  CASE WHEN l_partkey % 11 = 0 THEN 'No' WHEN l_returnflag = 'R' THEN 'Yes'
       WHEN l_quantity < 3 THEN 'yes' ELSE 'No' END AS primaryKeyColumn,
  CASE WHEN l_linestatus = 'O' THEN 'Yes' WHEN l_quantity > 48 THEN NULL ELSE 'No' END AS indexedColumn"""

_ATTRIBUTE = "concat('Attr', CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR)) AS viewObjectAttribute"
_CSV_ATTRIBUTE = "concat('Attr \"', l_orderkey, '\", line', chr(10), l_linenumber) AS viewObjectAttribute"

RAW = f"SELECT {_CELLS}, l_orderkey * 10 + l_linenumber AS rowIndex FROM lineitem"

_SHEET_ROWINDEX = (f"row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                   f"l_returnflag, l_linestatus, l_quantity) + {HEADER_LINE - 1}")
SHEET_RAW = f"SELECT {_CELLS}, {_SHEET_ROWINDEX} AS rowIndex FROM lineitem"

_SHEETS_ROWINDEX = (f"row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY l_orderkey, l_linenumber, l_partkey, "
                    f"l_suppkey, l_returnflag, l_linestatus, l_quantity) + {HEADER_LINE - 1}")
SHEETS_RAW = f"SELECT {_CELLS}, {_SHEETS_ROWINDEX} AS rowIndex FROM lineitem"
_SHEETS = "(SELECT DISTINCT concat('TAB_', CAST(l_suppkey % 4 AS VARCHAR)) AS sheet FROM lineitem)"

_FLAGGED = """SELECT viewObject, viewObjectAttribute, databaseTable, databaseColumn,
  CASE primaryKeyColumn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS primaryKeyColumn,
  CASE indexedColumn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS indexedColumn, rowIndex FROM raw"""

_LEVELS = """SELECT * EXCLUDE (p),
  coalesce(p[1], p[-1]) AS viewObjectModelTop,
  coalesce(p[2], p[-1]) AS viewObjectModel,
  CASE WHEN len(p) = 3 THEN '' ELSE coalesce(p[3], p[-1]) END AS viewObjectModelService,
  coalesce(p[4], p[-1]) AS viewObjectName
FROM (SELECT *, string_split(viewObject, '.') AS p FROM kept)"""

L = "viewObjectModelTop, viewObjectModel, viewObjectModelService, viewObjectName"


def _with_mappings(raw_sql: str = RAW) -> str:
    return (f"WITH raw AS ({raw_sql}),\n flagged AS ({_FLAGGED}),\n"
            f" kept AS (SELECT * FROM flagged WHERE primaryKeyColumn IS NOT NULL AND indexedColumn IS NOT NULL),\n"
            f" mappings AS ({_LEVELS})\n")


ROLLUP = f"SELECT {L}, COUNT(*) AS colCnt, CAST(SUM(primaryKeyColumn) AS BIGINT) AS colCntPK FROM mappings GROUP BY {L}"

PK_VIEW = (f"SELECT t.*, v.viewObjectAttribute, v.databaseTable, v.databaseColumn, v.rowIndex FROM ({ROLLUP}) t "
           f"LEFT JOIN (SELECT * FROM mappings WHERE primaryKeyColumn = 1) v USING ({L})")

CATALOGUE = f"""SELECT {L},
  CASE WHEN r.colCntPK <> 0 THEN l.databaseTable END AS databaseTable, r.colCnt, r.colCntPK,
  CASE WHEN r.colCntPK <> 0 THEN l.cols END AS cols,
  CASE WHEN r.colCntPK <> 0 THEN l.colsDB END AS colsDB
FROM ({ROLLUP}) r LEFT JOIN (
  SELECT {L}, databaseTable,
    list(viewObjectAttribute ORDER BY rowIndex, viewObjectAttribute, databaseColumn) AS cols,
    list(databaseColumn ORDER BY rowIndex, viewObjectAttribute, databaseColumn) AS colsDB
  FROM mappings WHERE primaryKeyColumn = 1 GROUP BY {L}, databaseTable) l USING ({L})"""


def _q(s: str) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _sheet_top_rows() -> str:
    """Lines 1..header of the fixture export, named like the data (line 0 is consumed)."""
    rows = [[p] + [None] * 5 for p in SHEET_PREAMBLE] + [[None] * 6] + [list(SHEET_HEADER)]
    names = ["viewObject", "viewObjectAttribute", "databaseTable", "databaseColumn", "primaryKeyColumn",
             "indexedColumn"]
    out = []
    for i, r in enumerate(rows):
        cells = ", ".join(f"CAST({_q(v)} AS VARCHAR) AS {n}" for v, n in zip(r, names))
        out.append(f"SELECT {cells}, CAST({i} AS BIGINT) AS rowIndex")
    return " UNION ALL ".join(out)


_ = SHEET_TITLE  # line 0 is consumed by the reader and never appears in results

def _camel(text_sql: str) -> str:
    """camelCase in DuckDB SQL; exact where no letter follows a digit inside a word."""
    words = (f"list_filter(string_split(regexp_replace({text_sql}, '[^0-9a-zA-Z\\s]+', ' ', 'g'), ' '), "
             f"lambda x: x <> '')")
    return (f"CASE WHEN len({words}) > 0 THEN lower({words}[1]) || array_to_string(list_transform({words}[2:], "
            f"lambda x: upper(x[1]) || lower(x[2:])), '') END")


_ISO = ("CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00') "
        "ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END")
ORDERS_JSON = ("json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey, 'o_orderstatus', o_orderstatus, "
               "'o_totalprice', o_totalprice, 'o_orderdate', " + _ISO.format(c="o_orderdate") +
               ", 'o_orderpriority', o_orderpriority)::VARCHAR")
_ORDERS_WITH_NULLS = "(SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders)"
# the default layout of Python's json module; these texts are printable ASCII without quotes or backslashes
ORDERS_PYTHON_JSON = ("concat('{\"o_orderkey\": ', o_orderkey, ', \"o_custkey\": ', o_custkey, ', \"o_orderstatus\": ', "
                      "coalesce('\"' || o_orderstatus || '\"', 'null'), ', \"o_totalprice\": ', o_totalprice, "
                      "', \"o_orderdate\": \"', " + _ISO.format(c="o_orderdate") + ", '\", \"o_orderpriority\": \"', "
                      "o_orderpriority, '\"}')")
_PY_SPACE = "\\t\\n\\x0b\\f\\r\\x1c-\\x1f "
SLUG = ("array_to_string(list_transform(string_split(f, '.'), lambda p: regexp_replace(regexp_replace("
        "regexp_replace(p, '[^0-9A-Za-z_" + _PY_SPACE + "-]', '', 'g'), '[" + _PY_SPACE + "-]+', '-', 'g'), "
        "'^[-_]+|[-_]+$', '', 'g')), '.')")
EVENTS_FLAT = """SELECT nullif(event_id, 0) AS event_id,
  CASE WHEN event_type <> '' AND event_type <> 'None' THEN event_type END AS detail_type,
  nullif(value, 0) AS detail_value, nullif(user_id, 0) AS detail_user_id,
  nullif(json_extract(props, '$.k')::BIGINT, 0) AS props_k,
  CASE WHEN event_type = 'view' THEN NULL ELSE '>' || event_type END AS tags,
  to_json([user_id, event_id])::VARCHAR AS ids,
  to_json([{'id': event_id, 'odd': nullif(user_id % 2, 0)}])::VARCHAR AS parts
FROM events"""

_KINDS = ("click", "error", "purchase", "signup", "view")
EVENTS_KEYS = ("SELECT nullif(event_id, 0) AS event_id, "
               + ", ".join(f"CASE WHEN event_type = '{k}' THEN nullif(value, 0) END AS metrics_{k}" for k in _KINDS) + ", "
               + ", ".join(f"CASE WHEN user_id % 3 = {i} THEN nullif(CAST(user_id % 7 AS DOUBLE), 0) END AS metrics_user{i}" for i in range(3)) + ", "
               + ", ".join(f"CASE WHEN event_type = '{k}' THEN nullif(json_extract(props, '$.k')::BIGINT, 0) END AS \"detail_byType_{k}_k\", "
                           f"CAST(NULL AS VARCHAR) AS \"detail_byType_{k}_empty\"" for k in _KINDS) + ", "
               + ", ".join(f"CASE WHEN user_id % 2 = {i} THEN event_type END AS nested_deep_{i}" for i in range(2)) + " FROM events")

# a title line and a line for each status stand before the header
_HEADER_LINES = "(SELECT l_suppkey % 4 AS k, count(DISTINCT concat(l_returnflag, l_linestatus)) + 1 AS headerLine FROM lineitem GROUP BY 1)"
_VARIANT_NAMES = {"View Object": "viewObject", "View Object Attribute": "viewObjectAttribute", "Database Table": "databaseTable",
                  "Database Column": "databaseColumn", "Primary Key Column": "primaryKeyColumn", "Indexed Column": "indexedColumn",
                  "Unique Column": "uniqueColumn"}
HEADER_VARIANTS = " UNION ALL ".join(
    f"SELECT concat('TAB_', k) AS sheet, {i} AS position, {_q(t)} AS headerText, {_q(_VARIANT_NAMES[t])} AS columnName, "
    f"CAST(headerLine AS INTEGER) AS headerLine FROM {_HEADER_LINES} WHERE k = {k}"
    for k, header in enumerate(VARIANT_COLUMNS) for i, t in enumerate(header))
MAPPING_VARIANTS = f"""WITH raw AS (SELECT {_CELLS}, l_suppkey % 4 AS k,
  CASE WHEN l_linenumber % 3 = 0 THEN 1 WHEN l_linenumber % 7 <> 1 THEN 0 END AS uniqueColumn,
  headerLine + row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_returnflag, l_linestatus, l_quantity) - 1 AS rowIndex FROM lineitem JOIN {_HEADER_LINES} h ON l_suppkey % 4 = h.k),
 kept AS (SELECT * EXCLUDE (primaryKeyColumn, indexedColumn, uniqueColumn),
    CASE primaryKeyColumn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS primaryKeyColumn,
    CASE WHEN k <> 3 THEN CASE indexedColumn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END END AS indexedColumn,
    CASE WHEN k = 2 THEN uniqueColumn END AS uniqueColumn FROM raw),
 mappings AS ({_LEVELS})
SELECT * EXCLUDE (k), databaseTable AS sheet FROM mappings WHERE primaryKeyColumn IS NOT NULL
  AND (k = 3 OR indexedColumn IS NOT NULL) AND (k <> 2 OR uniqueColumn IS NOT NULL)"""

ORACLES: dict[str, str] = {
    "yes_no_flags": f"WITH raw AS ({RAW}) {_FLAGGED}",
    "drop_incomplete": (f"WITH raw AS ({RAW}), flagged AS ({_FLAGGED}) SELECT * FROM flagged "
                        f"WHERE primaryKeyColumn IS NOT NULL AND indexedColumn IS NOT NULL"),
    "split_path": _with_mappings() + "SELECT * FROM mappings",
    "mapping_load": _with_mappings(SHEET_RAW) + "SELECT * FROM mappings",
    "read_sheet": f"{_sheet_top_rows()} UNION ALL {SHEET_RAW}",
    "object_rollup": _with_mappings() + ROLLUP,
    "pk_filter": _with_mappings() + "SELECT * FROM mappings WHERE primaryKeyColumn = 1",
    "select_columns": _with_mappings() + (f"SELECT viewObject, viewObjectAttribute, databaseTable, databaseColumn, "
                                          f"rowIndex, {L} FROM mappings"),
    "pk_view": _with_mappings() + PK_VIEW,
    "pk_catalogue": _with_mappings() + CATALOGUE,
    "pk_entries": _with_mappings() + f"""SELECT {L}, databaseTable,
  row_number() OVER (PARTITION BY {L}, databaseTable ORDER BY rowIndex, viewObjectAttribute, databaseColumn) - 1 AS position,
  viewObjectAttribute, databaseColumn FROM mappings WHERE primaryKeyColumn = 1""",
    "sorted_catalogue": _with_mappings() + (
        f"SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in [*L.split(', '), 'databaseTable'])}) - 1 "
        f"AS position FROM ({CATALOGUE})"),
    "mapping_load_csv": _with_mappings(SHEET_RAW.replace(_ATTRIBUTE, _CSV_ATTRIBUTE)) + "SELECT * FROM mappings",
    "fill_text": (f"WITH raw AS ({RAW}) SELECT viewObject, viewObjectAttribute, databaseTable, databaseColumn, "
                  f"coalesce(primaryKeyColumn, '') AS primaryKeyColumn, coalesce(indexedColumn, '') AS indexedColumn, "
                  f"rowIndex FROM raw"),
    "distinct_collapse": _with_mappings() + f"""SELECT {L},
  CASE WHEN len(t) = 1 THEN t[1] ELSE to_json(t)::VARCHAR END AS databaseTable
FROM (SELECT {L}, list_sort(list(DISTINCT databaseTable)) AS t FROM mappings GROUP BY {L})""",
    "discover_header": " UNION ALL ".join(
        f"SELECT {i} AS position, {_q(t)} AS headerText, {_q(n)} AS columnName, {HEADER_LINE} AS headerLine"
        for i, (t, n) in enumerate(zip(SHEET_HEADER, ["viewObject", "viewObjectAttribute", "databaseTable",
                                                      "databaseColumn", "primaryKeyColumn", "indexedColumn"]))),
    "camel_case": f"SELECT o_orderkey, {_camel('o_orderpriority')} AS priorityName FROM orders",
    "split_camel_case": (f"SELECT p_partkey, camel, string_split(regexp_replace(camel, '([a-z])([A-Z])', "
                         f"'\\1~\\2', 'g'), '~') AS words FROM (SELECT p_partkey, "
                         f"{_camel("concat_ws(' ', p_type, p_name, p_brand)")} AS camel FROM part)"),
    "slugify": (f"SELECT doc_id, {SLUG} AS slug FROM (SELECT doc_id, "
                f"regexp_replace(strip_accents(coalesce(text, 'None')), '[^\\x00-\\x7F]', '', 'g') AS f "
                f"FROM documents)"),
    "record_to_json": f"SELECT o_orderkey, {ORDERS_JSON} AS json FROM {_ORDERS_WITH_NULLS}",
    "python_json": f"SELECT o_orderkey, {ORDERS_PYTHON_JSON} AS json FROM {_ORDERS_WITH_NULLS}",
    "hash_files": ("SELECT concat('lang=', lang, '/part=', doc_id // 1000) AS name, "
                   "sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY lang, doc_id // 1000 "
                   "UNION ALL SELECT DISTINCT concat('lang=', lang), sha256('False') FROM documents"),
    "hash_text_256": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "hash_record_256": f"SELECT o_orderkey, sha256({ORDERS_PYTHON_JSON}) AS sha256 FROM {_ORDERS_WITH_NULLS}",
    "join_list": ("SELECT p_partkey, CASE WHEN len(l) > 0 THEN array_to_string(l, '>') END AS joined, "
                  "CASE WHEN len(a) > 0 THEN array_to_string(a, ', ') END AS commaText FROM ("
                  "SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda w: length(w) > 4) AS l, "
                  "string_split(p_name, ' ') AS a FROM part)"),
    "encode_list": ("SELECT o_orderkey, CASE WHEN len(k) > 0 THEN to_json(list_transform(k, "
                    "lambda x: {'key': x, 'rest': nullif(x % 3, 0)}))::VARCHAR END AS encoded FROM ("
                    "SELECT o_orderkey, list_filter([o_orderkey, o_custkey], lambda x: x > 1000) AS k FROM orders)"),
    "clean_empties": """SELECT nullif(event_id, 0) AS event_id, ts,
  CASE WHEN event_type <> '' AND event_type <> 'None' THEN event_type END AS event_type,
  nullif(value, 0) AS value, nullif(user_id % 3, 0) AS bucket,
  CASE WHEN nullif(value, 0) IS NULL AND nullif(k, 0) IS NULL THEN NULL
       ELSE to_json({'value': nullif(value, 0), 'k': nullif(k, 0)})::VARCHAR END AS detail
FROM (SELECT *, json_extract(props, '$.k')::BIGINT AS k FROM events)""",
    "clean_nested": """SELECT event_id, CASE WHEN kind IS NOT NULL OR inner_ IS NOT NULL
  THEN to_json({'kind': kind, 'inner': inner_})::VARCHAR END AS record
FROM (SELECT *, CASE WHEN v IS NOT NULL OR items IS NOT NULL THEN {'value': v, 'items': items} END AS inner_
  FROM (SELECT *, CASE WHEN odd IS NOT NULL OR kind IS NOT NULL THEN [{'odd': odd, 'kind': kind}] END AS items
    FROM (SELECT nullif(event_id, 0) AS event_id, nullif(value, 0) AS v, nullif(user_id % 2, 0) AS odd,
      nullif(nullif(nullif(event_type, 'view'), ''), 'None') AS kind FROM events)))
WHERE event_id IS NOT NULL OR kind IS NOT NULL OR inner_ IS NOT NULL""",
    "flatten_records": EVENTS_FLAT,
    "flatten_dynamic_keys": EVENTS_KEYS,
    "write_json": EVENTS_FLAT,
    "stream_record_export": EVENTS_FLAT,
    "drop_null_columns": f"SELECT * EXCLUDE (indexedColumn) FROM ({RAW})",
    "read_json_records": ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                          + _ISO.format(c="o_orderdate") + " AS o_orderdate, o_orderpriority FROM orders"),
    "read_json_documents": ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                            + _ISO.format(c="o_orderdate") + " AS o_orderdate, o_orderpriority FROM orders"),
    "json_output_size": (f"SELECT count(*) AS records, CAST(sum(length(j)) AS BIGINT) AS chars, "
                         f"CAST(sum(length(j)) AS DOUBLE) / 1000000.0 AS size_mb, "
                         f"CAST(greatest(1, ceil(CAST(sum(length(j)) AS DOUBLE) / 100000000.0)) AS BIGINT) AS files "
                         f"FROM (SELECT {ORDERS_JSON} AS j FROM orders)"),
    "write_many": " UNION ALL ".join(
        f"SELECT 'Sheet {i} of 4' AS dataset, count(*) AS rows, CAST(sum({key}) AS BIGINT) AS keySum, "
        f"count(DISTINCT {key}) AS keys FROM {name}"
        for i, (name, key) in enumerate((("orders", "o_orderkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey")), 1)),
    "publish_many": " UNION ALL ".join(
        f"SELECT '{label}' AS dataset, count(*) AS rows, CAST(sum({key}) AS BIGINT) AS keySum, count(DISTINCT {key}) AS keys FROM {name}"
        for label, name, key in (("orders", "orders", "o_orderkey"), ("customers", "customer", "c_custkey"), ("suppliers", "supplier", "s_suppkey"))),
    "catalogue_documents": _with_mappings() + (
        f"SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in [*L.split(', '), 'databaseTable'])}) - 1 "
        f"AS position, true AS withinLimit FROM ({CATALOGUE})"),
    "dated_snapshot": "SELECT *, 'V2026.01.05__orders' AS snapshot FROM orders",
    "save_table": _with_mappings() + "SELECT * FROM mappings",
    "object_view": _with_mappings() + ROLLUP,
    "select_from": _with_mappings() + (
        f"SELECT {L}, coalesce(databaseTable, '') AS databaseTable, rowIndex FROM ({PK_VIEW})"),
    "sql_passthrough": _with_mappings() + (
        f"SELECT {L}, colCnt, colCntPK, coalesce(viewObjectAttribute, '') AS viewObjectAttribute, "
        f"coalesce(databaseTable, '') AS databaseTable, coalesce(databaseColumn, '') AS databaseColumn, rowIndex "
        f"FROM ({PK_VIEW})"),
    "discover_sheet_headers": " UNION ALL ".join(
        f"SELECT sheet, {i} AS position, {_q(t)} AS headerText, {_q(n)} AS columnName, {HEADER_LINE} AS headerLine "
        f"FROM {_SHEETS}"
        for i, (t, n) in enumerate(zip(SHEET_HEADER, ["viewObject", "viewObjectAttribute", "databaseTable",
                                                      "databaseColumn", "primaryKeyColumn", "indexedColumn"]))),
    "discover_header_variants": HEADER_VARIANTS,
    "mapping_load_variants": MAPPING_VARIANTS,
    "mapping_load_sheets": _with_mappings(SHEETS_RAW) + "SELECT *, databaseTable AS sheet FROM mappings",
    "row_index": ("SELECT l_orderkey, l_partkey, l_linenumber, CAST(row_number() OVER () - 1 AS BIGINT) AS rowIndex "
                  "FROM lineitem"),
}
