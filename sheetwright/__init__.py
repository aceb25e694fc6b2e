"""sheetwright — a Spark-native mapping catalogue: sheets of application-to-database mappings
turned into a queryable table, rollups, primary-key views and an ordered primary-key catalogue,
plus record utilities (cleaning, flattening, slugs, camel case, SHA-512 fingerprints, JSON export).

The most used entry points are re-exported here; see README.md for the full map.
"""

from .functions.hashing import hash_files, hash_record, hash_text
from .functions.jsonfmt import encode_list, join_list, python_json, record_json
from .functions.naming import camel_case, slugify, split_camel_case
from .operators.catalogue import distinct_collapse, object_rollup, pk_catalogue, pk_entries, pk_view, sort_catalogue
from .operators.flags import drop_incomplete, yes_no_flags
from .operators.nulls import drop_null_columns, fill_text
from .operators.paths import split_path
from .operators.records import clean_empties, discover_keys, flatten_records
from .operators.selection import run_sql, select_from
from .plans.mapping import (build_views, catalogue, clean_mapping, export_named, export_records, load_mapping,
                            load_mappings, store_mapping, write_catalogue)
from .sinks.files import dated_path, json_output_size, publish_many, read_many, write_json, write_many, write_snapshot
from .sinks.tables import save_sql_view, save_table, save_view
from .sources.json_records import read_json_document_lines, read_json_documents, read_json_records
from .sources.sheets import read_sheet, read_sheets, read_with_row_index

__version__ = "0.1.0"

__all__ = [
    "build_views", "camel_case", "catalogue", "clean_empties", "clean_mapping", "dated_path", "discover_keys", "distinct_collapse",
    "drop_incomplete", "drop_null_columns", "encode_list", "export_named", "export_records", "fill_text",
    "flatten_records", "hash_files", "hash_record", "hash_text", "join_list", "json_output_size", "load_mapping",
    "load_mappings", "object_rollup", "pk_catalogue", "pk_entries", "pk_view", "publish_many", "python_json", "read_many", "read_json_document_lines",
    "read_json_documents", "read_json_records", "read_sheet", "read_sheets", "read_with_row_index", "record_json", "run_sql",
    "save_sql_view", "save_table", "save_view", "select_from", "slugify", "sort_catalogue", "split_camel_case", "split_path", "store_mapping", "write_catalogue",
    "write_json", "write_many", "write_snapshot", "yes_no_flags",
]
