"""SHA-512 fingerprints of text (F4), records (F5) and files (F6), hex encoded; ``bits`` chooses a shorter SHA-2."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .jsonfmt import python_json

# SHA-512 of the text "False": the fingerprint of a path that is not a file.
_NOT_A_FILE_TEXT = "False"
#: Files up to this size are one value for Spark, whose limit is 2 GB; larger ones are read in chunks.
WHOLE_BYTES = 256 << 20
CHUNK_BYTES = 8 << 20


def hash_text(c: Column | str, bits: int = 512) -> Column:
    """SHA-2 hex of text (UTF-8) or bytes."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sha2(c, bits)


def hash_record(df: DataFrame, cols: Sequence[str] | None = None, bits: int = 512) -> Column:
    """SHA-2 hex of the row's JSON text in Python's ``json.dumps`` layout (field order kept)."""
    names = list(cols or df.columns)
    fields = {f.name: f for f in df.schema.fields}
    schema = T.StructType([fields[n] for n in names])
    rec = F.struct(*[F.col(f"`{n}`") for n in names])
    return F.sha2(python_json(rec, schema), bits)


def hash_list(c: Column | str, dtype: T.DataType) -> Column:
    """SHA-512 hex of a list value's Python JSON text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sha2(python_json(c, dtype), 512)


def _file_uri(c: Column) -> Column:
    """Plain absolute paths become ``file:`` URIs, as the binary-file source reports them."""
    return F.when(c.startswith("/"), F.concat(F.lit("file:"), c)).otherwise(c)


def _store(uri: str):
    """(file system, path) of a URI in a store that Arrow reads (local, HDFS, S3, GCS)."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(quote(uri, safe=":/@"))


def open_file(uri: str):
    """A file as a stream of bytes."""
    store, path = _store(uri)
    return store.open_input_stream(path)


def _is_empty_file(uri: str) -> bool:
    """Whether a path that Spark does not list is an empty file; in a store that Arrow does not know, no."""
    try:
        store, path = _store(uri)
    except pa.ArrowInvalid:
        return False
    info = store.get_file_info(path)
    return info.type == pafs.FileType.File and info.size == 0


def _empty_files(uris: DataFrame, bits: int) -> DataFrame:
    """Rows (_uri, _h) of the empty files among ``uris`` (Spark's listings leave them out)."""

    def run(batches):
        for batch in batches:
            found = [u for u in batch.column("_uri").to_pylist() if _is_empty_file(u)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([hashlib.new(f"sha{bits}").hexdigest()] * len(found), pa.string())], names=["_uri", "_h"])

    return uris.mapInArrow(run, "_uri string, _h string")


def _hashed_in_chunks(files: DataFrame, bits: int, open_stream: Callable) -> DataFrame:
    """Rows (_uri, _h): each file read by one task, a chunk at a time."""

    def run(batches):
        for batch in batches:
            for uri in batch.column("_uri").to_pylist():
                found = hashlib.new(f"sha{bits}")
                with open_stream(uri) as stream:
                    while chunk := stream.read(CHUNK_BYTES):
                        found.update(chunk)
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([found.hexdigest()])], names=["_uri", "_h"])

    return files.mapInArrow(run, "_uri string, _h string")


def hash_files(spark: SparkSession, manifest: DataFrame, path_col: str, roots: Sequence[str], bits: int = 512,
               whole_bytes: int = WHOLE_BYTES, open_stream: Callable = open_file) -> DataFrame:
    """Fingerprint every manifest path: SHA-2 of the file bytes, or of the text 'False' (F6), in column ``sha<bits>``.

    ``roots`` are the folders (or globs) the manifest points into; they are
    listed by the binary-file source, and the manifest joins to the listing.
    Each file is read by one task (SHA-2 has no parallel form): up to
    ``whole_bytes`` as one value by Spark, beyond as a stream of chunks of
    ``CHUNK_BYTES`` into an incremental hash, so memory does not grow with the
    file.  The stream is opened by ``open_stream`` (URI to a readable object)
    in the task.  Manifest paths must be absolute paths or URIs (a working
    directory means nothing on a cluster).
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(roots))
    uri = F.col("path").alias("_uri")
    whole = listed.where(F.col("length") <= whole_bytes).select(uri, F.sha2(F.col("content"), bits).alias("_h"))
    large = listed.where(F.col("length") > whole_bytes).select(uri).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_uri")
    keyed = manifest.withColumn("_uri", _file_uri(F.col(f"`{path_col}`")))
    unlisted = keyed.select("_uri").where("_uri IS NOT NULL").distinct().join(listed.select(uri), on="_uri", how="left_anti")
    files = whole.unionByName(_hashed_in_chunks(large, bits, open_stream)).unionByName(_empty_files(unlisted, bits))
    joined = keyed.join(files, on="_uri", how="left")
    return joined.select(*[F.col(f"`{c}`") for c in manifest.columns],
                         F.coalesce(F.col("_h"), F.sha2(F.lit(_NOT_A_FILE_TEXT), bits)).alias(f"sha{bits}"))
