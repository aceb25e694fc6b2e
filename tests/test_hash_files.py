"""File hashes of any size."""

import hashlib
import os

import pytest

from sheetwright.functions import hashing
from sheetwright.functions.hashing import hash_files


def _hash(path, bits=512):
    with open(path, "rb") as f:
        return hashlib.file_digest(f, f"sha{bits}").hexdigest()


def _files(folder):
    os.makedirs(f"{folder}/sub dir", exist_ok=True)
    paths = {}
    for name, content in {"empty.bin": b"", "a.txt": b"text\n", "sub dir/100% odd é.bin": bytes(range(256)) * 5000, "border.bin": b"x" * 1000, "over.bin": b"x" * 1001}.items():
        paths[name] = f"{folder}/{name}"
        with open(paths[name], "wb") as f:
            f.write(content)
    return paths


@pytest.mark.parametrize("whole_bytes", [-1, 1000, 1 << 40])
@pytest.mark.parametrize("bits", [256, 512])
def test_whole_and_chunked_files_hash_alike(spark, tmp_dir, whole_bytes, bits, monkeypatch):
    paths = _files(tmp_dir)
    rows = [(p,) for p in paths.values()] + [(f"file:{paths['a.txt']}",), (tmp_dir,), (f"{tmp_dir}/missing",), (None,)]
    manifest = spark.createDataFrame(rows, "path string")
    got = {r["path"]: r[f"sha{bits}"] for r in hash_files(spark, manifest, "path", [tmp_dir], bits, whole_bytes).collect()}
    no_file = hashlib.new(f"sha{bits}", b"False").hexdigest()
    want = {p: _hash(p, bits) for p in paths.values()} | {f"file:{paths['a.txt']}": _hash(paths["a.txt"], bits)}
    assert got == want | {tmp_dir: no_file, f"{tmp_dir}/missing": no_file, None: no_file}


def test_a_file_over_two_gigabytes(spark, tmp_dir):
    """A sparse file larger than any value Spark can hold."""
    path = f"{tmp_dir}/large.bin"
    with open(path, "wb") as f:
        f.write(b"begin")
        f.truncate((1 << 31) + 12_345)
        f.seek(0, 2)
        f.write(b"end")
    manifest = spark.createDataFrame([(path,)], "path string")
    assert [r["sha512"] for r in hash_files(spark, manifest, "path", [tmp_dir]).collect()] == [_hash(path)]


def test_large_files_are_read_in_bounded_chunks(spark, tmp_dir):
    """The opener is given, and nothing larger than a chunk is ever asked of a stream."""
    path = f"{tmp_dir}/f.bin"
    with open(path, "wb") as f:
        f.write(os.urandom(3_000_000))
    limit = hashing.CHUNK_BYTES

    def opened(uri):
        class Stream:
            def __init__(self):
                self.file = open(uri.removeprefix("file:"), "rb")

            def read(self, n):
                if not 0 < n <= limit:
                    raise AssertionError(n)
                return self.file.read(min(n, 4096))

            def __enter__(self):
                return self

            def __exit__(self, *error):
                self.file.close()

        return Stream()

    manifest = spark.createDataFrame([(path,)], "path string")
    got = hash_files(spark, manifest, "path", [tmp_dir], whole_bytes=1000, open_stream=opened).collect()
    assert [r["sha512"] for r in got] == [_hash(path)]


def test_the_content_of_large_files_is_never_a_value(spark, tmp_dir):
    """The size limit reaches the scan of contents."""
    manifest = spark.createDataFrame([(f"{tmp_dir}/x",)], "path string")
    plan = hash_files(spark, manifest, "path", [tmp_dir], whole_bytes=1000)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan binaryFile" in line]
    assert any("content" in s and "LessThanOrEqual(length,1000)" in s for s in scans)
    assert all("content" not in s.split("Batched")[0] for s in scans if "GreaterThan(length,1000)" in s)
