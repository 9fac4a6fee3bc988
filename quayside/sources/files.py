"""Files as rows: listing, completeness, SHA-256, and small files replaced in one step."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 4 * 1024 * 1024

# The schemes whose files are listed and hashed, and what the reading library calls them.
SCHEMES = {
    "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss",
}
LISTING = "path string, file_name string, bytes bigint"
HASHES = f"{LISTING}, sha256 string"


def _status(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return filesystem.getFileStatus(target) if filesystem.exists(target) else None


def path_exists(spark: SparkSession, path: str) -> bool:
    return _status(spark, path) is not None


def split_path(path: str) -> tuple[str, str]:
    """Where a path's file system is, and the path within it, as it is, nothing decoded."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return "file:///", path
    known = SCHEMES.get(scheme.lower())
    if known is None:
        raise ValueError(f"files of scheme {scheme} cannot be listed and hashed: {path}")
    if known == "file":
        return "file:///", re.sub(r"^/*", "/", rest)
    authority, _, inside = rest.removeprefix("//").partition("/")
    return f"{known}://{authority}/", inside


def open_path(path: str):
    """A path's file system, for use within tasks, and the path within it."""
    from pyarrow import fs

    root, inside = split_path(path)
    filesystem, base = fs.FileSystem.from_uri(root)
    return filesystem, inside if inside.startswith("/") else f"{base.rstrip('/')}/{inside}"


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        for path in batch["path"]:
            filesystem, inside = open_path(path)
            info = filesystem.get_file_info(inside)
            found = [(path, info)] if info.is_file else []
            if info.type == fs.FileType.Directory:
                inner = filesystem.get_file_info(fs.FileSelector(inside, recursive=True))
                within = [(i.path.removeprefix(inside).strip("/"), i) for i in inner if i.is_file]
                hidden = re.compile(r"(^|/)[_.]")
                found = [(f"{path.rstrip('/')}/{name}", i) for name, i in within if not hidden.search(name)]
            rows = [(p, p.rsplit("/", 1)[-1], i.size) for p, i in found]
            yield pd.DataFrame(rows, columns=["path", "file_name", "bytes"])


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, file_name and bytes of the given files, or of the files in the given folders.

    Contents are not read.  Empty files are listed; names that begin with ``_`` or ``.``
    are not.  A scheme that cannot be read is refused before any work.
    """
    for path in paths:
        split_path(path)
    given = spark.createDataFrame([(p,) for p in paths], "path string")
    return given.repartition(min(max(len(paths), 1), _tasks(spark)), "path").mapInPandas(_list, LISTING)


def _tasks(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


def _hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for path in batch["path"]:
            filesystem, inside = open_path(path)
            digest = hashlib.sha256()
            with filesystem.open_input_stream(inside, compression=None) as stream:
                while block := stream.read(BLOCK_BYTES):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def hash_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, file_name, bytes and sha256 of files, or of the files in folders.

    A file of any size is read in blocks, one file at a time, so memory does not grow
    with it.
    """
    # An explicit partition count keeps adaptive execution from packing the few
    # bytes of all paths, and with them all the hashing, into one task.
    return list_files(spark, paths).repartition(_tasks(spark), "path").mapInPandas(_hash, HASHES)


def names_in(spark: SparkSession, directory: str) -> list[str]:
    """The names directly in a folder; none if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(directory)
    filesystem = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(target):
        return []
    return [entry.getPath().getName() for entry in filesystem.listStatus(target)]


def missing_files(spark: SparkSession, directory: str, expected: list[str]) -> DataFrame:
    """Expected names that the directory does not hold (as a file or a folder of parts)."""
    listed = [(name,) for name in names_in(spark, directory)]
    wanted = spark.createDataFrame([(name,) for name in expected], "file_name string")
    return wanted.join(spark.createDataFrame(listed, "file_name string"), "file_name", "left_anti")


def replace_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its target, then rename it over the target in one step."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(path + ".draft")
    conf = spark._jsc.hadoopConfiguration()
    stream = target.getFileSystem(conf).create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, target, options)


def read_text_file(spark: SparkSession, path: str) -> str:
    """A small file as text, hidden names included."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
