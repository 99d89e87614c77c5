"""Landing-zone manifest: path, size and SHA-256 of every file as received."""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import utc

#: Bytes of a file that a task holds at a time.
PIECE = 8 * 1024 * 1024
#: Schemes that the file-system layer knows by another name.
_ALIASES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}

#: Opens the store behind a URI: (file system, path of the URI in it).
Store = Callable[[str], tuple[fs.FileSystem, str]]


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI: local files, HDFS, view file systems and the object stores that pyarrow reaches."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_ALIASES.get(scheme, scheme)}:{rest}")


def _listed(store: fs.FileSystem, path: str, recursive: bool) -> list[fs.FileInfo]:
    found = store.get_file_info(path)
    return [found] if found.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=recursive))


def file_sha256(store: fs.FileSystem, path: str, piece: int = PIECE) -> tuple[int, str]:
    """(bytes, SHA-256) of a file of any size, read in pieces."""
    digest, size = hashlib.sha256(), 0
    with store.open_input_stream(path) as stream:
        while data := stream.read(piece):
            digest.update(data)
            size += len(data)
    return size, digest.hexdigest()


def landing_manifest(spark: SparkSession, landing_dir: str, *, pattern: str = "*", stores: Mapping[str, Store] | None = None) -> DataFrame:
    """``file_name, path, bytes, sha256`` for each file under ``landing_dir`` (or of that file) whose name matches ``pattern``.

    Every file, the empty one and the one of many gigabytes alike, is hashed from a stream of pieces of 8 MiB. Folders are listed
    in tasks too: the top folder in one, each of its folders in one of its own, and the driver sees no path but
    the first. Tasks reach the store through ``open_store``; ``stores`` names another way for a scheme. A file that disappears
    between listing and hashing is an error.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(landing_dir)
    root = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString().rstrip("/")
    scheme = root.partition(":")[0]
    store_of = (stores or {}).get(scheme, open_store)

    def named(path: str, base: str) -> str:
        inside = path[len(base):].strip("/")
        return f"{root}/{inside}" if inside else root

    def wanted(found: fs.FileInfo, base: str) -> bool:
        """Folders and matching files, but for those that a scan of the folder would skip as hidden."""
        hidden = any(part.startswith((".", "_")) for part in found.path[len(base):].split("/"))
        return not hidden and (found.type == fs.FileType.Directory or fnmatch.fnmatchcase(found.base_name, pattern))

    def listing(recursive: bool):
        def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, base = store_of(root)
            base = base.rstrip("/")
            for batch in batches:
                for uri in batch.column(0).to_pylist():
                    found = [x for x in _listed(store, base + uri[len(root):], recursive) if wanted(x, base)]
                    yield pa.record_batch([pa.array([named(x.path, base) for x in found], pa.string()),
                                           pa.array([x.type == fs.FileType.Directory for x in found], pa.bool_())], names=["path", "folder"])
        return files

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        base = base.rstrip("/")
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                size, digest = file_sha256(store, base + uri[len(root):])
                yield pa.record_batch([pa.array([uri.rsplit("/", 1)[1]]), pa.array([uri]), pa.array([size], pa.int64()), pa.array([digest])],
                                      names=["file_name", "path", "bytes", "sha256"])

    first = spark.createDataFrame([(root,)], "path string").mapInArrow(listing(False), "path string, folder boolean")
    deeper = first.filter("folder").select("path").repartition("path").mapInArrow(listing(True), "path string, folder boolean")
    return first.unionByName(deeper).filter("NOT folder").select("path").repartition("path").mapInArrow(hashed, "file_name string, path string, bytes bigint, sha256 string")


def record_landing(manifest: DataFrame, *, batch_id: str, env: str, ingestion_ts: str) -> DataFrame:
    """Manifest rows as stored: tagged with the batch and the moment it arrived."""
    return manifest.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "env": F.lit(env),
            "ingestion_ts": F.lit(utc(ingestion_ts).isoformat()).cast("timestamp"),
        }
    )


def landing_changes(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """Files that are not byte-for-byte what was recorded: added, removed or altered."""
    status = (
        F.when(F.col("r.path").isNull(), "added")
        .when(F.col("f.path").isNull(), "removed")
        .when(~F.col("r.sha256").eqNullSafe(F.col("f.sha256")) | (F.col("r.bytes") != F.col("f.bytes")), "altered")
    )
    return (
        recorded.alias("r")
        .join(found.alias("f"), F.col("r.path") == F.col("f.path"), "full_outer")
        .select(
            F.coalesce(F.col("r.path"), F.col("f.path")).alias("path"),
            status.alias("status"),
            F.col("r.sha256").alias("recorded_sha256"),
            F.col("f.sha256").alias("found_sha256"),
        )
        .filter(F.col("status").isNotNull())
    )
