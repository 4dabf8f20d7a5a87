"""A1, A4: a manifest of files as a Spark data source, and the look into files chosen from it.

The source ``file_manifest`` lists files (path, length, modification time) and
opens none. Its partitions are folders: the driver descends level by level only
until there are ``folders`` of them, every task lists its folder with all below
it. What a batch needs - a date's folder, the first n, the files of a
micro-batch - is chosen on this listing; ``looked_into`` then opens the chosen
files, once each, in tasks of their own: five bytes by range, and the digest in
chunks for files that pass the gates.

Stores are opened through Arrow's file systems (local, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from billframe.config import MAX_DOCUMENT_SIZE_BYTES

LISTING_SCHEMA = "path string, length bigint, modificationTime timestamp"
PDF_MAGIC = b"%PDF-"
CHUNK = 1 << 20
#: Rows of a listing handed on at once.
LISTED = 10_000
#: Bytes of chosen files that one task opens.
TASK_BYTES = 128 << 20
TASK_FILES = 2_000
#: Hadoop's names of stores that Arrow knows under another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def store(path: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of a path, the path in it, and what goes before paths of that system."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "file", path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    found, inner = pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    whole = path.rstrip("/")
    return found, inner, whole[: len(whole) - len(inner.rstrip("/"))]


def readable(path: str) -> bool:
    """Whether Arrow can open this kind of store."""
    try:
        store(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def open_stream(path: str):
    """A file of any store for reading, as a context manager with ``read(n)``."""
    found, inner, _ = store(path)
    return found.open_input_file(inner)


@dataclass
class Folder(InputPartition):
    path: str
    deep: bool

    def __init__(self, path: str, deep: bool):
        super().__init__(path)
        self.path, self.deep = path, deep


class ManifestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.suffix = options.get("suffix", ".pdf").lower()
        self.folders = int(options.get("folders", "64"))

    def partitions(self) -> list[InputPartition]:
        found, base, _ = store(self.root)
        if found.get_file_info(base).type != pafs.FileType.Directory:
            return [Folder("", False)]  # a missing root lists nothing
        level, out = [base], []
        while level and len(level) < self.folders:
            out += [Folder(p, False) for p in level]
            level = [
                i.path
                for p in level
                for i in found.get_file_info(pafs.FileSelector(p))
                if i.type == pafs.FileType.Directory
            ]
        return out + [Folder(p, True) for p in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        found, _, prefix = store(self.root)
        infos = found.get_file_info(pafs.FileSelector(partition.path, recursive=partition.deep, allow_not_found=True))
        files = [i for i in infos if i.type == pafs.FileType.File and i.path.lower().endswith(self.suffix)]
        names = ["path", "length", "modificationTime"]
        for first in range(0, len(files), LISTED):
            some = files[first : first + LISTED]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([prefix + i.path for i in some], pa.string()),
                    pa.array([i.size or 0 for i in some], pa.int64()),
                    pa.array([i.mtime or _dt.datetime.fromtimestamp(0, _dt.timezone.utc) for i in some], pa.timestamp("us", tz="UTC")),
                ],
                names=names,
            )


class ManifestSource(DataSource):
    """``spark.read.format("file_manifest").option("suffix", ".pdf").load(root)``"""

    @classmethod
    def name(cls) -> str:
        return "file_manifest"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> ManifestReader:
        return ManifestReader(self.options)


def listed(spark: SparkSession, root: str, suffix: str = ".pdf") -> DataFrame:
    """Every file below ``root`` with this ending, in any case of letters; a missing root has none."""
    spark.dataSource.register(ManifestSource)
    return spark.read.format("file_manifest").option("suffix", suffix).load(root)


def looked_into(files: DataFrame, digest: bool = True, opener: Callable | None = None) -> DataFrame:
    """``files`` (path, size_bytes, ...) with has_pdf_magic and sha256.

    Empty and oversized files are not opened. A file that cannot be read counts
    as a PDF without digest, so that extraction fails it rather than discovery
    hiding it. Write ``files`` before: its size decides the number of tasks.
    """
    opener = opener or open_stream
    total = files.agg(F.sum("size_bytes").alias("b"), F.count(F.lit(1)).alias("n")).first()
    tasks = max(1, -(-(total["b"] or 0) // TASK_BYTES), -(-total["n"] // TASK_FILES))
    out = files.select("*", F.lit(False).alias("has_pdf_magic"), F.lit("").alias("sha256")).schema
    out["has_pdf_magic"].nullable = out["sha256"].nullable = True

    def look(path: str, size: int) -> tuple[bool | None, str | None]:
        if size <= 0:
            return False, None
        if size > MAX_DOCUMENT_SIZE_BYTES:
            return None, None
        try:
            with opener(path) as f:
                head = bytes(f.read(len(PDF_MAGIC)))
                if head != PDF_MAGIC or not digest:
                    return head == PDF_MAGIC, None
                h = hashlib.sha256(head)
                while chunk := f.read(CHUNK):
                    h.update(chunk)
                return True, h.hexdigest()
        except OSError:
            return True, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [look(p, n) for p, n in zip(b.column("path").to_pylist(), b.column("size_bytes").to_pylist())]
            arrays = [*b.columns, pa.array([s[0] for s in seen], pa.bool_()), pa.array([s[1] for s in seen], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, "has_pdf_magic", "sha256"])

    return files.repartition(tasks).mapInArrow(run, out)
