"""File discovery, gates and batch identity.

A listing (path, size, modification time) comes first - from a table if the
caller keeps one, else from the ``file_manifest`` source - and date, limit,
micro-batch and size gate are decided on it. Only the files chosen and within
the limit are opened, once, for their header and digest.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.config import EXTRACTION_ERROR, MAX_DOCUMENT_SIZE_BYTES
from billframe.sources import manifest_source as S


def _path_exists(spark: SparkSession, root: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _empty_files(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Zero-byte PDFs under root, which Spark's file index leaves out (a walk of the tree on the
    driver: large trees pass a listing instead)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if st.getLen() == 0 and name.lower().endswith(".pdf"):
            out.append((st.getPath().toString(), st.getModificationTime()))
    return out


_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*"


def _base(spark: SparkSession, root: str) -> str:
    """The qualified path of a folder without its scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    whole = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub(_SCHEME, "/", whole).rstrip("/")


def relative_path(spark: SparkSession, path: Column, root: str, encoded: bool = False) -> Column:
    """The part of a file's path below ``root``, whatever form of URI either has.

    ``encoded``: the path is URL-encoded, as in Spark's file metadata column.
    """
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path
    return F.substring(F.regexp_replace(plain, _SCHEME, "/"), len(_base(spark, root)) + 2, 1 << 30)


def document_key(relative: Column) -> Column:
    """A document's name in every stage: its relative path, with one form of extension.

    Captured results carry it too, with a suffix for their kind.
    """
    return F.concat(F.regexp_replace(relative, r"(?i)(\.blocks|\.mapped|\.attempt\d+)?(\.page[a-z0-9_-]*)?\.(json|pdf)$", ""), F.lit(".pdf"))


def _described(files: DataFrame) -> list[Column]:
    return [
        F.col("path"),
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_utc"),
    ]


def _listed_by_spark(spark: SparkSession, root: str) -> DataFrame:
    """Listing of a store that only Spark can open: its file index, and the empty files it leaves out."""
    columns = ["path", "length", "modificationTime"]
    if not _path_exists(spark, root):
        return spark.createDataFrame([], S.LISTING_SCHEMA)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.[pP][dD][fF]").load(root).select(*columns))
    empty = spark.createDataFrame(_empty_files(spark, root), "path string, mtime long").select(
        "path", F.lit(0).cast("bigint").alias("length"), F.timestamp_millis("mtime").alias("modificationTime"))
    return files.unionByName(empty)


def list_files(spark: SparkSession, root: str, listing: DataFrame | None = None, only: DataFrame | None = None,
               limit: int | None = None) -> DataFrame:
    """The ``.pdf`` files under root (path, filename, size_bytes, modified_utc); none is opened.

    ``listing`` (path, length, modificationTime) replaces the walk of the tree;
    its rows outside root and other than ``.pdf`` do not count. ``only``: the
    files with these paths; ``limit``: the first so many of them in path order.
    """
    if listing is not None:
        below = F.regexp_replace("path", _SCHEME, "/").startswith(_base(spark, root) + "/")
        found = listing.where(below & F.lower("path").endswith(".pdf")).select("path", "length", "modificationTime")
    else:
        found = S.listed(spark, root) if S.readable(root) else _listed_by_spark(spark, root)
    if only is not None:
        name = F.regexp_replace("path", _SCHEME, "/")
        wanted = only.select(name.alias("_name")).distinct()
        found = found.withColumn("_name", name).join(wanted, "_name", "left_semi").drop("_name")
    return limit_batch(found.select(*_described(found)), limit)


def with_headers(spark: SparkSession, files: DataFrame, root: str, with_sha256: bool = True, opener=None) -> DataFrame:
    """A2, A3: header test and digest of chosen files (see ``manifest_source.looked_into``)."""
    if opener is not None or S.readable(root):
        return S.looked_into(files, with_sha256, opener)
    # A store that only Spark can open: whole contents, of the files that pass the size gate.
    contents = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]")
                .load(root).where(F.col("length") <= MAX_DOCUMENT_SIZE_BYTES))
    magic = F.substring("content", 1, 5) == F.lit(bytearray(S.PDF_MAGIC))
    seen = contents.select(
        F.col("path").alias("_path"), magic.alias("has_pdf_magic"),
        (F.when(magic, F.sha2("content", 256)) if with_sha256 else F.lit(None).cast("string")).alias("sha256"))
    return files.join(seen, F.col("path") == F.col("_path"), "left").drop("_path")


def discover_files(spark: SparkSession, root: str, with_sha256: bool = True, listing: DataFrame | None = None,
                   only: DataFrame | None = None, limit: int | None = None, opener=None) -> DataFrame:
    """A1-A3: manifest of the chosen ``.pdf`` files under root; a missing root yields an empty one.

    Choice comes before any file is opened. Oversized files are never opened
    (no header test), empty ones fail it; only files with the header have a digest.
    """
    return with_headers(spark, list_files(spark, root, listing, only, limit), root, with_sha256, opener)


def path_order(path: Column) -> Column:
    """A1: file paths in order of their components (arrays compare element by element)."""
    return F.split(path, "/")


def in_order(manifest: DataFrame) -> DataFrame:
    """The manifest with ``discovery_order``: unique, rising along the sorted paths, not dense.

    Sorted by ranges, not in one task. Write the result before using it twice.
    """
    key = path_order(F.col("path"))
    ranged = manifest.withColumn("_key", key).repartitionByRange("_key").sortWithinPartitions("_key")
    return ranged.withColumn("discovery_order", F.monotonically_increasing_id()).drop("_key")


def partition_root(root: str, batch_date: _dt.date, template: str = "%Y/%m/%d") -> str:
    """A4: the folder of one business date."""
    return f"{root.rstrip('/')}/{batch_date.strftime(template)}"


def size_rejected(size_bytes: Column) -> Column:
    """Empty or above the 500 MiB service limit (exactly the limit passes)."""
    return (size_bytes <= 0) | (size_bytes > F.lit(MAX_DOCUMENT_SIZE_BYTES))


def gate_rule(manifest: DataFrame) -> DataFrame:
    """2.J #1-#2: no PDF header, then size gate -> EXTRACTION_FAILED (stage extraction)."""
    fail = (~F.coalesce(F.col("has_pdf_magic"), F.lit(False))) | size_rejected(F.col("size_bytes"))
    return manifest.withColumn("hard_rule", F.when(fail, F.lit("EXTRACTION_FAILED"))).withColumn(
        "error_type", F.when(fail, F.lit(EXTRACTION_ERROR))).withColumn(
        "failed_at_stage", F.when(fail, F.lit("extraction")))


def resolve_batch_date(explicit: str | _dt.date | None = None, override: str | None = None) -> _dt.date:
    """A5: explicit date (or 'YYYY-MM-DD') > configured override > today (UTC)."""
    if isinstance(explicit, _dt.date):
        return explicit
    if explicit:
        return _dt.date.fromisoformat(explicit)
    if override:
        return _dt.date.fromisoformat(override)
    return _dt.datetime.now(_dt.timezone.utc).date()


def batch_date_prefix(date_col: Column, template: str = "yyyy/MM/dd/") -> Column:
    """Zero-padded date prefix (Spark datetime pattern; 'yyyy/M/d/' for unpadded)."""
    return F.date_format(date_col, template)


def new_batch_id(ts: Column | None = None) -> Column:
    """A9: 'yyyy-MM-ddTHH-mm-ssZ-run01'."""
    return F.date_format(ts if ts is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH-mm-ss'Z-run01'")


def manifest_diff(current: DataFrame, mirrored: DataFrame) -> DataFrame:
    """Files to copy = not already mirrored with the same (batch_date, filename, size)."""
    keys = ["batch_date", "filename", "size_bytes"]
    return current.join(mirrored.select(*keys).distinct(), keys, "left_anti")


def limit_batch(manifest: DataFrame, n: int | None) -> DataFrame:
    """The first n files of the sorted discovery."""
    return manifest if n is None else manifest.orderBy(path_order(F.col("path"))).limit(n)
