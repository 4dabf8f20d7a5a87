"""What a batch writes, published by one commit.

Every run writes its sinks into folders of its own
(``<sink>/batch_date=<d>/batch_id=<b>/run=<r>``, gold and its keys into
``run=<r>`` below their own partitions) and then adds one file to ``_commits``.
The file appears whole or not at all and names the run: before it, no reader
sees anything of the run; after it, all of it. A run that dies leaves folders
that no commit names; the batch is simply run again, and ``unpublished`` lists
what may be deleted. Of several commits of one batch the last one counts.

The log has one small file for each batch; readers turn it into a filter on the
partition columns ``run`` (and ``batch_date``, ``batch_id``), so the scan reads
published folders only. Versions are taken by creating the next file without
overwriting: of two writers one fails and looks again. If what it decided on -
gold's keys - was added to since it began, it ends with ``Conflict`` and is run
again; otherwise it takes the version after.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of batches that were not taken from a date's folder.
UNDATED = "undated"
LOG = "_commits"


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


@dataclass(frozen=True)
class Commit:
    version: int
    batch_id: str
    batch_date: str
    run: str
    committed_at: str
    sinks: dict = field(default_factory=dict)  # name -> {"kind", "schema", "partitions"}


def commits(spark: SparkSession, out: str) -> list[Commit]:
    """All commits, oldest first: a row for each batch ever run."""
    folder = os.path.join(out, LOG)
    if not exists(spark, folder):
        return []
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(folder).collect()
    return sorted((Commit(**json.loads(r["value"])) for r in rows), key=lambda c: c.version)


def live(spark: SparkSession, out: str) -> dict[str, Commit]:
    """The commit that counts for each batch, oldest first."""
    last = {c.batch_id: c for c in commits(spark, out)}
    return dict(sorted(last.items(), key=lambda kv: kv[1].version))


def _publish(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that must not exist yet; False if it does."""
    jvm = spark.sparkContext._jvm
    src, _ = _hadoop(spark, source)
    dst, fs = _hadoop(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(src), fs.makeQualified(dst), none)
        return True
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            return False
        raise


class Conflict(RuntimeError):
    """Another run was committed whose keys this one has not seen."""


#: Sinks that runs decide on: first write wins on what is in them.
DECISIVE = frozenset({"gold_keys"})


class Run:
    """The sinks of one run of a batch, unpublished until ``commit``."""

    def __init__(self, spark: SparkSession, out: str, batch_id: str, batch_date: str | None):
        self.spark, self.out, self.batch_id = spark, out, batch_id
        self.batch_date = batch_date or UNDATED
        self.run = uuid.uuid4().hex
        self.base = max((c.version for c in commits(spark, out)), default=0)
        self.sinks: dict[str, dict] = {}

    def write(self, df: DataFrame, sink: str, kind: str = "parquet", partition_by: list[str] | None = None) -> DataFrame:
        """Write a sink's rows and read them back. With ``partition_by`` these columns come first in the layout."""
        rows = df.drop("batch_id", "batch_date") if partition_by is None else df
        base = os.path.join(self.out, sink)
        if partition_by is None:
            path = os.path.join(base, f"batch_date={self.batch_date}", f"batch_id={self.batch_id}", f"run={self.run}")
            rows.write.mode("overwrite").format(kind).save(path)
            self.sinks[sink] = {"kind": kind, "schema": rows.schema.json(), "partitions": ["batch_date", "batch_id", "run"]}
            return self.spark.read.format(kind).schema(rows.schema).load(path)
        rows = rows.withColumn("run", F.lit(self.run))
        # Appending adds folders of this run only, and no file outside them.
        rows.write.mode("append").partitionBy(*partition_by, "run").format(kind).save(base)
        self.sinks[sink] = {"kind": kind, "schema": rows.drop("run").schema.json(), "partitions": [*partition_by, "run"]}
        return df

    def commit(self, committed_at: str) -> Commit:
        folder = os.path.join(self.out, LOG)
        draft, fs = _hadoop(self.spark, os.path.join(folder, f"_{self.run}.tmp"))
        fs.mkdirs(_hadoop(self.spark, folder)[0])
        while True:
            known = commits(self.spark, self.out)
            if any(c.version > self.base and DECISIVE & c.sinks.keys() for c in known) and DECISIVE & self.sinks.keys():
                raise Conflict(f"a batch was committed while {self.batch_id} ran: run it again")
            version = max((c.version for c in known), default=0) + 1
            made = Commit(version, self.batch_id, self.batch_date, self.run, committed_at, self.sinks)
            stream = fs.create(draft, True)
            try:
                stream.write(bytearray(json.dumps(made.__dict__).encode()))
            finally:
                stream.close()
            if _publish(self.spark, draft.toString(), os.path.join(folder, f"{version:012d}.json")):
                return made


def read_sink(spark: SparkSession, out: str, sink: str, batch_id: str | None = None, batch_date: str | None = None,
              but: str | None = None) -> DataFrame | None:
    """The published rows of a sink: of all batches, of one, of one date, or of all but one. None where there are none."""
    chosen = [
        c for c in live(spark, out).values()
        if sink in c.sinks and batch_id in (None, c.batch_id) and batch_date in (None, c.batch_date) and but != c.batch_id
    ]
    if not chosen:
        return None
    spec = chosen[-1].sinks[sink]
    base = os.path.join(out, sink)
    parts = spec["partitions"]
    rows = T.StructType.fromJson(json.loads(spec["schema"]))
    schema = T.StructType([f for f in rows.fields if f.name not in parts])
    for name in parts:
        known = [f for f in rows.fields if f.name == name]
        schema.add(known[0] if known else T.StructField(name, T.StringType()))
    found = spark.read.format(spec["kind"]).schema(schema).option("basePath", base).load(base)
    if "batch_date" in parts and batch_date is not None:
        found = found.where(F.col("batch_date") == batch_date)
    if "batch_id" in parts and batch_id is not None:
        found = found.where(F.col("batch_id") == batch_id)
    return found.where(F.col("run").isin([c.run for c in chosen])).drop("run")


def unpublished(spark: SparkSession, out: str) -> list[str]:
    """Folders of runs that no commit counts: left by runs that died or were replaced."""
    published = {f"run={c.run}" for c in live(spark, out).values()}
    base, fs = _hadoop(spark, out)
    if not fs.exists(base):
        return []
    found, level = [], [base]
    while level:
        below = [s.getPath() for p in level for s in fs.listStatus(p) if s.isDirectory()]
        found += [p.toString() for p in below if p.getName().startswith("run=") and p.getName() not in published]
        level = [p for p in below if not p.getName().startswith("run=") and p.getName() != LOG]
    return sorted(found)
