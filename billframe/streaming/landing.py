"""Landing-zone mode (structured streaming).

New PDFs landing under ``raw`` are detected by a file-stream source; each
non-empty micro-batch runs the batch plan over its own files
(``foreachBatch``), under a batch id made from its number, so a micro-batch
that is delivered again after its commit is not run again. The micro-batch is
its own listing: the tree is not walked, and only its files are opened.
``trigger(availableNow=True)`` drains what is there and stops, so a daily job
and a continuous one share one code path.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from billframe.config import DEFAULT_SETTINGS, Settings
from billframe.plans.batch import BatchPaths, run_batch

#: Spark's columns of a binary file (fixed values).
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def start(spark: SparkSession, paths: BatchPaths, checkpoint: str, settings: Settings = DEFAULT_SETTINGS,
          available_now: bool = True, opener=None):
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.[pP][dD][fF]").load(paths.raw).select("path", "length", "modificationTime"))

    def per_batch(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        run_batch(spark, paths, batch_id=f"stream-{epoch:08d}", settings=settings, listing=batch, opener=opener)

    writer = files.writeStream.foreachBatch(per_batch).option("checkpointLocation", os.path.join(checkpoint, "landing"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
