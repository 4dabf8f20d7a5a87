"""Helpers shared by the operators of this subpackage.

Conventions that hold for every operator here:

- Only the named id and text columns are read; extra columns, whatever their
  names, never reach an operator. Outputs carry the id under ``doc_id``.
- A NULL text counts as the empty text. A NULL or repeated id is kept as it
  is: one output row per input row.
- An empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.plans.stages import stage_root

#: A word: a run of characters other than space and \t \n \v \f \r (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows per Arrow batch for whole texts: bounds what a Python worker holds at once.
TEXT_BATCH = 256


def tune(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that carry whole texts."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > TEXT_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
    return spark


def crc_mod(col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(col: Column) -> Column:
    """The words of a text as an array (empty for NULL, empty or blank text)."""
    parts = F.split(F.coalesce(col, F.lit("")), SPACES)
    return F.filter(parts, lambda w: w != "")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """Columns __id and __text that name a row without NULLs: the id (NULL sorts last) and a
    hash of the text. Rows that agree in both are copies of one row."""
    return {
        "__id": F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)),
        "__text": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
    }


def narrow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text only, text never NULL, as UTF-8 bytes."""
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list], list]],
    fields: list[T.StructField],
    carry: list[str] | None = None,
) -> DataFrame:
    """Run ``make()(texts)`` over Arrow batches of a frame with a ``text`` bytes column.

    ``make`` is called once per task and returns a function from a list of
    UTF-8 byte strings to one list per field. ``carry`` columns pass through.
    """
    carry = carry or ["doc_id"]
    out = T.StructType([df.schema[c] for c in carry] + fields)
    n_carry = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        work = make()
        for b in batches:
            if b.num_rows == 0:
                continue
            got = work(b.column("text").to_pylist())
            arrays = [b.column(c) for c in carry]
            arrays += [pa.array(v, type=schema.field(n_carry + i).type) for i, v in enumerate(got)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    tune(df.sparkSession)
    return df.select(*carry, "text").mapInArrow(run, out)


def kept_in_worker(key: tuple, build: Callable):
    """What ``build`` makes, once for each Python worker rather than for each task."""
    import sys
    import types

    held = sys.modules.setdefault("billframe_worker_state", types.ModuleType("billframe_worker_state")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write a stage as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor re-reads files instead of recomputing.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
