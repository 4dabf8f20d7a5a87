"""SimHash near-duplicates, linked exactly through vantage-point trees.

Fingerprint: words of the text with A-Z lower-cased, shingles of ``shingle``
consecutive words (fewer words: the whole sequence), XXH64 of each with a
fixed seed, repeats included; a bit is 1 if it is set in over half the hashes.
A text without words has fingerprint zero.

Links: fingerprints at ``max_bits`` differing bits or fewer. Equal
fingerprints are collapsed first. A tree over all 64 bits prunes next to
nothing at such a radius (distances to a vantage point crowd around 32 with a
deviation of 4), so the bits are dealt into ``max_bits // 2 + 1`` blocks: if
two fingerprints differ in at most ``max_bits`` bits, some block differs in at
most one. Each block has a vantage-point tree whose nodes split by the exact
Hamming distance to the node's vantage point. By the triangle bound, a
fingerprint within one bit lies in the same child or in a neighbouring one -
and, since one flipped bit moves every distance by exactly one, either the
same child at all levels or a neighbour at all levels. The tree's leaves are
the shards: a fingerprint is kept in its own leaf and sent to the boundary
leaves above it (those below find it from their side). Within a shard all
pairs are tested on the full 64 bits, block by block against the not yet
reached, so a shard yields a spanning forest and never all pairs of a group.

The depth follows from the number of distinct fingerprints, so that shards
stay small at any size. A shard cannot be filled by one group of near copies
beyond the number of distinct fingerprints within a few bits of each other,
since equal ones are collapsed.

Edge cases: NULL, empty and blank texts share fingerprint zero and are linked
like others; repeated rows share a fingerprint; a NULL id takes part but is
never a component's smallest id unless the component has no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import map_texts, narrow, row_key, write_stage
from billframe.llm.components import connected_components

SEED = 42
_FP = [T.StructField("fp", T.LongType(), False)]
#: Rows that a shard holds on average, at most.
SHARD_ROWS = 2_000


def fingerprint(raw: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    ws = raw.lower().split()  # of bytes: A-Z and ASCII white space only
    if not ws:
        return 0
    if len(ws) <= shingle:
        return xxh64_intdigest(b" ".join(ws), SEED)
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), dtype=np.int64, count=len(ws)) + 1) - 1
    stops = ends[shingle - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    hashes = np.fromiter(
        (xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype="<u8", count=len(stops)
    )
    total = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.unpackbits(hashes[i : i + 65_536].view(np.uint8), bitorder="little").reshape(-1, 64)
        total += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""
    return map_texts(narrow(docs, id_col, text_col), _marker(shingle), _FP)


def _marker(shingle: int):
    def make():
        return lambda texts: [np.array([fingerprint(x, shingle) for x in texts], dtype=np.uint64).view(np.int64)]

    return make


def blocks(max_bits: int) -> list[int]:
    """Bit masks that share out the 64 bits so that one differs in at most one bit."""
    n = max_bits // 2 + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def vantage_points(mask: int, levels: int) -> list[int]:
    """Fixed pseudo-random vantage points of one block's tree, one for each level."""
    return [
        int.from_bytes(hashlib.sha256(f"{mask}:{i}".encode()).digest()[:8], "big") & mask for i in range(levels)
    ]


def depth(n_distinct: int, max_bits: int) -> int:
    """The least depth that keeps the average shard at SHARD_ROWS rows."""
    width = 64 / (max_bits // 2 + 1)
    children = (2 * np.pi * np.e * width / 4) ** 0.5  # effective number of children of a node
    levels = 1
    while n_distinct * (1 + 2 ** (levels - 1)) / children**levels > SHARD_ROWS and levels < 9:
        levels += 1
    return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shards(fps: DataFrame, max_bits: int, levels: int) -> DataFrame:
    """shard, fp: each distinct fingerprint in its own leaf and in the boundary leaves above."""
    copies = []
    steps = range(1 << (levels - 1))
    for k, mask in enumerate(blocks(max_bits)):
        rings = [
            F.bit_count(F.col("fp").bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(_signed(p))))
            for p in vantage_points(mask, levels)
        ]
        leaf = lambda moves, k=k, rings=rings: sum(
            ((r + F.lit(m)).cast("long") * F.lit(128**i) for i, (r, m) in enumerate(zip(rings, moves, strict=True))),
            F.lit(k * 128 ** len(rings)).cast("long"),
        )
        copies.append(leaf([0] * levels))
        for s in steps:
            copies.append(leaf([1, *(1 if s >> i & 1 else -1 for i in range(levels - 1))]))
    return fps.select(F.explode(F.array(*copies)).alias("shard"), "fp")


def forest(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that span the components of one shard's fingerprints."""
    left, out_a, out_b = np.unique(fp), [], []
    while len(left) > 1:
        # one node after the other is compared with all that are not yet reached
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.zeros(len(left), dtype=bool)
            source = np.empty(len(left), dtype=left.dtype)
            for f in frontier:
                hit = (np.bitwise_count(left ^ f) <= max_bits) & ~near
                source[hit] = f
                near |= hit
                if near.all():
                    break
            out_a.append(source[near])
            out_b.append(left[near])
            frontier, left = left[near], left[~near]
    none = np.empty(0, dtype=fp.dtype)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def links(fps: DataFrame, max_bits: int, levels: int) -> DataFrame:
    """a, b: links between distinct fingerprints that connect whatever is connected."""
    dealt = shards(fps, max_bits, levels).repartition("shard").sortWithinPartitions("shard")
    out = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush():
            fp = np.concatenate(held) if len(held) > 1 else held[0]
            a, b = forest(fp, max_bits) if len(fp) > 1 else (fp[:0], fp[:0])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a.view(np.int64), b.view(np.int64))), pa.array(np.maximum(a.view(np.int64), b.view(np.int64)))],
                names=["a", "b"],
            )

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                if shard[i] != key:
                    if held and sum(map(len, held)) > 1:
                        got = flush()
                        if got.num_rows:
                            yield got
                    key, held = shard[i], []
                held.append(fp[i:j].copy())
        if held and sum(map(len, held)) > 1:
            got = flush()
            if got.num_rows:
                yield got

    return dealt.mapInArrow(run, out)


def groups(marks: DataFrame, max_bits: int) -> DataFrame:
    """For a written frame with doc_id and fp: (fp, first: smallest doc_id of each distinct
    fingerprint, root: the fingerprint that names its component)."""
    firsts = write_stage(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    found = links(firsts.select("fp"), max_bits, depth(firsts.count(), max_bits))
    parts = connected_components(found)
    return firsts.join(parts, firsts["fp"] == parts["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, fp (signed long) and component_id (smallest doc_id reachable) of every row."""
    marks = write_stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    rooted = write_stage(groups(marks, max_bits), "roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marks.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each component - that with the smallest doc_id - with the columns it came with.

    Rows that share that doc_id are told apart by a hash of their text; of
    rows that agree in both one stays. NULL ids come after all others.
    """
    keyed = docs.withColumns(row_key())
    marks = write_stage(
        map_texts(
            keyed.select("__id", "__text", F.coalesce("text", F.lit("")).cast("binary").alias("text")),
            _marker(shingle),
            _FP,
            carry=["__id", "__text"],
        ),
        "fingerprints",
    )
    rooted = groups(marks.select(F.col("__id").alias("doc_id"), "fp"), max_bits).select("fp", "root")
    keep = (
        marks.join(rooted, "fp").groupBy("root").agg(F.min(F.struct("__id", "__text")).alias("k")).select("k.*")
    )
    stay = keyed.join(keep, ["__id", "__text"], "left_semi")
    once = F.row_number().over(Window.partitionBy("__id", "__text").orderBy(F.lit(1)))
    return stay.withColumn("__nth_copy", once).where("__nth_copy = 1").select(*docs.columns)
