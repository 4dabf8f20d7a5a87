"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Every window of ``window`` consecutive words of a test item (an item with
fewer words, but not none, is one window) is a pattern. One automaton holds
all patterns; each text is normalised and scanned once, and the words under
any match are mapped back to offsets of the original text.

Normalisation works on UTF-8 bytes and keeps their number: A-Z become a-z and
every other ASCII byte outside 0-9a-z becomes a space, so byte offsets of the
normalised and the original text agree.

Edge cases: a NULL or empty text has no words and no hits; an item without
words gives no pattern; items that repeat an id count once; the windows of an
item with a NULL id mark words but have no id to report; an empty benchmark
hits nothing. Ids are of any type.

Scale: items of up to ``automaton_chars`` bytes in all are one automaton, sent
to the tasks and built once in each worker; the texts are scanned where they
lie. A larger benchmark is cut into pieces (overlapping by a window but one
word, so no window is lost), dealt by hash into shards of that size and
written; the texts are scanned once for each shard, so neither driver nor task
ever holds more than one, and the hits of a row are united afterwards.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import kept_in_worker, map_texts, narrow, tune, write_stage

_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
#: Characters of test items that one automaton takes (about 60 bytes of memory each, times the window).
AUTOMATON_CHARS = 400_000

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _hit_fields(item: T.DataType) -> list[T.StructField]:
    return [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_hit", T.LongType(), False),
        T.StructField("items", T.ArrayType(item), False),
        T.StructField("spans", T.ArrayType(_SPAN), False),
    ]


def normalise(raw: bytes) -> list[bytes]:
    """The normalised words of a text."""
    return raw.translate(_TABLE).split()


def item_windows(raw: bytes, window: int) -> list[bytes]:
    """Patterns of one item, each word-aligned by a space on either side."""
    ws = normalise(raw)
    if not ws:
        return []
    n = max(1, len(ws) - window + 1)
    return [b" " + b" ".join(ws[i : i + window]) + b" " for i in range(n)]


def build(items: list[tuple], window: int):
    """An automaton whose values are (words in the pattern, item ids)."""
    import ahocorasick

    owners: dict[bytes, set] = {}
    for item, raw in items:
        for w in item_windows(raw, window):
            owners.setdefault(w, set()).add(item)
    machine = ahocorasick.Automaton()
    for w, ids in owners.items():
        machine.add_word(w.decode("latin-1"), (w.count(b" ") - 1, tuple(ids)))
    if len(machine):
        machine.make_automaton()
    return machine


def find(machine, raw: bytes) -> tuple[int, list[tuple[int, int]], list]:
    """Number of words, ranges of hit words and hit items of one text."""
    ws = normalise(raw)
    found: set = set()
    ranges: list[tuple[int, int]] = []
    if ws and len(machine):
        line = b" " + b" ".join(ws) + b" "
        gaps = None
        for end, (size, ids) in machine.iter(line.decode("latin-1")):
            if gaps is None:
                gaps = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
            last = int(np.searchsorted(gaps, end))  # the space at `end` closes word last - 1
            ranges.append((last - size, last))
            found.update(ids)
    return len(ws), ranges, sorted(i for i in found if i is not None)


def marked(raw: bytes, n: int, ranges: list[tuple[int, int]]) -> tuple[int, list[dict]]:
    """Number of hit words, and the character spans of their runs in the original text."""
    if not ranges:
        return 0, []
    step = np.zeros(n + 1, dtype=np.int64)
    for a, b in ranges:
        step[a] += 1
        step[b] -= 1
    hit = np.cumsum(step[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    data = np.frombuffer(raw.translate(_TABLE), dtype=np.uint8)
    inside = np.concatenate(([0], (data != 32).view(np.int8), [0]))
    starts, ends = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # characters before each byte
    spans = [
        {"start": int(before[starts[a]]), "end": int(before[ends[b - 1]])}
        for a, b in zip(edges[::2], edges[1::2], strict=True)
    ]
    return int(hit.sum()), spans


def _shards(benchmark: DataFrame, item_col: str, item_text_col: str, window: int, automaton_chars: int) -> list:
    """Functions that give the broadcast items of one automaton each; one where all items fit it."""
    tests = benchmark.select(
        F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).cast("binary").alias("raw")
    )
    context = benchmark.sparkSession.sparkContext
    total = tests.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    if total <= automaton_chars:
        return [lambda: context.broadcast([(r.item, bytes(r.raw)) for r in tests.collect()])]
    room = max(1, automaton_chars // 4)

    def cut(batches):
        for b in batches:
            pieces = [(i, x) for i, x in enumerate(map(normalise, b.column("raw").to_pylist()))]
            at, texts = [], []
            for i, ws in pieces:
                first = 0
                while first < len(ws):
                    last, size = first, 0
                    while last < len(ws) and (last < first + window or size + len(ws[last]) < room):
                        size += len(ws[last]) + 1
                        last += 1
                    at.append(i)
                    texts.append(b" ".join(ws[first:last]))
                    if last == len(ws):
                        break
                    first = last - window + 1
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(at, pa.int64())), pa.array(texts, pa.binary())], names=["item", "raw"])

    pieces = write_stage(tests.mapInArrow(cut, tests.schema), "benchmark-pieces")
    n = 2 * -(-total // automaton_chars)
    dealt = write_stage(pieces.withColumn("shard", F.pmod(F.xxhash64("raw"), F.lit(n))), "benchmark-shards")

    def held(i: int):
        return lambda: context.broadcast([(r.item, bytes(r.raw)) for r in dealt.where(F.col("shard") == i).collect()])

    return [held(i) for i in range(n)]


def _machine(sent, window: int):
    """The automaton of a broadcast, built once in each worker; only the latest is kept."""
    held = kept_in_worker(("benchmark automaton",), dict)
    if held.get("of") != sent.id:
        held.clear()
        held["machine"], held["of"] = build(sent.value, window), sent.id
    return held["machine"]


class _Sent:
    """A broadcast and its number, which the workers tell automata apart by."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids) and spans (character offsets) of every document."""
    shards = _shards(benchmark, item_col, item_text_col, window, automaton_chars)
    item = benchmark.schema[item_col].dataType
    texts = narrow(docs, id_col, text_col)
    if len(shards) == 1:
        sent = _Sent(shards[0]())

        def make():
            machine = _machine(sent, window)

            def work(texts: list[bytes]) -> list[list]:
                rows = []
                for raw in texts:
                    n, ranges, items = find(machine, raw)
                    n_hit, spans = marked(raw, n, ranges)
                    rows.append((n, n_hit, items, spans))
                return [list(c) for c in zip(*rows, strict=True)]

            return work

        return map_texts(texts, make, _hit_fields(item))
    rows = write_stage(texts.withColumn("row", F.monotonically_increasing_id()), "decontaminate-texts")
    ranged = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
    fields = [T.StructField("ranges", ranged, False), T.StructField("items", T.ArrayType(item), False)]
    found = None
    for shard in shards:
        sent = _Sent(shard())

        def make(sent=sent):
            machine = _machine(sent, window)

            def work(texts: list[bytes]) -> list[list]:
                got = [find(machine, raw)[1:] for raw in texts]
                return [[[{"first": a, "last": b} for a, b in r] for r, _ in got], [i for _, i in got]]

            return work

        hits = write_stage(map_texts(rows, make, fields, carry=["row"]).where(F.size("ranges") > 0), "decontaminate-hits")
        found = hits if found is None else found.unionByName(hits)
    united = found.groupBy("row").agg(
        F.flatten(F.collect_list("ranges")).alias("ranges"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    joined = rows.join(united, "row", "left").select("doc_id", "text", "ranges", F.coalesce("items", F.array().cast(T.ArrayType(item))).alias("items"))
    out = T.StructType([joined.schema["doc_id"], *_hit_fields(item)])

    def spans(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for b in batches:
            n, n_hit, at = [], [], []
            for raw, ranges in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist(), strict=True):
                n.append(len(normalise(raw)))
                hit, own = marked(raw, n[-1], [(r["first"], r["last"]) for r in ranges or ()])
                n_hit.append(hit)
                at.append(own)
            items = [sorted(x) for x in b.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(v, f.type) for v, f in zip((n, n_hit, items, at), list(schema)[1:], strict=True))], schema=schema
            )

    return joined.mapInArrow(spans, out)


def digest(hits: DataFrame) -> DataFrame:
    """The contract's columns: counts, a hash of the sorted item ids and the verdict."""
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, automaton_chars: int = AUTOMATON_CHARS
) -> DataFrame:
    """Documents without a hit, with the columns they came with; scanned in place, no shuffle."""
    tune(docs.sparkSession)
    shards = _shards(benchmark, "item_id", "text", window, automaton_chars)
    for i, shard in enumerate(shards):
        sent = _Sent(shard())

        def run(batches, sent=sent):
            machine = _machine(sent, window)
            for b in batches:
                texts = [x or b"" for x in b.column("text").cast(pa.binary()).to_pylist()]
                yield b.filter(pa.array([not find(machine, x)[1] for x in texts], type=pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if i < len(shards) - 1:
            docs = write_stage(docs, "clean-documents")
    return docs


#: The same in DuckDB: windows of every length that items have, joined as strings.
SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
),
iw AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, array_to_string(ws[i:i + 9], ' ') AS w, least(10, len(ws)) AS n
  FROM iw, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS u(i) WHERE len(ws) > 0
),
places AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM dw, (SELECT DISTINCT n FROM windows) AS s, unnest(range(1, len(ws) - n + 2)) AS u(i)
),
hits AS (SELECT p.doc_id, p.i, p.n, w.item_id FROM places AS p JOIN windows AS w ON p.w = w.w AND p.n = w.n),
marked AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(place) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw AS d LEFT JOIN marked AS m ON d.doc_id = m.doc_id LEFT JOIN found AS f ON d.doc_id = f.doc_id
"""
