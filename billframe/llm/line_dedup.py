"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is its sequence of words. A line is dropped if an earlier line (by
doc_id, then place in the text) is equal, or, where both have ``min_words``
words or more, differs by one word: one replaced, inserted or left out. Lines
without a word are always kept.

1. Equal lines: one aggregation by a 128-bit hash keeps the earliest place of
   every distinct line (partial sums first, so a hot line is one row per task).
2. Filter without loss: one edit leaves either the first or the last half of a
   line as it was. Each distinct line emits hashes of both halves, cut at a
   place that lines of neighbouring lengths share; only lines that share a half
   with another distinct line can have a partner.
3. Deletion neighbourhood of these lines: every variant with one word left out,
   as hashed keys. Keys are sums of word-and-place hashes, so each variant costs
   one step of a running sum. A variant with its place matches the lines that
   differ in the word there; a variant without place matches the shorter line
   that equals it. Within a key all that matters is the earliest line, so a key
   that thousands share yields one link for each and never all pairs.
4. Every link is verified on the words themselves; earliest lines stay.

Bits of fixed number (2 MB) narrow the scans to the rows that can match before
they are shuffled; they are a filter only, joins decide.

Edge cases: NULL and empty texts have no lines; rows that agree in doc_id and
text count as one row and keep the same lines; rows that repeat a doc_id with
other texts are told apart by a hash of the text; NULL ids come last; texts
without line ends are one line, of any length; a document may lose all lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billframe.llm.common import SPACES, row_key, write_stage

MIN_WORDS = 5
#: Bits of a scan filter: 2^23, in 2^17 rows of 64.
FILTER_WORDS = 1 << 17
#: Lengths in words that share a place to cut the halves.
STRIDE = 8
_MOD = 1 << 40


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _words(line: Column) -> Column:
    return F.filter(F.split(line, SPACES), lambda w: w != "")


def _worded(line: Column) -> Column:
    return F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """Hash, place and half keys of every line with a word."""
    rows = docs.select(*(c.alias(n) for n, c in row_key().items()), F.coalesce("text", F.lit("")).alias("text"))
    lines = (
        rows.select("__id", "__text", F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .where(_worded(F.col("line")))
        .select("__id", "__text", "at", _words(F.col("line")).alias("ws"))
    )
    n = F.size("ws")
    return lines.select(
        "__id", "__text", "at",
        F.xxhash64("ws").alias("h1"), F.xxhash64(F.lit(17), "ws").alias("h2"),
        F.when(n >= min_words, _halves(F.col("ws"), n, F.floor(n / STRIDE).cast("int"), min_words)).alias("own"),
        F.when((n >= min_words) & (n % STRIDE == STRIDE - 1), _halves(F.col("ws"), n, F.floor(n / STRIDE).cast("int") + 1, min_words)).alias("next"),
    ).select("__id", "__text", "at", "h1", "h2", "own.p", "own.s", F.col("next.p").alias("p2"), F.col("next.s").alias("s2"))


def _halves(ws: Column, n: Column, grade: Column, min_words: int) -> Column:
    """Hashes of the first and the last words, as many as half the least length of the grade."""
    least = F.greatest(grade * STRIDE, F.lit(min_words))
    first = F.floor(least / 2).cast("int")
    last = least - first
    return F.struct(
        F.xxhash64(F.lit("p"), grade, F.slice(ws, F.lit(1), first)).alias("p"),
        F.xxhash64(F.lit("s"), grade, F.slice(ws, n - last + 1, last)).alias("s"),
    )


def _bits(df: DataFrame, hashed: Column) -> DataFrame:
    """A filter of fixed size over a frame's hashes: word, bits."""
    at = F.pmod(hashed, F.lit(FILTER_WORDS * 64))
    return (
        df.select(F.floor(at / 64).cast("int").alias("word"), (at % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )


def _passing(df: DataFrame, hashed: Column, bits: DataFrame) -> DataFrame:
    """The rows whose hash may be among those of ``bits`` (at most FILTER_WORDS rows)."""
    at = F.pmod(hashed, F.lit(FILTER_WORDS * 64))
    return (
        df.withColumns({"__word": F.floor(at / 64).cast("int"), "__bit": (at % 64).cast("int")})
        .join(F.broadcast(bits.withColumnRenamed("word", "__word")), "__word")
        .where(F.getbit("bits", F.col("__bit")) == 1)
        .drop("__word", "__bit", "bits")
    )


def first_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Hashes, half keys and earliest place (__id, __text, at) of every distinct line."""
    found = _lines(docs, min_words).groupBy("h1", "h2").agg(
        F.min(F.struct("__id", "__text", "at")).alias("o"), *(F.max(k).alias(k) for k in ("p", "s", "p2", "s2"))
    )
    return found.select("h1", "h2", "o.__id", "o.__text", "o.at", "p", "s", "p2", "s2")


def _similar(firsts: DataFrame) -> DataFrame:
    """The distinct lines that share a half with another."""
    keys = firsts.where("p IS NOT NULL").select(
        F.explode(F.filter(F.array("p", "s", "p2", "s2"), lambda k: k.isNotNull())).alias("key"), "h1"
    )
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    some = write_stage(keys.join(shared, "key", "left_semi").select("h1").distinct(), "line-candidates")
    places = firsts.select("h1", "h2", "__id", "__text", "at")
    return _passing(places, F.col("h1"), _bits(some, F.col("h1"))).join(some, "h1", "left_semi")


def _with_words(docs: DataFrame, similar: DataFrame) -> DataFrame:
    """__id, __text, at, words of these lines, from the texts that hold them."""
    key = F.xxhash64("__id", "__text")
    rows = docs.select(*(c.alias(n) for n, c in row_key().items()), "text")
    some = _passing(rows, key, _bits(similar, key)).dropDuplicates(["__id", "__text"])
    wanted = similar.groupBy("__id", "__text").agg(F.collect_list("at").alias("ats"))
    picked = _let(
        F.split("text", "\n"),
        lambda ls: F.transform("ats", lambda a: F.struct(a.alias("at"), _words(F.get(ls, a)).alias("words"))),
    )
    return (
        some.join(wanted, ["__id", "__text"])
        .select("__id", "__text", F.explode(picked).alias("x"))
        .select("__id", "__text", "x.at", "x.words")
    )


def _variants(lines: DataFrame) -> DataFrame:
    """place, ka, kb, whole, o: one key for each variant and one for the line itself.

    ``place`` is the word left out, for lines that have another word there; -1
    for keys that match a shorter line as it is. ``cut`` is the word left out.
    """
    g = lambda salt, w, i: F.pmod(F.xxhash64(F.lit(salt), w, i), F.lit(_MOD))
    summed = lambda salt, back: F.aggregate(
        F.transform("words", lambda w, i: g(salt, w, i - back)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    o = F.struct("__id", "__text", "at")
    total = lines.select(
        o.alias("o"), "words", *(summed(s, b).alias(f"t{s}{b}") for s in (1, 2) for b in (0, 1))
    )
    # by line, the words in order: running sums give every variant in one step
    word = total.select("o", "t10", "t11", "t20", "t21", F.posexplode("words").alias("i", "w"))
    run = Window.partitionBy("o").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = word.select(
        "o", "i", "t10", "t11", "t20", "t21",
        *(g(s, F.col("w"), F.col("i") - b).alias(f"g{s}{b}") for s in (1, 2) for b in (0, 1)),
    ).withColumns({f"r{s}{b}": F.sum(f"g{s}{b}").over(run) for s in (1, 2) for b in (0, 1)})
    replaced = [F.col(f"t{s}0") - F.col(f"g{s}0") for s in (1, 2)]
    left_out = [F.col(f"r{s}0") - F.col(f"g{s}0") + F.col(f"t{s}1") - F.col(f"r{s}1") for s in (1, 2)]
    key = lambda place, cut, ks, whole: F.struct(
        place.alias("place"), cut.alias("cut"), ks[0].alias("ka"), ks[1].alias("kb"), F.lit(whole).alias("whole")
    )
    none = F.lit(-1)
    cuts = sums.select(
        "o", F.explode(F.array(key(F.col("i"), F.col("i"), replaced, False), key(none, F.col("i"), left_out, False))).alias("k")
    )
    selves = total.select("o", key(none, none, [F.col("t10"), F.col("t20")], True).alias("k"))
    return cuts.unionByName(selves).select("o", "k.*")


def _links(variants: DataFrame) -> DataFrame:
    """later, earlier, place, cut: for every line and key the earliest line that the key links it to."""
    keys = ["place", "ka", "kb"]
    mine = F.struct("o", "cut")
    met = (
        variants.groupBy(*keys)
        .agg(
            F.min(F.when(~F.col("whole"), mine)).alias("cuts"),
            F.min(F.when(F.col("whole"), mine)).alias("wholes"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1 AND (place >= 0 OR (cuts IS NOT NULL AND wholes IS NOT NULL))")
        .drop("n")
    )
    # most variants meet no other line: only those that may are shuffled again
    met = write_stage(met, "line-keys")
    hashed = F.xxhash64(*keys)
    partner = F.when((F.col("place") >= 0) | F.col("whole"), F.col("cuts")).otherwise(F.col("wholes"))
    return (
        _passing(variants, hashed, _bits(met, hashed))
        .join(met, keys)
        .select("o", "place", "cut", partner.alias("to"))
        .where("to.o < o")
        .select(
            F.col("o").alias("later"), F.col("to.o").alias("earlier"), "place",
            F.greatest("cut", "to.cut").alias("cut"),
        )
        .distinct()
    )


def one_word_apart(a: Column, b: Column, place: Column, cut: Column) -> Column:
    """Whether two word sequences are equal but for the word at ``cut``: replaced there
    (place >= 0), or present in the longer one only."""
    head = F.slice(a, F.lit(1), cut) == F.slice(b, F.lit(1), cut)
    rest = lambda x, k: F.slice(x, k + 1, F.size(x))
    replaced = (F.size(a) == F.size(b)) & head & (rest(a, cut + 1) == rest(b, cut + 1))
    inserted = lambda x, y: (F.size(x) == F.size(y) + 1) & head & (rest(x, cut + 1) == rest(y, cut))
    return F.when(place >= 0, replaced).otherwise(inserted(a, b) | inserted(b, a))


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """__id, __text, at of the distinct lines that an earlier line is one word apart from."""
    lines = write_stage(_with_words(docs, _similar(firsts)), "line-words")
    links = _links(_variants(lines))
    o = F.struct("__id", "__text", "at")
    words = lines.select(o.alias("of"), "words")
    checked = (
        links.join(words.select(F.col("of").alias("later"), F.col("words").alias("a")), "later")
        .join(words.select(F.col("of").alias("earlier"), F.col("words").alias("b")), "earlier")
        .where(one_word_apart(F.col("a"), F.col("b"), F.col("place"), F.col("cut")))
    )
    return checked.select("later.*").distinct()


def kept_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """__id, __text, kept, near: for every text with lines of its own, the sorted numbers of the
    lines it keeps, and of those dropped for being one word apart from an earlier line."""
    firsts = write_stage(first_lines(docs, min_words), "first-lines")
    own = firsts.select("__id", "__text", "at", F.lit(False).alias("near"))
    near = near_lines(docs, firsts).withColumn("near", F.lit(True))
    both = own.unionByName(near).groupBy("__id", "__text").agg(
        F.collect_list(F.when(~F.col("near"), F.col("at"))).alias("first"),
        F.collect_list(F.when(F.col("near"), F.col("at"))).alias("near"),
    )
    return both.select(
        "__id", "__text", F.sort_array(F.array_except("first", "near")).alias("kept"), F.sort_array("near").alias("near")
    )


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines (with a word), n_kept, n_near and dropped (their numbers from 0) of every row."""
    worded = F.filter(
        F.transform(
            F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.when(_worded(x), i)
        ),
        lambda i: i.isNotNull(),
    )
    rows = docs.select("doc_id", *(c.alias(n) for n, c in row_key().items()), worded.alias("lines"))
    return rows.join(kept_lines(docs, min_words), ["__id", "__text"], "left").select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("kept"), F.lit(0)).cast("long").alias("n_kept"),
        F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.array_except("lines", "kept"), F.col("lines")).alias("dropped"),
    )


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their kept lines only, in the columns they came with.

    A document that had lines and loses all of them goes; one without lines
    stays as it is. n_chars, if it is a column, follows the new text.
    """
    keyed = docs.withColumns(row_key())
    joined = keyed.join(kept_lines(docs, min_words), ["__id", "__text"], "left")
    # one byte for each line, so that a line's fate is read in one step
    marks = lambda kept: F.encode(
        F.array_join(
            F.transform(
                kept,
                lambda a, j: F.concat(F.repeat(F.lit("0"), a - F.coalesce(F.get(kept, j - 1), F.lit(-1)) - 1), F.lit("1")),
            ),
            "",
        ),
        "US-ASCII",
    )
    some = F.coalesce("kept", F.array().cast("array<int>"))
    rebuilt = _let(
        marks(some),
        lambda m: F.array_join(
            F.filter(
                F.split("text", "\n"),
                lambda x, i: ~_worded(x) | (F.substring(m, i + 1, F.lit(1)) == F.lit(b"1")),
            ),
            "\n",
        ),
    )
    has_lines = _worded(F.coalesce("text", F.lit("")))
    out = joined.where(~has_lines | (F.size(some) > 0)).withColumn("text", F.when(F.col("text").isNotNull(), rebuilt))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


#: The same in DuckDB, on strings instead of hashes.
SQL = rf"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line_no,
    list_filter(regexp_split_to_array(ls[i], '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {{documents}}), unnest(range(1, len(ls) + 1)) AS u(i)
),
worded AS (SELECT doc_id, line_no, ws, row_number() OVER (ORDER BY doc_id, line_no) AS o FROM lines WHERE len(ws) > 0),
firsts AS (SELECT array_to_string(ws, ' ') AS line, min(o) AS o, any_value(ws) AS ws FROM worded GROUP BY 1),
variants AS (
  SELECT o, CAST(i AS BIGINT) AS place, false AS self, array_to_string(list_concat(ws[1:i-1], ws[i+1:]), ' ') AS v
  FROM firsts, unnest(range(1, len(ws) + 1)) AS u(i) WHERE len(ws) >= {MIN_WORDS}
),
replaced AS (
  SELECT o, min(o) OVER (PARTITION BY place, v) AS earliest FROM variants
),
inserted AS (
  SELECT a.o AS shorter, b.o AS longer FROM firsts AS a JOIN variants AS b ON a.line = b.v AND len(a.ws) >= {MIN_WORDS}
),
near AS (
  SELECT o FROM replaced WHERE earliest < o
  UNION SELECT longer FROM inserted WHERE shorter < longer
  UNION SELECT shorter FROM inserted WHERE longer < shorter
),
judged AS (
  SELECT w.doc_id, w.line_no, w.o NOT IN (SELECT o FROM firsts) AS again, w.o IN (SELECT o FROM near) AS near FROM worded AS w
)
SELECT d.doc_id, count(j.line_no) AS n_lines, count(j.line_no) FILTER (NOT again AND NOT near) AS n_kept,
  count(j.line_no) FILTER (near) AS n_near,
  coalesce(string_agg(CAST(j.line_no AS VARCHAR), ',' ORDER BY j.line_no) FILTER (again OR near), '') AS dropped
FROM {{documents}} AS d LEFT JOIN judged AS j ON d.doc_id = j.doc_id GROUP BY d.doc_id
"""
