"""Token counts by a compiled finite-state transducer.

A byte-level BPE vocabulary with its splitting pattern is compiled into a
deterministic transducer over characters. Each transition is annotated with
the change of the number of emitted tokens, so the count of a text is the sum
over its transitions plus a final amount. States are determinised on demand
and kept, up to a bound, after which the table is built anew. The state map of
a word between two single separators starts and ends in a synchronised state,
so it is one number; these are kept too, up to a bound.

Splitting part (letters, numbers, other, white-space runs whose last character
joins what follows, contractions): a handful of modes.

Merging part: a BPE encoding is characterised by its neighbouring pairs - a
token may follow another exactly if encoding their concatenation gives the two
back. So after each byte there is one valid last token; a state holds, for
every suffix that some token still continues, which token precedes it and how
many tokens had been emitted there. Appending a byte can lower the count
(tokens merge), which is why annotations may be negative.

Long texts are cut into chunks that are counted apart. A chunk's state map
(entry state -> exit state, count) is constant after the chunk's first
synchronising place - a white-space character after another character, where
every entry state meets in one state - so it is kept as (head, count, tail):
``head`` runs from the entry state, ``tail`` names the exit state. Maps compose
associatively; a prefix scan over a document's chunks gives its count.

Edge cases: NULL and empty texts have no tokens; the vocabulary's special
strings inside a text count as one token each, as the library's default does;
texts of any length are read whole.
"""

from __future__ import annotations

import json
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import kept_in_worker, map_texts

#: Texts longer than this many characters are counted in chunks.
CHUNK_CHARS = 32_768
#: States kept before the table is built anew (about 2 kB each).
MAX_STATES = 100_000
#: Word maps kept in each of two generations (about 150 bytes each).
MAX_WORDS = 300_000

#: Suffixes that at most so many tokens continue keep the set of those that may follow, which merges states.
FEW = 64

CONTRACTED = {"s": "", "t": "", "m": "", "d": "", "r": "e", "v": "e", "l": "l"}  # fixed: 's 't 'm 'd 're 've 'll


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, inverted."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, merge ranks, and the pair test that the transducer needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.rank = {}
        for i, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[as_bytes(a), as_bytes(b)] = i
        tokens = {as_bytes(s) for s in spec["model"]["vocab"] if s not in self.special}
        self.tokens = {t for t in tokens if len(t) == 1 or any((t[:i], t[i:]) in self.rank for i in range(1, len(t)))}
        self.open = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.ordered = sorted(self.tokens)
        self.whole: dict[bytes, bool] = {}
        self.spines: dict[bytes, tuple] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.longer: dict[bytes, tuple] = {}
        self.allowed: dict[tuple, object] = {}

    def encode(self, raw: bytes) -> list[bytes]:
        """Merge the lowest-ranked neighbouring pair until none is left."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            pair = (parts[best], parts[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def is_token(self, t: bytes) -> bool:
        """Whether t is a token that its own text is encoded to."""
        if t not in self.tokens:
            return False
        if t not in self.whole:
            self.whole[t] = self.encode(t) == [t]
        return self.whole[t]

    def spine(self, t: bytes) -> tuple[list, list]:
        """The parts of t that touch its right and its left edge, from byte to token, each
        with the rank of the merge that takes it in (none for the token itself)."""
        got = self.spines.get(t)
        if got is None:
            right, left = [], []
            for edge, out in ((-1, right), (0, left)):
                parts, at = [t[i : i + 1] for i in range(len(t))], 0
                while len(parts) > 1:
                    best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
                    at = self.rank[parts[best], parts[best + 1]]
                    if best == (len(parts) - 2 if edge else 0):
                        out.append((parts[edge], at))
                    parts[best : best + 2] = [parts[best] + parts[best + 1]]
                out.append((t, 1 << 60))
            got = self.spines[t] = (right, left)
        return got

    def may_follow(self, u: bytes, t: bytes) -> bool:
        """Whether encoding u + t gives u and t: no merge across the border comes before the
        merges that take in the two parts beside it."""
        got = self.pairs.get((u, t))
        if got is None:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            right, left = self.spine(u)[0], self.spine(t)[1]
            i = j = 0
            while True:
                (a, a_until), (b, b_until) = right[i], left[j]
                r = self.rank.get((a, b))
                if r is not None and r < a_until and r <= b_until:
                    got = False
                    break
                if a_until == b_until == 1 << 60:
                    got = True
                    break
                if a_until <= b_until:
                    i += 1
                else:
                    j += 1
            self.pairs[u, t] = got
        return got

    def continued(self, s: bytes) -> tuple:
        """The tokens that begin with s and are longer, as far as they are few; else ()."""
        got = self.longer.get(s)
        if got is None:
            i, j = bisect_left(self.ordered, s), bisect_left(self.ordered, s + b"\xff" * 8)
            got = tuple(t for t in self.ordered[i:j] if t != s and self.is_token(t)) if j - i <= FEW else ()
            self.longer[s] = got
        return got

    def narrowed(self, before, s: bytes):
        """What has to be known of the token before an open suffix s: None if every token that
        continues s may follow it, the set of those that may if they are few, False if none may."""
        if before is None:
            return None
        got = self.allowed.get((before, s), 0)
        if got == 0:
            if len(self.allowed) > 200_000:
                self.allowed.clear()
            every = self.continued(s)
            if not every:
                got = before
            else:
                fits = frozenset(
                    t for t in every if (t in before if isinstance(before, frozenset) else self.may_follow(before, t))
                )
                got = None if len(fits) == len(every) else fits or False
            self.allowed[before, s] = got
        return got


#: Merging state before any byte: one open suffix (empty), nothing before it.
ORIGIN = ((b"", None, 0),)


def merge_step(voc: Vocabulary, state: tuple, byte: int) -> tuple[tuple, int]:
    """The merging state after one more byte, and the change of the count."""
    c = bytes((byte,))
    last, delta, grown = None, 0, []
    for suffix, before, level in state:
        t = suffix + c
        if last is None and voc.is_token(t):
            if before is None or (t in before if isinstance(before, frozenset) else voc.may_follow(before, t)):
                last, delta = t, level + 1
        if t in voc.open:
            before = voc.narrowed(before, t)
            if before is not False:
                grown.append((t, before, level))
    if last is None:
        raise ValueError(f"no token ends after {c!r}")
    return (*((s, u, n - delta) for s, u, n in grown), (b"", last, 0)), delta


class State(dict):
    """A state of the transducer: character -> (next state, count change), filled on demand."""

    __slots__ = ("key", "table", "_last")

    def __init__(self, table: Transducer, key: tuple):
        self.key, self.table, self._last = key, table, None

    def __missing__(self, ch: str):
        key, delta = self.table.advance(self.key, ch)
        got = self[ch] = (self.table.state(key), delta)
        return got

    def last(self) -> int:
        """Tokens that the end of the text adds."""
        if self._last is None:
            self._last = self.table.ending(self.key)
        return self._last


class WordMaps(dict):
    """word -> tokens emitted between the separator before it and the one after it.

    None for what does not end in the synchronised state: an empty word, or
    one with white space at its ends.
    """

    def __init__(self, table: Transducer, entry: tuple):
        self.table, self.entry, self.older = table, entry, {}

    def __missing__(self, word: str):
        if len(self) > MAX_WORDS:
            self.older = dict(self)  # what is asked for again comes back from here
            self.clear()
        got = self.older.get(word, -1)
        if got == -1:
            got = None
            if word and self.table.kind(word[0]) != "W" and self.table.kind(word[-1]) != "W":
                state, got = self.table.run(self.table.state(self.entry), word)
                got += state[" "][1]
        self[word] = got
        return got


class Transducer:
    """Modes: B begin, L letters, N numbers, P other, A apostrophe, R apostrophe and r/v/l, W white space."""

    def __init__(self, path: str, max_states: int = MAX_STATES):
        import regex

        self.voc, self.max_states = Vocabulary(path), max_states
        self.kinds = [(k, regex.compile(p)) for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("W", r"\s"))]
        self.states: dict[tuple, State] = {}
        self.first, self.spaced, self.lined = (
            WordMaps(self, key) for key in (("B",), ("W", ORIGIN, " "), ("W", ORIGIN, "\n"))
        )

    def state(self, key: tuple) -> State:
        got = self.states.get(key)
        if got is None:
            got = self.states[key] = State(self, key)
        return got

    def kind(self, ch: str) -> str:
        return next((k for k, p in self.kinds if p.match(ch)), "P")

    def feed(self, merging: tuple, text: str) -> tuple[tuple, int]:
        n = 0
        for byte in text.encode("utf-8"):
            merging, d = merge_step(self.voc, merging, byte)
            n += d
        return merging, n

    def begin(self, ch: str) -> tuple[tuple, int]:
        """First character of a piece without a leading space."""
        kind = self.kind(ch)
        if kind == "W":
            return ("W", ORIGIN, ch), 0
        merging, n = self.feed(ORIGIN, ch)
        return ("A" if ch == "'" else kind, merging), n

    def advance(self, key: tuple, ch: str) -> tuple[tuple, int]:
        mode, kind = key[0], self.kind(ch)
        if mode == "B":
            return self.begin(ch)
        if mode == "W":
            _, run, held = key
            if kind == "W":
                run, n = self.feed(run, held)
                return ("W", run, ch), n
            if held == " ":
                merging, n = self.feed(ORIGIN, held + ch)
                return (kind, merging), n
            _, n = self.feed(ORIGIN, held)
            after, m = self.begin(ch)
            return after, n + m
        if mode == "A" and ch in CONTRACTED:
            if CONTRACTED[ch]:
                return ("R", ch), 0
            return ("B",), self.feed(ORIGIN, "'" + ch)[1] - 1
        if mode == "R":
            if ch == CONTRACTED[key[1]]:
                return ("B",), self.feed(ORIGIN, "'" + key[1] + ch)[1] - 1
            after, n = self.begin(key[1])
            after, m = self.advance(after, ch)
            return after, n + m
        if kind == ("P" if mode == "A" else mode):
            merging, n = self.feed(key[1], ch)
            return (kind, merging), n
        return self.begin(ch)

    def ending(self, key: tuple) -> int:
        if key[0] == "W":
            return self.feed(key[1], key[2])[1]
        return self.begin(key[1])[1] if key[0] == "R" else 0

    def run(self, state: State, text: str) -> tuple[State, int]:
        """The state after a text, and the count its transitions emit."""
        if len(self.states) > self.max_states:
            self.states = {}
            state = self.state(state.key)
        n = 0
        for ch in text:
            state, d = state[ch]
            n += d
        return state, n

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        parts = self.parts(text)
        return len(parts) - 1 + sum(map(self.count_part, parts))

    def count_part(self, text: str) -> int:
        """Tokens of a text without special strings: word maps where they apply, steps elsewhere."""
        n, state = 0, None  # None: the state is synchronised by any white space that follows
        words, spaced = self.first, self.spaced.__getitem__
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            if state is None:
                try:
                    n += words[head] + sum(map(spaced, rest))
                    words = self.lined
                    continue
                except TypeError:
                    pass
            if words is self.lined:
                if state is None:
                    state = self.state(("W", ORIGIN, "\n"))
                else:
                    state, d = state["\n"]
                    n += d
            else:
                state, words = self.state(("B",)), self.lined
            state, d = self.run(state, line)
            n += d
            if state.key[0] != "W":
                n += state[" "][1]
                state = None
        return n if state is None else n + state.last()

    def parts(self, text: str) -> list[str]:
        """The text between special strings; each of these is one token."""
        for s in self.voc.special:
            if s in text:
                import re

                return re.split("|".join(map(re.escape, self.voc.special)), text)
        return [text]


# --- chunk state maps -------------------------------------------------------


def chunk_map(machine: Transducer, text: str) -> tuple[str, int, str | None]:
    """(head, count after head, tail): the state map of a chunk without special strings.

    tail is None if no place in the chunk synchronises; head is then the chunk.
    """
    at = _sync(machine, text, 1, 1)
    if at is None:
        return text, 0, None
    back = _sync(machine, text, len(text) - 1, -1)
    _, n = machine.run(machine.state(("W", ORIGIN, text[at])), text[at + 1 :])
    return text[: at + 1], n, text[back:]


def _sync(machine: Transducer, text: str, i: int, step: int) -> int | None:
    while 0 < i < len(text):
        if machine.kind(text[i]) == "W" and machine.kind(text[i - 1]) != "W":
            return i
        i += step
    return None


def compose(machine: Transducer, a: tuple, b: tuple) -> tuple:
    """The state map of two neighbouring chunks (associative)."""
    if a[2] is None:
        if b[2] is None:
            return a[0] + b[0], 0, None
        return a[0] + b[0], b[1], b[2]
    state, _ = machine.run(machine.state(("B",)), a[2])
    state, n = machine.run(state, b[0])
    if b[2] is None:
        return a[0], a[1] + n, a[2] + b[0]
    return a[0], a[1] + n + b[1], b[2]


def prefix_scan(machine: Transducer, maps: list[tuple]) -> list[tuple]:
    """All prefix compositions, by recursive doubling over neighbouring pairs."""
    if len(maps) < 2:
        return maps
    pairs = [compose(machine, maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
    evens = prefix_scan(machine, pairs)
    out = [maps[0]]
    for i in range(1, len(maps)):
        out.append(evens[i // 2] if i % 2 else compose(machine, evens[i // 2 - 1], maps[i]))
    return out


def total(machine: Transducer, maps: list[tuple]) -> tuple:
    """The last of the prefixes alone, by the scan's up-sweep: neighbouring pairs until one map is left.

    Chunks without a place that synchronises keep their text; no level holds it twice.
    """
    while len(maps) > 1:
        pairs = [compose(machine, maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
        maps = pairs + maps[len(pairs) * 2 :]
    return maps[0]


def finish(machine: Transducer, whole: tuple) -> int:
    """The count of a text from the state map of all its chunks."""
    state, n = machine.run(machine.state(("B",)), whole[0])
    n += whole[1]
    if whole[2] is not None:
        state, _ = machine.run(machine.state(("B",)), whole[2])
    return n + state.last()


# --- Spark ------------------------------------------------------------------


def transducer(path: str) -> Transducer:
    """The compiled table of a Python worker, which grows from task to task."""
    return kept_in_worker(("transducer", path), lambda: Transducer(path))


_COUNT = [T.StructField("n_tokens", T.LongType(), False)]
_MAP = [
    T.StructField("head", T.StringType(), False),
    T.StructField("n", T.LongType(), False),
    T.StructField("tail", T.StringType(), True),
]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row. ``tokenizer``: path of a byte-level BPE file.

    Rows up to ``chunk_chars`` are counted where they lie. Longer texts - and
    no others - are cut into chunks, which are dealt out over all tasks, and
    their state maps meet again by row.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body")
    ).withColumn("n_bytes", F.octet_length("body").cast("long"))

    def make():
        machine = transducer(tokenizer)
        return lambda texts: [[machine.count(x.decode("utf-8")) for x in texts]]

    short = base.where(F.length("body") <= chunk_chars).withColumn("text", F.col("body").cast("binary"))
    counted = map_texts(short, make, _COUNT, carry=["doc_id", "n_bytes"])
    return counted.unionByName(_long_counts(base.where(F.length("body") > chunk_chars), tokenizer, chunk_chars))


def _long_counts(base: DataFrame, tokenizer: str, chunk_chars: int) -> DataFrame:
    special = Vocabulary(tokenizer).special
    quoted = "|".join(rf"\Q{s}\E" for s in special)
    # special strings end a part for good: each part is a text of its own
    parts = F.split(F.col("body"), quoted) if special else F.array("body")
    chunks = (
        base.withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "n_bytes", F.posexplode(parts).alias("part", "piece"))
        .select(
            "row", "doc_id", "n_bytes", "part",
            F.posexplode_outer(F.regexp_extract_all("piece", F.lit(rf"(?s).{{1,{chunk_chars}}}"), F.lit(0))).alias("at", "chunk"),
        )
        .withColumn("text", F.coalesce("chunk", F.lit("")).cast("binary"))
        .drop("chunk")
        .repartition(F.col("row"), F.col("part"), F.col("at"))
    )

    def make_maps():
        machine = transducer(tokenizer)
        return lambda texts: [list(c) for c in zip(*(chunk_map(machine, x.decode("utf-8")) for x in texts), strict=True)]

    maps = map_texts(chunks, make_maps, _MAP, carry=["row", "doc_id", "n_bytes", "part", "at"])
    by_part = maps.groupBy("row", "doc_id", "n_bytes", "part").agg(
        F.array_sort(F.collect_list(F.struct("at", "head", "n", "tail"))).alias("text")
    )

    def make_counts():
        machine = transducer(tokenizer)

        def work(rows: list[list[dict]]) -> list[list]:
            out = []
            for r in rows:
                out.append(finish(machine, total(machine, [(m["head"], m["n"], m["tail"]) for m in r])))
            return [out]

        return work

    counts = map_texts(by_part, make_counts, _COUNT, carry=["row", "doc_id", "n_bytes", "part"])
    return counts.groupBy("row", "doc_id", "n_bytes").agg(
        (F.sum("n_tokens") + F.count("part") - 1).alias("n_tokens")
    ).select("doc_id", "n_bytes", "n_tokens")
