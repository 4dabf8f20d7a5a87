"""One unbroken word of very many characters costs time and memory in proportion to it."""

import random
import time

import numpy as np
import tokenizers

from billframe.llm import lm_lattice, token_count
from billframe.llm.queries import tokenizer_file

SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789+/"


def lattice():
    pieces, p = lm_lattice.vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return pieces, lm_lattice.Lattice(pieces, np.log(p))


def test_expected_pieces_cover_a_long_word(monkeypatch):
    pieces, held = lattice()
    rng = random.Random(1)

    def covered(word):
        counts = [0.0] * len(pieces)
        held.expect(word, 2.0, counts)
        return sum(x * len(pieces[i]) for i, x in enumerate(counts) if x and not pieces[i].startswith("<0x")), np.array(counts)

    for n in (1, 30, 3000):  # scaled several times in the last
        word = "".join(rng.choice(SIGNS) for _ in range(n))
        total, kept = covered(word)
        assert abs(total - 2 * (n + 1)) < 1e-6 * n
        monkeypatch.setattr(lm_lattice, "KEPT_ARCS", 0)
        assert np.allclose(covered(word)[1], kept, rtol=1e-9, atol=1e-12)
        monkeypatch.undo()
    start = time.time()
    total, _ = covered("".join(rng.choice(SIGNS) for _ in range(1_000_000)))
    assert abs(total - 2 * 1_000_001) < 10 and time.time() - start < 60


def test_expectations_equal_sums_over_segmentations():
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "aba"] + [f"<0x{b:02X}>" for b in range(256)]
    probs = np.array([0.1, 0.2, 0.15, 0.1, 0.1, 0.2, 0.15] + [1e-6] * 256)
    small = lm_lattice.Lattice(pieces, np.log(probs))

    def segmentations(text):
        if not text:
            yield ()
        for i, p in enumerate(pieces[:7]):
            if text.startswith(p):
                for rest in segmentations(text[len(p) :]):
                    yield (i, *rest)

    for word in ("a", "abab", "babaab", "ababababab"):
        found = [(s, np.prod(probs[list(s)])) for s in segmentations("▁" + word)]
        whole = sum(p for _, p in found)
        expected = [sum(p * s.count(i) for s, p in found) / whole for i in range(7)]
        counts = [0.0] * len(pieces)
        small.expect(word, 1.0, counts)
        assert np.allclose(counts[:7], expected)


def test_tokens_of_a_long_word_without_a_synchronising_place():
    path = tokenizer_file("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    machine = token_count.Transducer(path)
    rng = random.Random(2)
    text = "".join(rng.choice(SIGNS) for _ in range(150_000))
    maps = [token_count.chunk_map(machine, text[i : i + 4096]) for i in range(0, len(text), 4096)]
    whole = token_count.total(machine, maps)
    assert len(whole[0]) + len(whole[2] or "") <= len(text)
    assert token_count.finish(machine, whole) == len(library.encode(text, add_special_tokens=False).ids)


def test_the_last_prefix_is_the_total():
    machine = token_count.Transducer(tokenizer_file("byte_bpe_50k.json"))
    text = "Some words, 12 of them;  and unbroken" + "x" * 300 + " text\n\n again" * 30
    for size in (5, 17, 64):
        maps = [token_count.chunk_map(machine, text[i : i + size]) for i in range(0, len(text), size)]
        assert token_count.finish(machine, token_count.total(machine, maps)) == token_count.finish(machine, token_count.prefix_scan(machine, maps)[-1])
