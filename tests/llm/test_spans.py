"""Word arrays of texts longer than a piece, and of one text of 50 MB."""

import random
import re
import tracemalloc

import numpy as np
import pytest

from trackmill.llm import counts, decontaminate, near_dedup, quality_qda, spans
from trackmill.llm.spans import LETTERS, PIECE, SPACED, Words, span_hashes


def plain_hash(data):
    value = 0
    for byte in reversed(data):
        value = (value * int(spans.BASE) + byte + 1) % 2**64
    return int(spans.mix(np.array([value], np.uint64))[0])


@pytest.mark.parametrize("seed", range(3))
def test_hashes_over_pieces(seed):
    rng = random.Random(seed)
    data, first, last = bytearray(), [], []
    for size in [1, 7, PIECE - 20, 3, PIECE, 2 * PIECE + 5, 1, PIECE - 1, 2] + [rng.randint(1, 90) for _ in range(50)]:
        data += b" " * rng.randint(0, 3)
        first.append(len(data))
        data += rng.randbytes(size)
        last.append(len(data))
    found = span_hashes(np.frombuffer(bytes(data), np.uint8), np.array(first), np.array(last))
    assert found.tolist() == [plain_hash(data[a:b]) for a, b in zip(first, last, strict=True)]


def test_hashes_of_nothing():
    none = np.empty(0, np.int64)
    assert len(span_hashes(np.empty(0, np.uint8), none, none)) == 0
    assert len(span_hashes(np.zeros(5, np.uint8), none, none)) == 0


def test_words_over_pieces():
    rng = random.Random(1)
    texts = ["é" * 50, "", "  ", "word " * 100_000, "x" * (PIECE + 9), " ".join(rng.choice("ab AB ÀB c\n".split(" ")) for _ in range(200_000)), "end"]
    raw = [t.encode() for t in texts]
    words = Words(raw, SPACED)
    joined = b"\n".join(raw) + b"\n"
    lower = joined.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
    cut = [lower[a:b] for a, b in zip(words.first.tolist(), words.last.tolist(), strict=True)]
    assert cut == re.findall(rb"[^\x20\x09-\x0D]+", lower)
    hashes = {}
    for word, value in zip(cut, words.hash.tolist(), strict=True):
        assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)
    assert np.diff(words.bounds).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]


def test_totals_over_pieces():
    rng = np.random.default_rng(5)
    flags = rng.random(3 * PIECE + 17) < 0.3
    edges = np.sort(np.concatenate(([0, 0, PIECE, PIECE, 2 * PIECE - 1, len(flags), len(flags)], rng.integers(0, len(flags), 500))))
    assert counts.totals(flags, edges).tolist() == [int(flags[a:b].sum()) for a, b in zip(edges, edges[1:])]
    assert counts.totals(np.empty(0, bool), np.array([0, 0, 0])).tolist() == [0, 0]


def test_text_of_50_megabytes():
    """A few arrays of words and single bytes, no array of eight bytes for each byte of text."""
    n = 7_000_000
    text = " ".join(map(str, range(n))).encode()
    assert len(text) > 50_000_000

    def of(work, most):
        tracemalloc.start()
        made = work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * len(text)
        return made

    found = of(lambda: counts.count([text]), 18)
    assert {k: v.tolist() for k, v in found.items()} == {
        "n_words": [n],
        "word_chars": [len(text) - n + 1],
        "n_symbols": [0],
        "n_dup_lines": [0],
        "n_repeat_words": [0],
        "n_lines": [1],
    }
    values, bounds = of(lambda: near_dedup.shingle_sets([text], 5), 18)
    assert bounds.tolist() == [0, n - 4] and len(values) == n - 4
    prints, at = of(lambda: decontaminate.winnow(Words([text], LETTERS), 10, 5, 6), 18)
    assert at[0] <= 5 and n - 10 <= at[-1] and np.diff(at).max() <= 6 and len(prints) == len(at)
    assert of(lambda: quality_qda.statistics([text]), 18).shape == (1, quality_qda.DIM)
