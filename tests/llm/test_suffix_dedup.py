"""Suffix dedup against plain Python, and its parts."""

import hashlib
import random

import numpy as np
import pytest

from trackmill.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string"


def plain_cleaned(rows, length=50):
    last = 2**63
    least = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            least[key] = min(least.get(key, last), last if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if least[data[i : i + length]] < (last if doc_id is None else doc_id):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = "alpha beta gamma delta été ñandú 日本語 x yy zzz of the and".split()
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    passages = [prose(20), prose(9), "The same line in every text, over and over again, it says. " * 2, "ab" * 40, "-" * 120, "x" * 49, "y" * 50]
    docs = []
    for i in range(160):
        parts = [prose(rng.randint(0, 30)) for _ in range(3)]
        parts[1:1] = [rng.choice(passages)] * rng.randint(0, 2)
        docs.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    for i in range(160, 200):  # near copies
        text = list(docs[rng.randint(0, 159)][1])
        for _ in range(rng.randint(0, 4)):
            if text:
                text[rng.randrange(len(text))] = rng.choice("!?\x00é")
        docs.append((i, "".join(text)))
    docs += [(200, None), (201, ""), (202, "short"), (203, passages[0]), (None, passages[0] + "tail"), (None, passages[0]), (5, docs[5][1]), (5, "changed " + docs[5][1])]
    docs += [(-4, docs[7][1]), (204, docs[8][1] * 20), (205, docs[9][1]), (206, docs[9][1]), (207, "a" * 5000), (208, "a" * 300 + "b" * 300)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(
    "settings",
    [sd.Settings(), sd.Settings(run_bytes=3000, owners=3), sd.Settings(run_bytes=2000, crowd=3, owners=5), sd.Settings(length=30, gram=11, run_bytes=5000, crowd=20)],
)
def test_cleaned(spark, rows, settings):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS run", "2 AS kind").repartition(3)
    found = sd.cleaned(docs, settings).collect()
    assert sorted(map(tuple, found), key=str) == plain_cleaned(rows, settings.length)


def test_text_and_no_rows(spark):
    text = "A passage that is long enough to be found in two of the texts."
    docs = spark.createDataFrame([(1, text), (2, "Head. " + text + " Tail é.")], SCHEMA)
    assert {r.doc_id: r.text for r in sd.cleaned(docs, with_text=True).collect()} == {1: text, 2: "Head.  Tail é."}
    assert sd.cleaned(docs.limit(0)).collect() == []


def test_every_string_has_an_anchor():
    rng = np.random.default_rng(1)
    settings = sd.Settings(length=20, gram=7)
    lengths = [300, 19, 0, 20, 700, 5]
    text = rng.integers(97, 100, sum(lengths)).astype(np.uint8).tobytes()
    run = sd.Run(list(range(6)), lengths, text, settings)
    places = set(run.places.tolist())
    for first, last in zip(run.first, run.last, strict=True):
        for i in range(first, last - 19):
            assert places & set(range(i, i + 14))


def test_merge_keeps_prefixes():
    rng = random.Random(3)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(rng.randint(0, 60))}) for _ in range(7)]
    coded = [sd.front_coded(np.array([list(s) for s in r], np.uint8).reshape(-1, 9)) for r in runs]
    out = list(zip(*sd.merged([(c[0], sd.decoded(*c, 9)) for c in coded], 9), strict=True))
    assert [s for _, _, s in out] == sorted(s for r in runs for s in r)
    for (prefix, _, x), (_, _, before) in zip(out[1:], out, strict=False):
        common = next((i for i in range(9) if x[i] != before[i]), 9)
        assert prefix == common
    assert [[s for _, r, s in out if r == i] for i in range(7)] == runs


def test_packed():
    values = np.unique(np.random.default_rng(2).integers(0, 2**56, 500).astype(np.uint64))
    for part in (values, values[:1], values[:2]):
        assert (sd.unpacked(*sd.packed(part), len(part)) == part).all()


def test_long_text_in_one_run():
    """A text of 30 MB: its anchors are found in pieces."""
    text = np.random.default_rng(3).integers(97, 123, 30_000_000).astype(np.uint8).tobytes()
    run = sd.Run([1], [len(text)], text, sd.Settings())
    assert len(text) / 20 < len(run.places) < len(text) / 10
    assert np.diff(run.places).max() <= 27
