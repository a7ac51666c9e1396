"""The manifest against whole trees built in plain Python."""

import hashlib
import random
import zlib

import pytest

from trackmill.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def plain_hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    return plain_hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def plain_levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([plain_hash("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for rows_of in by_source.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[4])))
    trees = {s: plain_levels([plain_leaf(r, r[4]) for r in by_source[s]]) for s in order}
    top, out = plain_levels([trees[s][-1][0] for s in order]), []
    for spot, source in enumerate(order):
        for place, row in enumerate(by_source[source]):
            folded = leaf = plain_leaf(row, row[4])
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                folded = plain_leaf(row, row[4].replace("\n", ""))
            proof = ""
            for tree, at in ((trees[source], place), (top, spot)):
                for level in tree[:-1]:
                    first = at // 3 * 3
                    run = level[first : first + 3]
                    proof += "".join(h for i, h in enumerate(run, first) if i != at)
                    folded = plain_hash("".join(folded if i == at else h for i, h in enumerate(run, first)))
                    at //= 3
            root = top[-1][0]
            out.append((row[0], leaf, trees[source][-1][0], root, plain_hash(proof), folded, folded == root))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    texts = [None, "", "x\ny", "text\n\nmore", "é\n", "plain", "long\n" * 2000]
    sources = [None, "", "a", "b", "a", "a", "zz", "é"]
    made = [(i, rng.choice(sources), rng.choice([None, "en"]), rng.choice([None, 5, 12]), rng.choice(texts)) for i in range(300)]
    return [*made, made[3], made[3], (None, "a", "en", 1, "q\n"), (7, "alone", "x", 1, "a\nb")]


@pytest.mark.parametrize("settings", [merkle.Settings(), merkle.Settings(levels=2, blocks=2), merkle.Settings(levels=1, blocks=3, max_rows=40)])
def test_manifest(spark, rows, settings):
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), settings).collect()
    assert sorted(map(tuple, found), key=str) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_small(spark, n):
    rows = [(i, f"s{i % 2}", None, None, "a\nb") for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS tree", "2 AS part", "3 AS hash")
    expected = plain_manifest(rows) if rows else []
    assert sorted(map(tuple, merkle.manifest(docs).collect()), key=str) == expected


def test_missing_is_least():
    counts = merkle.sizes(100)
    assert counts == [100, 34, 12, 4, 2, 1]
    assert merkle.missing(range(100), 0, counts) == []
    for known in ([0], [5, 6], [50], list(range(10, 40))):
        nodes = {(0, i): str(i) for i in range(100)}
        root = merkle.derive(dict(nodes), range(100), 0, counts)
        whole = dict(nodes)
        merkle.derive(whole, range(100), 0, counts)
        asked = merkle.missing(known, 0, counts)
        held = {(0, i): str(i) for i in known} | {c: whole[c] for c in asked}
        assert merkle.derive(dict(held), known, 0, counts) == root
        for left_out in asked:
            short = {c: h for c, h in held.items() if c != left_out}
            with pytest.raises(KeyError):
                merkle.derive(short, known, 0, counts)
