"""Near-duplicate groups against all pairs compared in plain Python."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from trackmill.llm import near_dedup
from trackmill.llm.components import follow
from trackmill.llm.near_dedup import Settings
from trackmill.llm.work import Scratch

SCHEMA = "doc_id bigint, text string, cls string, digest string, key int"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k):
    words = words_of(text)
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def expected(rows, k, percent=80):
    sets = [shingles(text, k) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
            root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return out


def corpus(seed, n_bases=12, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n_bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 8))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


def frame(spark, rows):
    # the other columns have names that the operator uses itself
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


def found(df, settings):
    rows = near_dedup.near_duplicates(df, settings).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_groups(spark, k):
    rows = corpus(k)
    assert found(frame(spark, rows), Settings(words=k)) == sorted(expected(rows, k), key=str)


def test_groups_in_blocks(spark):
    rows = corpus(9, n_bases=3, copies=30)
    plain, cut = (found(frame(spark, rows), Settings(words=2, block=n)) for n in (1000, 4))
    assert plain == cut == sorted(expected(rows, 2), key=str)


def test_odd_rows(spark):
    long = " ".join(f"l{i}" for i in range(20_000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "One"), (3, "one"), (9, "A b"), (2, "a  B"), (2, "a b"), (None, "a b"), (None, "alone here"), (1, long), (4, long + " end")]
    assert found(frame(spark, rows), Settings(words=2)) == sorted(expected(rows, 2), key=str)


def test_no_rows(spark):
    assert found(frame(spark, []), Settings()) == []
    assert near_dedup.first_of_groups(frame(spark, [])).collect() == []


def test_one_of_each_group_stays(spark):
    rows = [*corpus(4), (900, None), (901, ""), (902, None)]
    df = frame(spark, rows)
    kept = near_dedup.first_of_groups(df, Settings(words=2))
    assert kept.columns == df.columns
    firsts = {c if c is not None else i for i, n, c in expected(rows, 2) if n} | {900, 901, 902}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(firsts)


def test_repeated_rows_count_once(spark):
    kept = near_dedup.first_of_groups(frame(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c"), (1, "x y z")]), Settings(words=2))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b c"), (1, "x y z")]


def test_every_near_signature_shares_a_key():
    settings, rng = Settings(), random.Random(1)
    kept = settings.left_out()
    for _ in range(300):
        one = [rng.randrange(1 << 16) for _ in range(settings.positions)]
        other = list(one)
        for p in rng.sample(range(settings.positions), settings.distance):
            other[p] ^= 1
        assert any(all(one[p] == other[p] for p in key) for key in kept)


def test_chunks_too_short():
    with pytest.raises(ValueError):
        Settings(positions=8, chunks=8, distance=8).left_out()


def chains(rng, lengths, settings):
    """Signatures of chains in which only neighbours are near."""
    signs = []
    for length in lengths:
        sign = np.array([rng.randrange(1 << 16) for _ in range(settings.positions)], np.uint16)
        for i in range(length):
            signs.append(sign.copy())
            sign[np.arange(20 * i, 20 * i + 20) % settings.positions] = [rng.randrange(1 << 16) for _ in range(20)]
    rng.shuffle(signs)
    return signs


@pytest.mark.parametrize("full", [3, 7, 1000])
def test_chains_that_pivots_do_not_connect(spark, full):
    """Two groups, with chains, lone rows and a tight cluster: the components are those of all pairs."""
    settings, rng = Settings(), random.Random(full)
    signs = chains(rng, [25, 12, 1, 1, 1, 2], settings)
    tight = signs[0]
    for _ in range(20):
        near = tight.copy()
        near[rng.randrange(settings.positions)] ^= 1
        signs.append(near)
    groups = {1: range(len(signs)), 2: [i for i in range(len(signs)) if i % 3 == 0]}
    rows = [(g, len(own), 1, i, bytearray(signs[i].tobytes())) for g, own in groups.items() for i in own]
    df = spark.createDataFrame(rows, "grp bigint, total bigint, size int, cls bigint, signature binary")
    links, steps = near_dedup.connected(Scratch(spark, "test"), df, full, near_dedup.near_signatures(settings))
    comps = spark.createDataFrame([(i, i) for i in range(len(signs))], "cls bigint, comp bigint")
    for step in steps:
        comps = follow(comps, step, "comp")
    least = list(range(len(signs)))
    for _ in signs:
        for i, j in combinations(range(len(signs)), 2):
            if (signs[i] != signs[j]).sum() <= settings.distance:
                least[i] = least[j] = min(least[i], least[j])
    assert sorted(map(tuple, comps.collect())) == list(enumerate(least))
    found = [tuple(r) for r in links.collect()]
    assert all((signs[a] != signs[b]).sum() <= settings.distance for a, b in found)


def test_a_tight_group_is_not_compared_by_pairs_of_blocks(spark, monkeypatch):
    """What pivots connect is compared once, in its block, whatever the number of blocks."""
    settings, rng, dealt = Settings(), random.Random(3), []
    base = chains(rng, [1], settings)[0]
    rows = []
    for i in range(200):
        near = base.copy()
        near[i % settings.positions] ^= 1 + i
        rows.append((1, 200, 1, i, bytearray(near.tobytes())))
    df = spark.createDataFrame(rows, "grp bigint, total bigint, size int, cls bigint, signature binary")
    plain = near_dedup._links
    monkeypatch.setattr(near_dedup, "_links", lambda rows, make: dealt.append(rows.count()) or plain(rows, make))
    links, _ = near_dedup.connected(Scratch(spark, "test"), df, 10, near_dedup.near_signatures(settings))
    assert len(dealt) == 1 and dealt[0] <= 200 + 20 * near_dedup.PIVOTS
    assert links.count() >= 199
