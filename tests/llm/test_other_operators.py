"""Archives, main text, mixes, chat windows and components against plain Python."""

import time
import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmill.llm import chat, components, html_blocks, mixing, warc
from trackmill.llm.work import Scratch

PAGES = "page_id bigint, url string, html string, archive string, place int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES)


def expected_records(rows):
    firsts = {}
    for i, _, h in rows:
        firsts.setdefault(h or "", []).append(i)
    out = []
    for h, ids in firsts.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        payload = h.encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out += [(i, len(payload), digest, "revisit" if n else "response", ids[0] if n else None) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def test_archives(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", rng.choice(["<p>a</p>", "", "é\r\n\r\nWARC/1.1\r\n\r\n", "x" * 5000])) for i in range(60)]
    rows += [(None, None, "<p>a</p>"), (70, "http://a b\r\nc", None), (71, "u", "big " * 100_000), (3, "again", rows[3][2]), (72, "u", "alone")]
    df = pages_of(spark, rows).repartition(3)
    made = warc.archived(df, warc.Settings(archive_bytes=20_000, piece=1000))
    assert sorted((tuple(r) for r in made.collect()), key=str) == expected_records(rows)
    assert warc.archived(pages_of(spark, [])).collect() == []


def test_small_payloads_are_never_revisits(spark):
    made = warc.archived(pages_of(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), warc.Settings(least_bytes=3))
    assert {r.page_id: r.record_type for r in made.collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_members_stand_alone(spark, tmp_path):
    settings, raw, members = warc.Settings(), f"file://{tmp_path}/raw", f"file://{tmp_path}/members"
    rows = [(i, "u", f"page {i}") for i in range(5)]
    listing = warc.write_monolithic(pages_of(spark, rows).coalesce(1), raw, settings)
    name = listing.select("archive").distinct().collect()[0].archive
    work = spark.createDataFrame([(name, [2], ["urn:x-page:0:0-0-0"])], "archive string, places array<bigint>, targets array<string>")
    index = sorted((r.offset, r.length) for r in warc.normalise(work, raw, members, settings).collect())
    content = (tmp_path / "members" / name).read_bytes()
    assert [a for a, _ in index] == [0, *np.cumsum([n for _, n in index])[:-1]] and sum(n for _, n in index) == len(content)
    third = zlib.decompress(content[index[2][0] : sum(index[2])], 31)
    assert b"WARC-Type: revisit" in third and b"page 2" not in third and b"Content-Length: 6" in third
    with (tmp_path / "members" / name).open("rb") as file:
        assert [f["warc-type"] for _, f, _ in warc.records(file, 10)] == ["response"] * 2 + ["revisit"] + ["response"] * 2
    assert len((tmp_path / "members" / f"{name}.index.jsonl").read_text().splitlines()) == 5
    (tmp_path / "cut.gz").write_bytes(content[:-20])
    with (tmp_path / "cut.gz").open("rb") as file, pytest.raises(ValueError):
        list(warc.records(file, 10))


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/">Home</a><li>b</ul></nav>
    <!-- no <p>this</p> --><div class="Ad big">buy <b>now</div><article><h1>A &amp; B</h1><p><b>One<br>two <i>x</i><p>thr&eacute;e&nbsp;
    four<script>var t="</p>";</script></p>tail<table><tr><td>c1<td>c2</table><textarea><p>no</p></textarea></article><p title="a>b">q</p>5 < 6 <"""
    found = html_blocks.blocks(page)
    assert [t for t, _, _ in found] == ["Home", "b", "buy now", "A & B", "One two x", "thrée four", "tail", "c1", "c2", "q", "5 < 6 <"]
    assert found[0][2] == 1 and ".ad" in found[2][1] and "article" in found[5][1] and "article" not in found[9][1]
    assert html_blocks.blocks("") == [] and html_blocks.blocks("<p>\n</p>") == []
    assert len(html_blocks.blocks("<p>a</p>" * 20_000)) == 20_000


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<p>in</p><a href=http://example.com/images/photo.jpg class=link", ["in"]),
        ("<p>in</p><img src=http://example.com/images/photo.jpg alt=women's>after", ["in", "after"]),
        ("<article><img alt=women's><p>It lost: isn't it? Yes</p></article>", ["It lost: isn't it? Yes"]),
        ('<p title="never closed>one</p><p>two</p>', ["one", "two"]),
        ("<p title='a>b' class = \"x\" >one</p ><p/>two<p\n>three", ["one", "two", "three"]),
        ("<!-- never closed <p>x", []),
        ("a <!doctype never closed", ["a"]),
        ("1 < 2 </ 3 <3 &lt;p&gt; <", ["1 < 2 </ 3 <3 <p> <"]),
        ("<div =x =y/>one</div><a/b=c>two", ["one", "two"]),
        ("<script>if (a<b) '</p>'</scr" + "<p>", []),
    ],
)
def test_broken_markup(page, expected):
    assert [t for t, _, _ in html_blocks.blocks(page)] == expected


def test_class_words_have_no_cap():
    page = '<div class="a b c d e f g h i j k l m sidebar">x</div>'
    assert ".sidebar" in html_blocks.blocks(page)[0][1]


@pytest.mark.parametrize(
    "page",
    [
        "<a " + "x" * 200_000, "<a " * 100_000, "<" * 200_000, '<a b="' * 50_000, "<a b='x" * 50_000, "<!--" * 50_000, "<!" * 100_000,
        "<div>x" * 20_000, "<p><b>x" * 20_000, "<ul><li>x" * 20_000, "<a " + " " * 200_000, "<a b" + " = " * 60_000, "<textarea>" * 20_000,
    ],
)
def test_markup_in_linear_time(page):
    start = time.perf_counter()
    html_blocks.blocks(page)
    assert time.perf_counter() - start < 2


def test_gradients():
    settings = html_blocks.Settings(path_slots=3, word_slots=2, hidden=3)
    rng = np.random.default_rng(0)
    x, lengths = rng.normal(size=(7, 5)).astype(np.float32), np.array([3, 0, 4])
    weights = tuple(rng.normal(size=s).astype(np.float64) / 2 for s in ((5, 12), (3, 12), (12,)))
    for backward in (False, True):
        steps, trace = html_blocks.packed(lengths, backward), []
        push = rng.normal(size=(7, 3))
        html_blocks.run_through(x, weights, steps, trace)
        made = html_blocks._back(x, weights, steps, trace, push.astype(np.float32))
        for k, w in enumerate(weights):
            for at in [(0,) * w.ndim, tuple(n - 1 for n in w.shape)]:
                values = []
                for change in (1e-3, -1e-3):
                    moved = [v.copy() for v in weights]
                    moved[k][at] += change
                    values.append((html_blocks.run_through(x, tuple(moved), steps) * push).sum())
                assert abs((values[0] - values[1]) / 2e-3 - made[k][at]) < 2e-2
    assert settings.hidden == 3


@pytest.fixture(scope="module")
def site(spark):
    """Pages of several layouts with the main text that they hold."""
    rng = random.Random(2)
    say = lambda: " ".join(rng.choice("the quick brown fox ran over lazy dogs near old mills".split()) for _ in range(rng.randint(4, 30)))
    rows = []
    for i in range(60):
        main = [say() for _ in range(rng.randint(1, 6))]
        body = f"<h1>{main[0]}</h1>" + "".join(f"<p>{t}</p>" for t in main[1:])
        opened, closed = [("<article>", "</article>"), ('<div class="content">', "</div>"), ('<main><div class="post">', "</div></main>")][i % 3]
        page = (
            f'<html><body><header><a href="/">{say()}</a></header><nav><ul><li><a href="/">{say()}</a></li></ul></nav><div class="cookie-notice">{say()}</div>{opened}{body}{closed}'
            f'<aside class="sidebar"><p>{say()}</p></aside><form><p>{say()}</p></form><section class="comments"><p>{say()}</p></section><footer>&copy; {say()}</footer></body></html>'
        )
        rows.append((i, f"u{i}", page, "\n".join(main)))
    return rows


def test_main_text(spark, site):
    odd = [(100, None, None), (101, "u", ""), (102, "u", "<nav>only</nav>"), (0, "u0", site[0][2])]
    made = html_blocks.main_text(pages_of(spark, [r[:3] for r in site] + odd)).collect()
    texts = {r.page_id: r.text for r in made}
    assert len(made) == 64 and all(r.n_chars == len(r.text) for r in made)
    assert texts[100] == "" and texts[101] == "" and texts[102] == ""
    right = sum(texts[i] == text for i, _, _, text in site)
    assert right >= 57, [(texts[i], t) for i, _, _, t in site if texts[i] != t][:3]


def plain_targets(sizes, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while free := [s for s in order if s not in capped]:
        level = (sum(sizes.values()) - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        new = {s for s in free if weight[s] * level > most * sizes[s]}
        if not new:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= new
    return {s: most * sizes[s] for s in order}


@pytest.mark.parametrize("block", [5000, 20])
def test_mix(spark, block):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "b", "b", "é", "Z", None]), "w " * rng.randint(0, 60)) for i in range(400)]
    rows += [(600, "a", "w w w")] * 50 + [(500, "only", None), (501, "void", ""), (None, "a", "x y z")]
    df = spark.createDataFrame([(i, s, t, 0, 0) for i, s, t in rows], "doc_id bigint, source string, text string, size int, block int")
    settings = mixing.Settings(block=block)
    made = mixing.mix(df, settings).collect()
    assert len(made) == len(rows) and all(r.taken == r.size * r.copies and 0 <= r.copies <= 3 for r in made)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    expected = plain_targets(sizes, (5, 2, 1), 3)
    assert sorted((r.source_size, round(r.target, 6)) for r in made) == sorted((sizes[s], round(float(expected[s]), 6)) for _, s, _ in rows)
    source_of, taken = {i: s for i, s, _ in rows}, dict.fromkeys(sizes, 0)
    for r in made:
        taken[source_of[r.doc_id]] += r.taken
    assert all(abs(taken[s] - expected[s]) <= (2 if block == 5000 else 60) for s in sizes)
    again = mixing.mix(df.repartition(5), settings).collect()
    key = lambda found: sorted((r.doc_id is None, r.doc_id or 0, r.size, r.target, r.taken) for r in found)
    assert key(again) == key(made)


def test_mixture_rows(spark):
    df = spark.createDataFrame([(1, "a", "w w", 7), (2, "b", "w", 8), (3, "c", "w w w w w w", 9)], "doc_id bigint, source string, text string, copies int")
    made = mixing.mixture(df)
    assert made.columns == df.columns
    taken = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    assert {i: [r.doc_id for r in made.collect()].count(i) for i in taken} == taken
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixture(df.limit(0)).collect() == []
    nothing = df.withColumn("text", F.lit(""))
    assert all(r.target == 0 and r.taken == 0 for r in mixing.mix(nothing).collect())


@pytest.mark.parametrize("seed", range(20))
def test_flight_keeps_totals(seed):
    rng = random.Random(seed)
    sizes = [float(rng.choice([0, 1, 5, 5, 7, 100, rng.randint(1, 50)])) for _ in range(rng.randint(1, 60))]
    before = [rng.random() for _ in sizes]
    after = mixing.flight(sizes, before, rng)
    assert sum(0 < c < 1 for c in after) <= 2 and all(0 <= c <= 1 for c in after)
    assert abs(sum(after) - sum(before)) < 1e-6
    assert abs(sum(c * s for c, s in zip(after, sizes, strict=True)) - sum(c * s for c, s in zip(before, sizes, strict=True))) < 1e-5
    assert set(mixing.landing(sizes, before, after, rng)) <= {0.0, 1.0}


def test_chances_are_kept_on_average():
    counts = np.zeros(6)
    for seed in range(3000):
        rng = random.Random(seed)
        counts += mixing.landing([3, 1, 4, 1, 5, 9], [0.5] * 6, mixing.flight([3, 1, 4, 1, 5, 9], [0.5] * 6, rng), rng)
    assert np.all(np.abs(counts / 3000 - 0.5) < 0.2)


TURNS = "conv_id bigint, turn bigint, role string, text string, id int, window_start int"


def plain_digests(rows):
    convs = {}
    for c, n, role, text in rows:
        convs.setdefault(c, []).append((n is not None, n or 0, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def conversations():
    rng = random.Random(6)
    bits = ["</turn>", "<turn>", "<text>", "\\", "\\l", "[INST]", "é", "日本", "word ", "\n", "a" * 40]
    rows = []
    for c in range(25):
        for n in range(rng.randint(1, 12)):
            role = "system" if n == 0 and c % 3 == 0 else rng.choice(["user", "assistant"])
            rows.append((c, n, role, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))))
    rows += [(30, 0, "system", "alone"), (31, None, None, None), (31, 1, "assistant", None), (None, 0, "user", "q"), (None, 1, "assistant", "a"), (32, 0, "assistant", "y" * 9000)]
    rows += [(33, 1, "assistant", "same"), (33, 1, "assistant", "same"), (34, 0, "<text>r", "x")]
    return rows


def plain_windows(rows, settings):
    """(conv, place of the first turn in tokens, bodies repeated, bodies new) of greedy windows."""
    out = []
    escape = lambda t: (t or "").replace("\\", "\\s").replace("<", "\\l").replace("[", "\\b")
    size = lambda b: max(1, -(-len(b) // settings.chars_per_token) + settings.marks)
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, escape(role), escape(text)) for c, t, role, text in rows if c == conv))
        system = turns.pop(0)[3] if turns[0][2] == "system" else None
        bodies, taken = [t[3] for t in turns], 0
        room = settings.budget - (size(system) if system is not None else 0)
        if not bodies:
            out.append((conv, 0, (), (system,)))
        while taken < len(bodies):
            history, first = min(settings.history, max(0, room - size(bodies[taken]))), taken
            while first and sum(map(size, bodies[first - 1 : taken])) <= history:
                first -= 1
            last = taken + 1
            while last < len(bodies) and sum(map(size, bodies[first : last + 1])) <= room:
                last += 1
            again, new = bodies[first:taken], bodies[taken:last]
            head = [system] if system is not None else []
            start = sum(map(size, bodies[:taken]))
            out.append((conv, start, tuple(head * (taken > 0) + again), tuple(head * (taken == 0) + new)))
            taken = last
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [chat.Settings(), chat.Settings(budget=60, history=15), chat.Settings(budget=60, history=15, max_rows=3), chat.Settings(budget=200, history=100)])
def test_chat(spark, settings):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS)
    windows = chat.windows(df, settings)
    made = {r.conv_id: tuple(r)[1:5] for r in chat.digests(windows).collect()}
    assert made == plain_digests(rows)
    for r in windows.collect():
        turns = re.findall(r"<turn>(.*?)<text>(.*?)</turn>", r.formatted, re.S)
        tokens = sum(-(-len(body) // 4) + 4 for _, body in turns)
        has_system = turns[0][0] == "system"
        assert tokens <= settings.budget or len(turns) == 1 + (has_system and len(turns) > 1)
        assert (turns[0][0] == "system") == any(x[:3] == (r.conv_id, 0, "system") for x in rows)
        for span in r.loss:
            assert r.formatted[: span.first].endswith("<turn>assistant<text>") and r.formatted[span.last :].startswith("</turn>")


def test_windows_are_greedy(spark):
    """Also a conversation of several hundred turns, through rounds of doubled pointers."""
    rng = random.Random(8)
    rows = conversations() + [(40, n, "user", "w" * rng.choice([0, 5, 90, 400])) for n in range(300)]
    rows += [(41, n, "user", "w" * size) for n, size in enumerate([3584, 1744, 1200, 1200, 1200, 1200, 4080, 4081, 9000, 1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS)
    for settings in (chat.Settings(), chat.Settings(budget=120, history=30)):
        found = []
        for r in chat.windows(df, settings).collect():
            bodies = re.findall(r"<turn>.*?<text>(.*?)</turn>", r.formatted, re.S)
            found.append((r.conv_id, r.window_start, tuple(bodies[: r.n_repeated]), tuple(bodies[r.n_repeated :])))
        assert sorted(found, key=str) == plain_windows(rows, settings)


def test_chat_without_turns(spark):
    assert chat.digests(chat.windows(spark.createDataFrame([], TURNS))).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 30)] + [(rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(25)] + [(7, 7), (200, 199), (199, 200)]
    rng.shuffle(links)
    root = {n: n for pair in links for n in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    nodes = spark.createDataFrame([(n,) for n in root], "node bigint").withColumnRenamed("node", "n").selectExpr("n", "n AS comp")
    scratch = Scratch(spark, "test")
    for step in components.components(scratch, spark.createDataFrame(links, "a bigint, b bigint")):
        nodes = components.follow(nodes, step, "comp")
    assert {r.n: r.comp for r in nodes.collect()} == root
    assert components.components(scratch, spark.createDataFrame([], "a bigint, b bigint")) == []
