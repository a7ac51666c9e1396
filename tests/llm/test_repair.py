"""Repairs of conversations against a search over all edits in plain Python."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from trackmill.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
WORDS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    space = lambda v: " " if v is None else v
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        for _ in range({0: 0, 3: 2}.get(hit, 1)):
            yield conv, turn, "user" if hit == 4 else role, text


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        kept = text.strip(WORDS)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_search(rows, faults):
    """Least (cost, audit) over all edits, with the roles and texts written."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, place, roles, written = heapq.heappop(queue)
        if place == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, written
        key = (place, roles[-1:])
        if key in done:
            continue
        done.add(key)
        options = [(5, "I", place, who, "") for who in ("user", "assistant")]
        if place < len(rows):
            role, text, fault = rows[place][2], rows[place][3], faults[place]
            options.append((2, "D", place + 1, None, None))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                options.append((more, "K", place + 1, role, text))
                options += [(1 + more, "R", place + 1, who, text) for who in ("user", "assistant")]
        for more, letter, after, who, text in options:
            path = roles + (who[:1] or "?") if who is not None else roles
            if re.fullmatch("(s?(ua)*u?)?", path):
                lines = written if who is None else (*written, f"{who}:{text}")
                heapq.heappush(queue, (cost + more, audit + letter, after, path, lines))


def plain_repairs(rows):
    out = []
    damaged = list(plain_damage(rows))
    for conv in dict.fromkeys(r[0] for r in rows):
        found = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = plain_faults(found)
        turns = {r[1] for r in found} - {None}
        initials = [r[2][:1] or "?" for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = plain_search(found, faults)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = ["Yes.", "No!", "why?", "cut off", "", " \n", "Yes.", "Two. Done", "end. \n", None, "Été! ", "ok.\x1f", "x." * 3000]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown", "s"]
    made = []
    for conv in range(120):
        for turn in range(rng.choice([1, 2, 5, 9, 30])):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            made.append((conv, rng.choice([turn, turn, turn, turn * 2, None]), role, rng.choice(texts)))
    made += [(None, 1, "user", "a."), (None, None, "assistant", "b.")] + [(500, t, "user", f"q{t}.") for t in range(150)]
    return made


@pytest.mark.parametrize("settings", [repair.Settings(), repair.Settings(piece=3, max_rows=100)])
def test_repairs(spark, rows, settings):
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS audit", "3 AS _conv")
    found = repair.repaired(turns, settings).collect()
    assert sorted(map(tuple, found), key=str) == plain_repairs(rows)


def test_empty_and_dropped(spark):
    lost = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    none = hashlib.sha256(b"").hexdigest()
    found = repair.repaired(spark.createDataFrame([(lost, 0, "user", "a.")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(lost, 0, 0, 0, 0, 0, 0, "", none)]
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversation():
    """Work in proportion to the rows, and the same edits whatever the pieces."""
    rng = random.Random(5)
    initials = "".join(rng.choice("uuasx") for _ in range(3000))
    faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in initials]
    one, other = (repair.Lattice(initials, faults, repair.Settings(piece=p)) for p in (128, 7))
    assert (one.cost, one.audit()) == (other.cost, other.audit())
