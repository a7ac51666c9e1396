"""Suffix-array dedup: repeated byte strings by a distributed merge sort that knows common prefixes.

Texts are cut into runs. Each run sorts its suffixes, to a depth that decides every string of
`length` bytes, and sends them to owners front-coded: the length of the prefix shared with the
suffix before, and the rest. An owner merges the sorted runs with a loser tree that keeps, for
every head, its common prefix with the last suffix put out; heads whose prefixes differ in
length are told apart without looking at them, and others are compared behind the known prefix
only. The merged order comes with its common prefixes, which give the classes of equal strings.

Three things keep what is exchanged small, and leave nothing out:

* Suffixes start at anchors: places whose hash of `gram` bytes is least among those of some
  string of `length` bytes. Every such string holds an anchor, at the same offset wherever it
  stands, so a suffix also carries what stands before its anchor.
* Suffixes whose first bytes no other document has needn't be sent, as in distinguishing-prefix
  sorting: runs send the hashes of their anchors, sorted and delta-coded, and owners answer with
  a code for each. A hash that meets another by chance only costs a needless suffix.
* Suffixes of a run that are equal are sent once, with their smallest document.

Owners hold ranges of the hash of the first bytes, so that no frequent prefix makes a large
owner. Anchors that stand more than `crowd` times are sent as the strings of `length` bytes
around them, each to the owner of its own hash: they differ where their surroundings do, and
are one row a run where they don't.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.spans import BASE, mix
from trackmill.llm.work import Scratch, arrow_schema, map_groups

#: Stands where a text has ended or not begun; no UTF-8 text holds it.
OUTSIDE = 0xFF
#: Answers about an anchor.
ALONE, SHARED, CROWDED = range(3)
#: Kinds of rows: answers about anchors, suffixes, strings.
ANCHORS, SUFFIXES, STRINGS = range(3)
_HASH_BITS = 56
_LAST_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Settings:
    """`length`: bytes of a repeated string; `gram`: of an anchor's hash; `run_bytes`: text of a run; `crowd`:
    places of an anchor beyond which its strings are sent one by one; `owners`: ranges of hashes (None: as many as
    shuffle partitions)."""

    length: int = 50
    gram: int = 24
    run_bytes: int = 8 << 20
    crowd: int = 20_000
    owners: int | None = None

    @property
    def before(self) -> int:
        """Bytes before an anchor that a string around it may take in."""
        return self.length - self.gram


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 2**64))


def gram_hashes(text: np.ndarray, k: int) -> np.ndarray:
    """A hash, never 0, of every k consecutive bytes, by doubling."""
    by_size, size = {1: text.astype(np.uint64) + np.uint64(1)}, 1
    while 2 * size <= k:
        half = by_size[size]
        by_size[2 * size] = half[:-size] * _power(size) + half[size:]
        size *= 2
    found, taken, count = None, 0, len(text) - k + 1
    for size in sorted(by_size, reverse=True):
        if k & size:
            part = by_size[size][taken : taken + count]
            found = part if found is None else found[:count] * _power(size) + part
            taken += size
    return (mix(found) >> np.uint64(64 - _HASH_BITS)) | np.uint64(1)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every `width` consecutive values."""
    size, found = 1, values
    while 2 * size <= width:
        found = pick(found[:-size], found[size:])
        size *= 2
    count = len(values) - width + 1
    return pick(found[:count], found[width - size : width - size + count])


class Run:
    """The texts of a run on end, its anchors, and what it sends about them."""

    def __init__(self, ids: list[int | None], lengths: list[int], text: bytes, settings: Settings):
        self.settings = settings
        self.text = np.frombuffer(text, np.uint8)
        self.ids = np.array([_LAST_ID if i is None else i for i in ids], np.int64)
        self.last = np.cumsum(np.array(lengths, np.int64))
        self.first = self.last - np.array(lengths, np.int64)
        self.places, hashes = self._anchors()
        self.doc = np.searchsorted(self.last, self.places, side="right")
        self.id = self.ids[self.doc]
        # The least hashes are chosen; mixed again they are spread over all values.
        hashes = mix(hashes ^ BASE) >> np.uint64(64 - _HASH_BITS)
        self.order = np.argsort(hashes, kind="stable")
        hashes = hashes[self.order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        self.starts, self.hashes = np.flatnonzero(new), hashes[new]
        self.of = np.empty(len(hashes), np.int64)
        self.of[self.order] = np.cumsum(new) - 1

    def _anchors(self, piece: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of anchors, worked out piece by piece with a margin."""
        length, gram = self.settings.length, self.settings.gram
        width, n = length - gram + 1, len(self.text)
        cut = np.zeros(n + 1, np.int8)  # strings that would run out of their text
        np.add.at(cut, np.maximum(self.first, self.last - length + 1), 1)
        np.add.at(cut, self.last, -1)
        cut = np.cumsum(cut, dtype=np.int8)[:n].astype(bool)
        places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for lo in range(0, n - length + 1, piece):
            text = self.text[lo : lo + piece + length - 1]
            found = gram_hashes(text, gram)
            least = _sliding(found, width, np.minimum)
            least[cut[lo : lo + len(least)]] = 0
            margin = np.zeros(width - 1, np.uint64)
            chosen = _sliding(np.concatenate((margin, least, margin)), width, np.maximum)
            at = np.flatnonzero((chosen == found) & (chosen > 0))
            places.append(at + lo)
            hashes.append(found[at])
        places, keep = np.unique(np.concatenate(places), return_index=True)
        return places, np.concatenate(hashes)[keep]

    def anchor_counts(self) -> np.ndarray:
        """For each hash its places, up to 32767, and as the highest bit whether several documents have it."""
        if not len(self.order):
            return np.empty(0, np.uint16)
        ids = self.id[self.order]
        several = np.minimum.reduceat(ids, self.starts) != np.maximum.reduceat(ids, self.starts)
        counts = np.diff(np.append(self.starts, len(ids)))
        return np.minimum(counts, 32767).astype(np.uint16) | (several.astype(np.uint16) << 15)

    def suffixes(self, answers: np.ndarray) -> Rows:
        """At shared anchors: `length` bytes from the anchor on, then those before it, the nearest first."""
        at = np.flatnonzero(answers[self.of] == SHARED)
        length, before = self.settings.length, self.settings.before
        strings = self._around(self.places[at] - before, self.doc[at], before + length)
        strings = np.concatenate((strings[:, before:], strings[:, :before][:, ::-1]), axis=1)
        return Rows(strings, self.hashes[self.of[at]], self.id[at], self.places[at], self.doc[at])

    def strings(self, answers: np.ndarray) -> Rows:
        """The strings around crowded anchors, each place once."""
        at = np.flatnonzero(answers[self.of] == CROWDED)
        length, before = self.settings.length, self.settings.before
        starts = self.places[at][:, None] - np.arange(before + 1)
        docs = np.broadcast_to(self.doc[at][:, None], starts.shape)
        inside = (starts >= self.first[docs]) & (starts + length <= self.last[docs])
        starts, keep = np.unique(starts[inside], return_index=True)
        docs = docs[inside][keep]
        found = self._around(starts, docs, length)
        hashes = np.zeros(len(starts), np.uint64)
        for column in found.T:
            hashes = hashes * BASE + column + np.uint64(1)
        return Rows(found, mix(hashes) >> np.uint64(64 - _HASH_BITS), self.ids[docs], starts, docs)

    def _around(self, starts: np.ndarray, docs: np.ndarray, width: int) -> np.ndarray:
        """The bytes from each start on, those outside of its text marked."""
        out = np.empty((len(starts), width), np.uint8)
        whole = (starts >= self.first[docs]) & (starts + width <= self.last[docs])
        if whole.any():
            out[whole] = np.lib.stride_tricks.sliding_window_view(self.text, width)[starts[whole]]
        edge = np.flatnonzero(~whole)
        for part in np.array_split(edge, len(edge) // 20_000 + 1):
            index = starts[part, None] + np.arange(width)
            outside = (index < self.first[docs[part], None]) | (index >= self.last[docs[part], None])
            index[outside] = 0
            found = self.text[index] if len(part) else out[part]
            found[outside] = OUTSIDE
            out[part] = found
        return out


class Rows:
    """Strings of equal length at places of a run: the distinct ones by owner and in order, each with its smallest document."""

    def __init__(self, strings: np.ndarray, hashes: np.ndarray, ids: np.ndarray, places: np.ndarray, docs: np.ndarray):
        self.ids, self.places, self.docs, self.width = ids, places, docs, strings.shape[1]
        whole = np.ascontiguousarray(strings).view(f"S{self.width}").ravel()
        _, first, self.of = np.unique(whole, return_index=True, return_inverse=True)
        self.distinct, self.hashes = strings[first], hashes[first]
        self.least = np.full(len(first), _LAST_ID)
        np.minimum.at(self.least, self.of, ids)

    def by_owner(self, owners: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct strings' order, and the bounds of owners in it."""
        owner = owner_of(self.hashes, owners)
        order = np.argsort(owner, kind="stable")
        return order, np.searchsorted(owner[order], np.arange(owners + 1))


def owner_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    """Ranges of hashes, so that sorted hashes are sorted by owner."""
    return ((hashes >> np.uint64(_HASH_BITS - 32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def packed(values: np.ndarray) -> tuple[int, bytes]:
    """Ascending hashes as the first one and the differences, in as few bytes each as the largest needs."""
    steps = np.diff(values)
    width = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    return int(values[0]), np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(first: int, steps: bytes, n: int) -> np.ndarray:
    out = np.full(n, first, np.uint64)
    if n > 1:
        whole = np.zeros((n - 1, 8), np.uint8)
        whole[:, : len(steps) // (n - 1)] = np.frombuffer(steps, np.uint8).reshape(n - 1, -1)
        out[1:] += np.cumsum(whole.view("<u8").ravel(), dtype=np.uint64)
    return out


def front_coded(strings: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted strings as the lengths of the prefixes shared with the one before, and the rests on end."""
    n, width = strings.shape
    shared = np.zeros(n, np.uint8)
    if n > 1:
        differ = strings[1:] != strings[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return shared.tobytes(), strings[np.arange(width) >= shared[:, None]].tobytes()


def decoded(shared: bytes, rests: bytes, width: int) -> list[bytes]:
    """The strings again."""
    at, string, out = 0, b"", []
    for prefix in shared:
        string = string[:prefix] + rests[at : at + width - prefix]
        at += width - prefix
        out.append(string)
    return out


def merged(runs: list[tuple[bytes, list[bytes]]], width: int) -> tuple[list[int], list[int], list[bytes]]:
    """Sorted runs (common prefixes, strings) in one order: common prefixes with the string before, runs and strings.

    A loser tree over the runs' heads. `known` is a head's common prefix with the last string put
    out. Of two heads the one with the longer one comes first, and the other's is also its common
    prefix with that one; equal ones are compared from there on, and the loser takes the new length.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads = [strings[0] if strings else None for _, strings in runs] + [None] * (size - len(runs))
    known, following, bytes_of = [0] * size, [1] * len(runs), int.from_bytes

    def first_of(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two heads."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        at = known[a]
        if at != known[b]:
            return (a, b) if at > known[b] else (b, a)
        x, y = x[at:], y[at:]
        if x == y:
            known[b] = width
            return a, b
        prefix = width - ((bytes_of(x, "big") ^ bytes_of(y, "big")).bit_length() + 7) // 8
        if x < y:
            known[b] = prefix
            return a, b
        known[a] = prefix
        return b, a

    losers, winners = [0] * size, [*[0] * size, *range(size)]
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = first_of(winners[2 * node], winners[2 * node + 1])
    best, prefixes, sources, out = winners[1], [], [], []
    while (head := heads[best]) is not None:
        prefixes.append(known[best])
        sources.append(best)
        out.append(head)
        shared, strings = runs[best]
        place = following[best]
        if place < len(strings):
            heads[best], known[best] = strings[place], shared[place]
            following[best] = place + 1
        else:
            heads[best], known[best] = None, -1
        node = (best + size) >> 1
        while node:
            other = losers[node]
            mine, theirs = known[best], known[other]
            if theirs > mine:
                best, losers[node] = other, best
            elif theirs == mine:
                best, losers[node] = first_of(best, other)
            node >>= 1
    return prefixes, sources, out


def earlier_elsewhere(shared: np.ndarray, strings: np.ndarray, ids: np.ndarray, settings: Settings) -> np.ndarray:
    """For each merged row and each string around its anchor, by bytes before it: whether a smaller document has it.

    Strings that start l bytes before the anchor are equal where length - l bytes from the
    anchor on are (a matter of the common prefixes) and the l bytes before it. Equal rows are
    taken as one, and an anchor all of whose rows are equal needs no look at its strings.
    """
    length, width = settings.length, strings.shape[1]
    before = width - length
    new = shared < width
    of, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    least = np.minimum.reduceat(ids, starts)
    out = np.repeat((least[of] < ids)[:, None], before + 1, axis=1)
    # distinct strings with a neighbour of the same anchor
    prefix = shared[starts]
    near = prefix >= length - before
    near[:-1] |= near[1:].copy()
    at = np.flatnonzero(near)
    if not len(at):
        return out
    rows = np.flatnonzero(near[of])
    place = np.cumsum(near)[of[rows]] - 1
    # the first of an anchor's rows has a shorter prefix, whatever row came before it here
    prefix, strings, least = prefix[at], strings[starts[at]], least[at]
    left = np.zeros(len(at), np.int64)
    for l in range(before + 1):
        if l:
            left = np.unique(left * 256 + strings[:, length + l - 1], return_inverse=True)[1]
        right = np.cumsum(prefix < length - l)
        key = right * (int(left.max()) + 1) + left
        order = np.argsort(key, kind="stable")
        firsts = np.flatnonzero(np.diff(key[order], prepend=-1))
        smallest = np.empty(len(at), np.int64)
        smallest[order] = np.repeat(np.minimum.reduceat(least[order], firsts), np.diff(np.append(firsts, len(order))))
        out[rows, l] = smallest[place] < ids[rows]
    return out


def _squeezed(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)


def _bits(flags: np.ndarray) -> bytes:
    return _squeezed(np.packbits(flags).tobytes())


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(_unsqueezed(bits, (n + 7) // 8), np.uint8), count=n).astype(bool)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow_schema(schema).types, strict=True)], names=schema.names)


_RUNS = _schema(run=T.LongType(), ids=T.ArrayType(T.LongType()), lengths=T.ArrayType(T.LongType()), text=T.BinaryType())
_HASHES = _schema(owner=T.LongType(), run=T.LongType(), n=T.LongType(), first=T.LongType(), steps=T.BinaryType(), counts=T.BinaryType())
_SORTED = _schema(owner=T.LongType(), kind=T.LongType(), run=T.LongType(), n=T.LongType(), shared=T.BinaryType(), rests=T.BinaryType(), ids=T.BinaryType())
_ANSWERS = _schema(run=T.LongType(), kind=T.LongType(), owner=T.LongType(), n=T.LongType(), bits=T.BinaryType())
_RESULT = _schema(doc_id=T.LongType(), n_bytes=T.LongType(), n_removed=T.LongType(), n_spans=T.LongType(), kept_sha256=T.StringType())


def _runs(docs: DataFrame, settings: Settings) -> DataFrame:
    """Whole texts on end, as many as fill a run."""

    def collect(batches):
        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def row():
            text = _squeezed(b"".join(texts))
            return _batch([(number, ids, [len(t) for t in texts], text)], _RUNS)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                ids.append(doc_id)
                texts.append(data)
                held += len(data) + 16
                if held >= settings.run_bytes:
                    yield row()
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(collect, _RUNS)


def _read(row: dict, settings: Settings) -> Run:
    return Run(row["ids"], row["lengths"], _unsqueezed(row["text"], sum(row["lengths"])), settings)


def _hashes(runs: DataFrame, owners: int, settings: Settings) -> DataFrame:
    """The hashes of anchors, by owner."""

    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                run = _read(row, settings)
                counts, out = run.anchor_counts(), []
                bounds = np.searchsorted(owner_of(run.hashes, owners), np.arange(owners + 1)).tolist()
                for owner, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    if hi > lo:
                        out.append((owner, row["run"], hi - lo, *packed(run.hashes[lo:hi]), counts[lo:hi].tobytes()))
                yield _batch(out, _HASHES)

    return runs.mapInArrow(send, _HASHES)


def _anchor_answers(hashes: DataFrame, settings: Settings) -> DataFrame:
    """Which anchors stand in several documents, and which are crowded."""

    def make():
        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                rows = table.slice(lo, hi - lo).to_pylist()
                values = np.concatenate([unpacked(r["first"], r["steps"], r["n"]) for r in rows])
                counts = np.concatenate([np.frombuffer(r["counts"], np.uint16) for r in rows])
                order = np.argsort(values, kind="stable")
                starts = np.flatnonzero(np.diff(values[order], prepend=np.uint64(0)))
                sizes = np.diff(np.append(starts, len(order)))
                several = (sizes > 1) | np.logical_or.reduceat(counts[order] >> 15 == 1, starts)
                crowded = several & (np.add.reduceat((counts[order] & 32767).astype(np.int64), starts) > settings.crowd)
                answers = np.empty(len(order), np.int64)
                answers[order] = np.repeat(several.astype(np.int64) + crowded, sizes)
                ends = np.cumsum([r["n"] for r in rows])
                for row, part in zip(rows, np.split(answers, ends[:-1]), strict=True):
                    bits = _bits(np.concatenate((part >= SHARED, part == CROWDED)))
                    out.append((row["run"], ANCHORS, row["owner"], row["n"], bits))
            return _batch(out, _ANSWERS)

        return work

    return map_groups(hashes, ["owner"], make, _ANSWERS)


def _answers(rows: list[dict]) -> np.ndarray:
    """One answer for each hash of a run, from those of its owners."""
    out = [np.empty(0, np.int64)]
    for row in sorted((r for r in rows if r["kind"] == ANCHORS), key=lambda r: r["owner"]):
        flags = _flags(row["bits"], 2 * row["n"]).astype(np.int64)
        out.append(flags[: row["n"]] + flags[row["n"] :])
    return np.concatenate(out)


def _with_answers(runs: DataFrame, answers: DataFrame, work, schema: T.StructType) -> DataFrame:
    """Runs `work` over each run and the answers to it."""
    together = runs.unionByName(answers, allowMissingColumns=True)

    def make():
        def each(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                rows = table.slice(lo, hi - lo).to_pylist()
                run = next(r for r in rows if r["kind"] is None)
                out += work(run, [r for r in rows if r["kind"] is not None])
            return _batch(out, schema)

        return each

    return map_groups(together, ["run"], make, schema)


def _sorted_runs(runs: DataFrame, answers: DataFrame, owners: int, settings: Settings) -> DataFrame:
    """The front-coded runs of suffixes and strings, by owner."""

    def work(row: dict, found: list[dict]) -> list[tuple]:
        run, codes, out = _read(row, settings), _answers(found), []
        for kind, rows in ((SUFFIXES, run.suffixes(codes)), (STRINGS, run.strings(codes))):
            order, bounds = rows.by_owner(owners)
            for owner, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if hi > lo:
                    shared, rests = front_coded(rows.distinct[order[lo:hi]])
                    ids = _squeezed(rows.least[order[lo:hi]].tobytes())
                    out.append((owner, kind, row["run"], hi - lo, shared, _squeezed(rests), ids))
        return out

    return _with_answers(runs, answers, work, _SORTED)


def _merged_answers(parts: DataFrame, settings: Settings) -> DataFrame:
    """For each run's suffixes and strings: which strings a smaller document has."""

    def make():
        def work(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                rows = table.slice(lo, hi - lo).to_pylist()
                kind = rows[0]["kind"]
                width = settings.length + (settings.before if kind == SUFFIXES else 0)
                streams = []
                for r in rows:
                    rests = _unsqueezed(r["rests"], r["n"] * width - sum(r["shared"]))
                    streams.append((r["shared"], decoded(r["shared"], rests, width)))
                prefixes, sources, strings = merged(streams, width)
                del streams
                strings = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, width)
                shared, back = np.array(prefixes), np.argsort(np.array(sources), kind="stable")
                ids = np.empty(len(shared), np.int64)
                ids[back] = np.concatenate([np.frombuffer(_unsqueezed(r["ids"], 8 * r["n"]), np.int64) for r in rows])
                found = earlier_elsewhere(shared, strings, ids, settings)[back]
                ends = np.cumsum([r["n"] for r in rows])
                for row, part in zip(rows, np.split(found, ends[:-1]), strict=True):
                    out.append((row["run"], kind, row["owner"], row["n"], _bits(part)))
            return _batch(out, _ANSWERS)

        return work

    return map_groups(parts, ["kind", "owner"], make, _ANSWERS)


def _covered(run: Run, found: list[dict], owners: int) -> np.ndarray:
    """The bytes of a run that go."""
    settings, codes = run.settings, _answers(found)
    starts = np.zeros(len(run.text) + 1, bool)
    for kind, rows in ((SUFFIXES, run.suffixes(codes)), (STRINGS, run.strings(codes))):
        answers = sorted((r for r in found if r["kind"] == kind), key=lambda r: r["owner"])
        if not answers:
            continue
        columns = settings.before + 1 if kind == SUFFIXES else 1
        flags = np.concatenate([_flags(r["bits"], r["n"] * columns).reshape(-1, columns) for r in answers])
        by_string = np.empty_like(flags)
        by_string[rows.by_owner(owners)[0]] = flags
        later = rows.least[rows.of] < rows.ids  # a smaller document of the run itself has the row
        for l in range(columns):
            place = rows.places - l
            inside = (place >= run.first[rows.docs]) & (place + settings.length <= run.last[rows.docs])
            starts[place[inside & (by_string[rows.of, l] | later)]] = True
    covered, open_now, length, piece = np.empty(len(run.text), bool), 0, settings.length, 1 << 20
    for lo in range(0, len(covered), piece):
        steps = starts[lo : min(lo + piece, len(covered))].astype(np.int32)
        ended = starts[max(0, lo - length) : max(0, lo - length + len(steps))]
        steps[len(steps) - len(ended) :] -= ended
        count = np.cumsum(steps) + open_now
        covered[lo : lo + len(steps)] = count > 0
        open_now = int(count[-1])
    return covered


def cleaned(docs: DataFrame, settings: Settings | None = None, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256, one row per row of docs; `text` too if asked for.

    A byte goes if a string of `length` bytes over it also starts in a document of a smaller
    doc_id; strings are those of the input. Rows of equal doc_id don't count as smaller than
    each other; a null doc_id is larger than all others. A null or empty text has no bytes, and
    a text of fewer than `length` keeps all of its own. A text of any length is one run at most;
    repeated texts cost one row a run. Other columns are not read. Kept bytes may cut a character,
    which then reads as a replacement character in `text`.
    """
    settings = settings or Settings()
    spark = docs.sparkSession
    owners = settings.owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "suffix-dedup")
    runs = scratch.settle(_runs(docs, settings), "runs")
    answers = scratch.settle(_anchor_answers(_hashes(runs, owners, settings), settings), "anchors")
    parts = _sorted_runs(runs, answers, owners, settings)
    more = scratch.settle(_merged_answers(parts, settings), "merged")
    schema = T.StructType([*_RESULT.fields, *[T.StructField("text", T.StringType())] * with_text])

    def work(row: dict, found: list[dict]) -> list[tuple]:
        run, out = _read(row, settings), []
        covered = _covered(run, found, owners)
        for doc_id, lo, hi in zip(row["ids"], run.first.tolist(), run.last.tolist(), strict=True):
            gone = covered[lo:hi]
            kept = run.text[lo:hi][~gone].tobytes()
            spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
            line = (doc_id, hi - lo, hi - lo - len(kept), spans, hashlib.sha256(kept).hexdigest())
            out.append((*line, kept.decode("utf-8", "replace")) if with_text else line)
        return out

    return _with_answers(runs, answers.unionByName(more), work, schema)
