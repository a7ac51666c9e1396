"""Counts over whole texts, many texts at once."""

from __future__ import annotations

import numpy as np

from trackmill.llm.spans import INVERSE, PIECE, SPACED, Words, mix, span_hashes

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
WINDOW = 8
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def totals(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the flags between neighbouring edges, which ascend. Running sums are held by the piece."""
    at = np.zeros(len(edges), np.int64)
    before = 0
    for lo in range(0, len(flags), PIECE):
        sums = np.concatenate(([0], np.cumsum(flags[lo : lo + PIECE], dtype=np.int64))) + before
        own = slice(np.searchsorted(edges, lo, "left"), np.searchsorted(edges, lo + PIECE, "left"))
        at[own] = sums[edges[own] - lo]
        before = sums[-1]
    at[np.searchsorted(edges, len(flags), "left") :] = before
    return np.diff(at)


def repeated(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of values found twice or more with one owner, and of those that come again later."""
    order = np.lexsort((values, owner))
    sorted_values, sorted_owner = values[order], owner[order]
    same = np.zeros(len(values) + 1, bool)
    same[1:-1] = (sorted_values[1:] == sorted_values[:-1]) & (sorted_owner[1:] == sorted_owner[:-1])
    often, again = np.empty(len(values), bool), np.empty(len(values), bool)
    often[order], again[order] = same[1:] | same[:-1], same[:-1]
    return often, again


def count(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts NAMES of each text.

    Words are `[^\\x20\\x09-\\x0D]+`. word_chars: code points in words; n_symbols: characters of
    `[#*$%&|<>]`; n_lines: lines (split at \\n) with a word; n_dup_lines: those equal to an
    earlier line; n_repeat_words: words inside 8-word windows found twice or more in the text.
    """
    words = Words(texts, SPACED, lower=False)
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = SPACED[joined]
    # In signed bytes the later ones of a character are those below -64.
    starts_char = joined.view(np.int8) >= -64
    found = {
        "n_words": np.diff(words.bounds),
        "word_chars": totals(inside & starts_char, words.offsets),
        "n_symbols": totals(SYMBOLS[joined], words.offsets),
    }

    ends = np.flatnonzero(joined == 0x0A)
    begins = np.concatenate(([0], ends[:-1] + 1))
    filled = totals(inside, np.concatenate((begins, [len(joined)]))) > 0
    begins, ends = begins[filled], ends[filled]
    lines = span_hashes(joined, begins, ends)
    del inside, starts_char, joined
    owner = np.searchsorted(words.offsets, begins, "right") - 1
    _, again = repeated(lines, owner)
    found["n_lines"] = np.bincount(owner, minlength=len(texts))
    found["n_dup_lines"] = np.bincount(owner[again], minlength=len(texts))

    n_windows = np.maximum(found["n_words"] - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(texts)), n_windows)
    start = np.arange(len(owner)) + np.repeat(words.bounds[:-1] - np.concatenate(([0], np.cumsum(n_windows)[:-1])), n_windows)
    windows = np.zeros(len(start), np.uint64)
    for j in range(WINDOW):
        windows = windows * INVERSE + words.hash[start + j]
    often, _ = repeated(mix(windows), owner)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start[often], 1)
    np.add.at(cover, start[often] + WINDOW, -1)
    found["n_repeat_words"] = totals(np.cumsum(cover)[:-1] > 0, words.bounds)
    return {name: found[name].astype(np.int64) for name in NAMES}
