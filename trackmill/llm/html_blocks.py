"""Main text of web pages: a recurrent labeller over the sequence of leaf blocks.

A page becomes the sequence of its text blocks. A bidirectional LSTM in numpy reads for each
block a vector of its tag path and its hashed words, sees the blocks before and after it, and
says whether it belongs to the main text. The weights are trained here: on a bounded sample
of the pages, labelled where their own markup says what a block is, and on pages laid out
from the words of that sample in many ways of marking up the same parts.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.spans import SPACED, Words
from trackmill.llm.work import map_batches

# Elements by how they bear on blocks.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript textarea select option svg math iframe object canvas audio video head title".split())
RAW = frozenset("script style textarea title iframe".split())
# Words of element names, classes and ids that say what a block is.
MAIN = frozenset("article main".split())
ASIDE = frozenset(
    "nav footer aside form button dialog .header .ad .ads .advert .advertisement .sponsored .promo .sidebar .aside .menu .nav .navbar .navigation .breadcrumb "
    ".breadcrumbs .cookie .cookies .consent .notice .alert .banner .comments .comment .replies .respond .share .social .related .pagination .pager "
    ".newsletter .subscribe .widget .login .search .copyright .popup .modal .footer .form".split()
)

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: A quote opens a value only right after the equals sign; one that is never closed is part of a bare value.
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
TOLD = ("class", "id", "role")
PARTS = re.compile(r"[a-z]+")
HINT_MAIN = ".xmainx"


@dataclass(frozen=True)
class Settings:
    """Sizes of the vectors and of the network, and of what it is trained on: `sample_pages` pages with their first
    `sample_blocks` blocks, the first `sample_words` words of each block for `made_pages` further pages, which
    draw from `vocabulary` words at most."""

    path_slots: int = 320
    word_slots: int = 24
    hidden: int = 16
    sample_pages: int = 160
    made_pages: int = 800
    sample_blocks: int = 400
    sample_words: int = 40
    vocabulary: int = 20_000
    epochs: int = 9
    rate: float = 0.01
    threshold: float = 0.5
    seed: int = 11


NUMBERS = 6


def tags(page: str) -> Iterator[tuple[int, int, str, str, list[str], bool]]:
    """(start, end, "/" of an end tag, name, words of class, id and role, whether it closes itself) of the tags, in order.

    Comments and declarations come as tags without a name, as does a tag that the page's end
    cuts off, which reaches to it. Every character is looked at a bounded number of times. After
    a tag whose content is text alone, the caller sends the place to go on from.
    """
    at, n = page.find("<"), len(page)
    while at >= 0:
        after = page[at + 1 : at + 2]
        name = NAME.match(page, at + 1 + (after == "/")) if after == "/" or after.isalpha() else None
        if name is None:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4) + 3
            elif after in ("!", "?"):
                end = page.find(">", at) + 1
            else:
                at = page.find("<", at + 1)
                continue
            end = n if end < 4 else end
            on = yield at, end, "", "", [], False
        else:
            words, end = [], name.end()
            while end < n and page[end] != ">" and (found := ATTRIBUTE.match(page, end)):
                end = found.end()
                if found[1].lower() in TOLD:
                    words += PARTS.findall((found[2] or found[3] or found[4] or "").lower())
            itself = end < n and page[end] == "/"
            while end < n and page[end] != ">":
                itself = page[end] == "/"
                end += 1
            if end < n:
                on = yield at, end + 1, "/" * (after == "/"), name[0].lower(), words, itself
            else:
                on = yield at, n, "", "", [], False
            end += 1
        at = page.find("<", on if on is not None else end)


def blocks(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """(text, path tokens, share of link text) of the leaf blocks that hold text, in page order.

    A block ends where an element begins or ends that is not inline. Character references
    are decoded, white space becomes one space, and what is never shown is left out. Of the
    path, each token comes once, and those of the two innermost elements once more at its
    end. Broken markup: a quote opens a value only after an equals sign, and only if it is
    closed somewhere; a tag cut off by the end of the page is no text; end tags without a start
    are skipped, and elements that are never closed end with the page.
    """
    found: list[tuple[str, tuple[str, ...], float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    places: dict[str, list[int]] = {}  # of the open elements, by name
    open_tokens: dict[str, int] = {}
    held: list[str] = []
    linked = unseen = at = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                inner = tuple(t for _, tokens in stack[-2:] for t in tokens)
                found.append((text, (*open_tokens, *inner), min(1.0, linked / len(text))))
            held.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not unseen:
            held.append(text)
            if places.get("a"):
                linked += len(text)

    def pop_to(place: int) -> None:
        nonlocal unseen
        while len(stack) > place:
            tag, tokens = stack.pop()
            unseen -= tag in UNSEEN
            places[tag].pop()
            for token in tokens:
                open_tokens[token] -= 1
                if not open_tokens[token]:
                    del open_tokens[token]

    def last(tag: str) -> int:
        return places[tag][-1] if places.get(tag) else -1

    reader = tags(page)
    found_tag = next(reader, None)
    while found_tag:
        start, end, closing, tag, words, itself = found_tag
        if start > at:
            say(page[at:start])
        at, on = end, None
        inline = tag in INLINE
        if not tag:
            pass
        elif closing:
            if not inline:
                flush()
            elif tag == "br":
                say(" ")
            if (place := last(tag)) >= 0:
                pop_to(place)
        else:
            if not inline:
                flush()
                if tag == "li" and (place := last("li")) > max(last("ul"), last("ol")):
                    pop_to(place)
                elif (place := last("p")) >= 0:
                    pop_to(place)
            elif tag == "br":
                say(" ")
            if tag not in VOID and not itself:
                tokens = (tag, *("." + w for w in words))
                places.setdefault(tag, []).append(len(stack))
                stack.append((tag, tokens))
                for token in tokens:
                    open_tokens[token] = open_tokens.get(token, 0) + 1
                unseen += tag in UNSEEN
                if tag in RAW:
                    close = re.compile(rf"</{tag}", re.I).search(page, at)
                    at = on = close.start() if close else len(page)
        try:
            found_tag = reader.send(on)
        except StopIteration:
            break
    say(page[at:])
    flush()
    return found


def _slot(token: str, slots: int) -> int:
    return zlib.crc32(token.encode()) % slots


def vectors(rows: list[tuple[str, tuple[str, ...], float]], settings: Settings, cache: dict) -> np.ndarray:
    """A row of numbers per block: hashed path, hashed words, and sizes."""
    out = np.zeros((len(rows), settings.path_slots + settings.word_slots + NUMBERS), np.float32)
    for i, (text, tokens, linked) in enumerate(rows):
        path = cache.get(tokens)
        if path is None:
            plain = [t for t in tokens if t != HINT_MAIN]
            tags = [t for t in plain if t[0] != "."]
            named = [*plain, "leaf " + (tags[-1] if tags else ""), "pair " + " ".join(tags[-2:])]
            path = np.zeros(settings.path_slots, np.float32)
            for token in named:
                path[_slot(token, settings.path_slots)] = 1
            if len(cache) < 100_000:
                cache[tokens] = path
        out[i, : settings.path_slots] = path
        n = len(text)
        out[i, -NUMBERS:] = (np.log1p(n) / 6, linked, text.count(" ") < 4, text[-1] in ".!?", i == 0, text[0] == "©")
    if rows:
        words = Words([r[0].encode("utf-8", "surrogatepass") for r in rows], SPACED)
        owner = np.repeat(np.arange(len(rows)), np.diff(words.bounds))
        slot = (words.hash % np.uint64(settings.word_slots)).astype(np.int64)
        counts = np.bincount(owner * settings.word_slots + slot, minlength=len(rows) * settings.word_slots)
        counts = counts.reshape(len(rows), settings.word_slots)
        out[:, settings.path_slots : -NUMBERS] = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def packed(lengths: np.ndarray, backward: bool) -> list[np.ndarray]:
    """For each step the rows that all pages still going have there, longer pages first."""
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    order = np.argsort(-lengths, kind="stable")
    steps = []
    for t in range(int(lengths.max(initial=0))):
        going = order[lengths[order] > t]
        steps.append(starts[going] + (lengths[going] - 1 - t if backward else t))
    return steps


def run_through(x: np.ndarray, weights: tuple, steps: list[np.ndarray], trace: list | None = None) -> np.ndarray:
    """Hidden states of every row of x along the steps."""
    into, across, bias = weights
    size = across.shape[0]
    projected = x @ into + bias
    out = np.zeros((len(x), size), np.float32)
    n = len(steps[0]) if steps else 0
    h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    for rows in steps:
        h, c = h[: len(rows)], c[: len(rows)]
        z = projected[rows] + h @ across
        gates = _sigmoid(z[:, : 3 * size])
        new = np.tanh(z[:, 3 * size :])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        c_next = f * c + i * new
        squashed = np.tanh(c_next)
        if trace is not None:
            trace.append((i, f, o, new, c, squashed, h))
        h, c = o * squashed, c_next
        out[rows] = h
    return out


def _back(x: np.ndarray, weights: tuple, steps: list[np.ndarray], trace: list, d_out: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weights from those of the hidden states."""
    into, across, bias = weights
    size = across.shape[0]
    d_z = np.zeros((len(x), 4 * size), np.float32)
    d_across = np.zeros_like(across)
    d_h, d_c = np.zeros((len(steps[0]), size), np.float32), np.zeros((len(steps[0]), size), np.float32)
    for rows, (i, f, o, new, c, squashed, h) in zip(reversed(steps), reversed(trace), strict=True):
        n = len(rows)
        dh = d_out[rows] + d_h[:n]
        dc = d_c[:n] + dh * o * (1 - squashed**2)
        z = np.concatenate([dc * new * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new**2)], axis=1)
        d_z[rows] = z
        d_across += h.T @ z
        d_h[:n], d_c[:n] = z @ across.T, dc * f
    return [x.T @ d_z, d_across, d_z.sum(axis=0)]


class Labeller:
    """The network: two directions and a logistic layer on both hidden states."""

    def __init__(self, settings: Settings):
        self.settings = settings
        rng = np.random.default_rng(settings.seed)
        width, size = settings.path_slots + settings.word_slots + NUMBERS, settings.hidden
        self.weights = []
        for _ in range(2):
            bias = np.zeros(4 * size, np.float32)
            bias[size : 2 * size] = 1
            self.weights += [
                (rng.normal(size=(width, 4 * size)) / 8).astype(np.float32),
                (rng.normal(size=(size, 4 * size)) / np.sqrt(size)).astype(np.float32),
                bias,
            ]
        self.weights += [(rng.normal(size=2 * size) / 4).astype(np.float32), np.zeros(1, np.float32)]

    def scores(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of each row; `lengths` are the rows of each page. Pages of like length go together."""
        out = np.zeros(len(x), np.float32)
        ends = np.cumsum(lengths)
        order = np.argsort(lengths, kind="stable")
        for lo in range(0, len(order), 256):
            some = order[lo : lo + 256]
            rows = np.concatenate([np.arange(ends[p] - lengths[p], ends[p]) for p in some]) if len(some) else np.empty(0, int)
            if len(rows):
                states = [run_through(x[rows], tuple(self.weights[3 * d : 3 * d + 3]), packed(lengths[some], bool(d))) for d in range(2)]
                out[rows] = _sigmoid(np.concatenate(states, axis=1) @ self.weights[6] + self.weights[7])
        return out

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> Labeller:
        """Adam on the cross-entropy of all blocks; pages are (vectors, labels)."""
        rng = np.random.default_rng(self.settings.seed)
        mean, spread = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(self.settings.epochs):
            order = rng.permutation(len(pages))
            for lo in range(0, len(order), 32):
                some = [pages[i] for i in order[lo : lo + 32]]
                lengths = np.array([len(y) for _, y in some])
                x, y = np.concatenate([p[0] for p in some]), np.concatenate([p[1] for p in some])
                traces, states, paths = [], [], []
                for d in range(2):
                    traces.append([])
                    paths.append(packed(lengths, bool(d)))
                    states.append(run_through(x, tuple(self.weights[3 * d : 3 * d + 3]), paths[d], traces[d]))
                both = np.concatenate(states, axis=1)
                error = ((_sigmoid(both @ self.weights[6] + self.weights[7]) - y) / len(y)).astype(np.float32)
                d_both = error[:, None] * self.weights[6]
                size = self.settings.hidden
                gradients = []
                for d in range(2):
                    gradients += _back(x, tuple(self.weights[3 * d : 3 * d + 3]), paths[d], traces[d], d_both[:, d * size : (d + 1) * size])
                gradients += [both.T @ error, error.sum(keepdims=True)]
                step += 1
                for w, g, m, v in zip(self.weights, gradients, mean, spread, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= self.settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def own_label(tokens: tuple[str, ...]) -> int | None:
    """What the path itself says: 1 main, 0 not, None nothing."""
    if ASIDE.intersection(tokens):
        return 0
    if HINT_MAIN in tokens:
        return 1
    if "header" in tokens:
        return int(bool(MAIN.intersection(tokens)) and tokens[-1] in ("h1", "h2"))
    return 1 if MAIN.intersection(tokens) else None


# Words of class names that made pages draw from, and elements that asides are made of.
_MAIN_WORDS = "content main post entry article story body text page single detail".split()
_ASIDE_WORDS = (
    "ad ads advert sponsored promo sidebar menu nav navbar navigation breadcrumb cookie consent notice alert banner comments comment replies share "
    "social related pagination newsletter subscribe widget login search copyright popup footer header"
).split()
_PLAIN_WORDS = "box area wrap bar list inner item block group panel".split()
_ASIDE_TAGS = ("nav", "header", "aside", "footer", "form")


def made_pages(words: list[str], settings: Settings) -> Iterator[str]:
    """Pages laid out from the words, with marks on the main text and on asides inside it."""
    rng = np.random.default_rng(settings.seed)

    def pick(choices):
        return choices[int(rng.integers(len(choices)))]

    def some(least: int, most: int) -> str:
        return html.escape(" ".join(words[i] for i in rng.integers(0, len(words), rng.integers(least, most))))

    def named(word: str) -> str:
        name = word if rng.random() < 0.4 else f"{word}-{pick(_PLAIN_WORDS)}"
        return f'{"id" if rng.random() < 0.2 else "class"}="{name}"'

    def listed(links: bool) -> str:
        item = '<li><a href="/">{}</a></li>' if links else "<li>{}</li>"
        return "<ul>" + "".join(item.format(some(1, 4) if links else some(2, 25)) for _ in range(rng.integers(1, 8))) + "</ul>"

    def filling() -> str:
        kind = rng.integers(0, 7)
        if kind == 0:
            return listed(links=True)
        if kind == 1:
            return " ".join(f'<a href="/">{some(1, 3)}</a>' for _ in range(rng.integers(1, 6)))
        if kind == 2:
            return f"<h3>{some(1, 4)}</h3><p>{some(3, 40)}</p>"
        if kind == 3:
            return f"<h1>{some(1, 6)}</h1><p>{some(2, 30)}</p>"
        if kind == 4:
            return some(2, 40)
        if kind == 5:
            return listed(links=False)
        return f"<p>{some(1, 50)}</p>" * int(rng.integers(1, 4))

    def aside() -> str:
        kind = rng.random()
        if kind < 0.4:
            tag = pick(_ASIDE_TAGS)
            return f"<{tag}>{filling()}</{tag}>"
        tag = pick(("div", "div", "section", "ul", *_ASIDE_TAGS))
        content = f"<li>{some(1, 20)}</li>" * 2 if tag == "ul" else filling()
        if kind > 0.9:
            content = f'<label>{some(1, 3)}</label><input name="q"><button>{some(1, 3)}</button>'
            tag = "form"
        return f"<{tag} {named(pick(_ASIDE_WORDS))}>{content}</{tag}>"

    def remarks() -> str:
        one = pick(('<div class="comment"><p>{}</p></div>', '<article class="comment"><p>{}</p></article>', "<li><p>{}</p></li>", '<div class="comment">{}</div>'))
        inside = "".join(one.format(some(2, 50)) for _ in range(rng.integers(1, 5)))
        head = f"<h2>{some(1, 4)}</h2>" if rng.random() < 0.5 else ""
        tag = pick(("div", "section", "ol"))
        return f'<{tag} {named("comments")}>{head}{inside}</{tag}>'

    def paragraph() -> str:
        kind = rng.integers(0, 12)
        simple = {
            0: f"<h2>{some(1, 9)}</h2>",
            1: listed(links=False),
            2: f"<p><b>{some(2, 12)}<br>",
            3: f"<blockquote>{some(1, 60)}</blockquote>",
            4: f"<blockquote><p>{some(1, 60)}</p></blockquote>",
            5: f"<table><tr><td>{some(1, 6)}</td><td>{some(1, 6)}</td></tr></table>",
            6: f'<p><em>{some(1, 30)}</em> <a href="/">{some(1, 5)}</a> {some(1, 30)}',
        }
        return simple.get(int(kind), f"<p>{some(1, 80)}</p>")

    def wrapped(content: str) -> str:
        kind = rng.integers(0, 6)
        if kind == 0:
            return f'<article class="xmainx">{content}</article>'
        if kind == 1:
            return f'<main class="xmainx">{content}</main>'
        name = "-".join(dict.fromkeys((pick(_MAIN_WORDS), pick(_MAIN_WORDS)))) if rng.random() < 0.6 else pick(_MAIN_WORDS)
        if kind == 2:
            return f'<main><article class="{name} xmainx">{content}</article></main>'
        if kind == 3:
            return f'<div class="{pick(_PLAIN_WORDS)}"><div class="{name} xmainx">{content}</div></div>'
        return f'<{pick(("div", "section"))} id="{name}" class="xmainx">{content}</div>'

    for _ in range(settings.made_pages):
        parts = [paragraph() for _ in range(rng.integers(0, 12))]
        for _ in range(int(rng.integers(0, 3)) if parts else 0):
            parts.insert(int(rng.integers(0, len(parts) + 1)), aside() if rng.random() < 0.7 else "")
        if rng.random() < 0.2:
            parts.append(remarks())
        main = wrapped(f"<h1>{some(1, 10)}</h1>" + "".join(parts))
        before = "".join(aside() for _ in range(rng.integers(0, 5)))
        after = "".join(remarks() if rng.random() < 0.3 else aside() for _ in range(rng.integers(0, 4)))
        yield f"<html><head><title>{some(2, 8)}</title></head><body>{before}{main}{after}</body></html>"


def trained(pages: DataFrame, settings: Settings) -> Labeller:
    """A labeller trained on at most `sample_pages` pages, those whose id hashes lowest, and on made ones."""
    # Ids first: only they, and then as many pages, come to the driver.
    ids = pages.select("page_id").dropna().distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(settings.sample_pages)
    picked = pages.select("page_id", "html").join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    cache: dict = {}
    examples, words = [], ["word"]
    for row in sorted(picked.collect()):
        found = blocks(row.html or "")[: settings.sample_blocks]
        words += [w for text, _, _ in found for w in text.split()[: settings.sample_words]]
        if any(MAIN.intersection(tokens) for _, tokens, _ in found):
            labels = np.array([own_label(tokens) or 0 for _, tokens, _ in found], np.float32)
            examples.append((vectors(found, settings, cache), labels))
    for page in made_pages(words[: settings.vocabulary], settings):
        found = blocks(page)
        labels = np.array([own_label(tokens) or 0 for _, tokens, _ in found], np.float32)
        if len(found):
            examples.append((vectors(found, settings, cache), labels))
    return Labeller(settings).train(examples)


def main_text(pages: DataFrame, settings: Settings | None = None) -> DataFrame:
    """page_id, url, text and n_chars, one row per row of pages.

    text joins the blocks of the main text in page order by line feeds; it is empty if the
    page (or its html, or null) has none. Repeated rows are labelled alike; extra columns
    are not read. The network is trained anew for each call, on a sample of bounded size.
    """
    settings = settings or Settings()
    weights = pages.sparkSession.sparkContext.broadcast(trained(pages, settings).weights)  # about 100 KB
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def make():
        labeller, cache = Labeller(settings), {}
        labeller.weights = weights.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts: list[str] = []
            for lo in range(0, batch.num_rows, 500):
                parsed = [blocks(page or "") for page in batch.column("html").slice(lo, 500).to_pylist()]
                rows = [block for page in parsed for block in page]
                lengths = np.array([len(page) for page in parsed])
                kept = labeller.scores(vectors(rows, settings, cache), lengths) >= settings.threshold
                at = 0
                for page in parsed:
                    texts.append("\n".join(text for (text, _, _), keep in zip(page, kept[at : at + len(page)], strict=True) if keep))
                    at += len(page)
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        return work

    return map_batches(pages.select("page_id", "url", "html"), make, schema)
