"""Main-text extraction by a linear-chain conditional random field over DOM leaf blocks.

A page is parsed into leaf blocks: runs of text that no block-level tag interrupts, each with the
tags, classes, ids and roles of its ancestors. Every block gets indicator features of its ancestors
and of its text; a two-label chain (main text or not) trained by exact gradients on labelled pages
is decoded by Viterbi. Scripts, styles, templates, the title, input fields and markup comments hold no
text; whatever else a page holds (formulas, drawings, fallbacks of objects and frames) is text.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed, empty ones dropped, the main ones joined in page order by one newline. Null and empty
html give an empty text. Pages are independent rows: nothing is shuffled, collected or capped. A
page's cost grows with its length, however deep its tags are nested.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags whose content is not text, tags that stand alone, tags that run on inside a block (so does all within the last two).
_RAW = ("script", "style", "template", "textarea", "title", "select")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark object q s samp small span strike strong sub sup time tt u var wbr img math svg".split())
_ISLANDS = frozenset(("math", "svg"))
#: Opening one of these ends an open paragraph.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_ENDS_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: An inline end tag does not reach over these.
_BARRIERS = frozenset(("td", "th", "table", "body"))

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label|style|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_TOKEN = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """Text with the innermost block tag, the tags and marks of all ancestors, linked characters and place in the page."""

    text: str
    leaf: str
    tags: frozenset[str]
    marks: frozenset[str]
    linked: int
    where: float = 0.0


_NONE: frozenset[str] = frozenset()


class _Open:
    """The open tags. Each holds what its ancestors have; a set is shared with the parent where nothing is new."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str, frozenset[str], frozenset[str], int]] = [("", "", _NONE, _NONE, 0)]
        self.places: dict[str, list[int]] = {}

    def has(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def push(self, tag: str, marks: list[str]) -> None:
        _, leaf, tags, held, barrier = self.stack[-1]
        at = len(self.stack)
        if tag not in _INLINE:
            leaf = tag
            tags = tags if tag in tags else tags | {tag}
        held = held if held.issuperset(marks) else held.union(marks)
        self.places.setdefault(tag, []).append(at)
        self.stack.append((tag, leaf, tags, held, at if tag in _BARRIERS else barrier))

    def pop(self) -> None:
        self.places[self.stack.pop()[0]].pop()

    def close(self, tag: str) -> None:
        """End the innermost open ``tag`` and what is in it; without one, nothing."""
        if not self.has(tag):
            return
        at = self.places[tag][-1]
        if tag in _INLINE and at < self.stack[-1][4]:
            return
        while len(self.stack) > at:
            self.pop()


def parse(page: str | None, known: frozenset[str] | None = None) -> list[Block]:
    """Leaf blocks of a page in page order; unclosed and crossed tags are tolerated. ``known``: the marks that matter (None: all)."""
    if not page:
        return []
    blocks: list[Block] = []
    open_ = _Open()
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        joined = _SPACE.sub(" ", html_lib.unescape("".join(text))).strip()
        if joined:
            _, leaf, tags, marks, _ = open_.stack[-1]
            blocks.append(Block(joined, leaf, tags, marks, linked))
        text.clear()
        linked = 0

    def literal(piece: str) -> None:
        nonlocal linked
        if piece:
            text.append(piece)
            if open_.has("a"):
                linked += len(piece)

    at, n = 0, len(page)
    while at < n:
        found = _MARKUP.search(page, at)
        if found is None:
            literal(page[at:])
            break
        literal(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            if found[0].startswith("<![CDATA["):
                literal(found[0][9:].removesuffix("]]>"))
            continue
        if tag == "br":
            text.append(" ")
            continue
        alone = found[3].rstrip().endswith("/")
        island = any(map(open_.has, _ISLANDS))
        inline = tag in _INLINE or island or tag in _RAW and tag != "title"
        if not inline:
            flush()
        if found[1]:
            open_.close(tag)
            continue
        if tag in _RAW:
            if not alone and not (island and tag == "title"):
                end = _END[tag].search(page, at)
                at = end.end() if end else n
            continue
        if not inline:
            if tag == "body":
                open_.close("head")
            elif tag in _ENDS_P:
                open_.close("p")
            for other in _ENDS_SELF.get(tag, ()):
                if open_.stack[-1][0] == other:
                    open_.pop()
        if tag in _VOID or alone and tag not in _ENDS_P:
            continue
        marks = _marks(found[3])
        open_.push(tag, marks if known is None else [m for m in marks if m in known])
    flush()
    for i, b in enumerate(blocks):
        b.where = i / max(1, len(blocks) - 1)
    return blocks


_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}


def _marks(attributes: str) -> tuple[str, ...]:
    """Lower-case word pieces of class, id, role and the like; ``hidden`` for what is not shown."""
    out: list[str] = []
    for m in _ATTRIBUTE.finditer(attributes) if attributes.strip() else ():
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            out.append("hidden")
        elif name != "style":
            out += _TOKEN.findall(value)
    return tuple(out)


def features(blocks: list[Block]) -> list[list[str]]:
    """Indicator features of each block: ancestor tags and marks, length, links, punctuation, place."""
    out = []
    for b in blocks:
        n = len(b.text)
        words = b.text.count(" ") + 1
        share = b.linked / max(1, n)
        own = ["bias", f"leaf:{b.leaf}", f"length:{min(6, n.bit_length() // 2)}", f"words:{min(5, words.bit_length())}"]
        own += [f"in:{t}" for t in b.tags] + [f"mark:{m}" for m in b.marks]
        own.append("links:" + ("all" if share > 0.8 else "some" if share > 0.2 else "few" if share else "none"))
        own.append("ends:" + ("stop" if b.text[-1] in ".!?…:;\"'»”)" else "open"))
        if b.text[0] in "©&" or "©" in b.text:
            own.append("copyright")
        out.append(own)
    return out


@dataclass
class Field:
    """Feature numbers, (features, 2) state weights, (2, 2) transitions and (2,) first and last weights."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    state: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    first: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def marks(self) -> frozenset[str]:
        return frozenset(f[5:] for f in self.vocabulary if f.startswith("mark:"))

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.state[r].sum(axis=0) for r in rows]).reshape(-1, 2)

    def numbers(self, blocks: list[Block]) -> list[list[int]]:
        known = self.vocabulary
        return [[known[f] for f in fs if f in known] for fs in features(blocks)]


def viterbi(scores: np.ndarray, step: np.ndarray, first: np.ndarray) -> list[int]:
    """The labels of the best path."""
    n = len(scores)
    if not n:
        return []
    best = scores[0] + first
    back = np.zeros((n, 2), dtype=np.int8)
    for t in range(1, n):
        through = best[:, None] + step
        back[t] = through.argmax(axis=0)
        best = through.max(axis=0) + scores[t]
    path = [int(best.argmax())]
    for t in range(n - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return path[::-1]


def _log_add(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=0)
    return top + np.log(np.exp(a - top).sum(axis=0))


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 8, rate: float = 0.5, ridge: float = 1e-3) -> Field:
    """Maximise the conditional likelihood of the labels by AdaGrad over forward-backward gradients."""
    model = Field()
    for blocks, _ in pages:
        for fs in features(blocks):
            for f in fs:
                model.vocabulary.setdefault(f, len(model.vocabulary))
    model.state = np.zeros((len(model.vocabulary), 2))
    data = [(model.numbers(b), y) for b, y in pages if b]
    params = [model.state, model.step, model.first]
    seen = [np.full(p.shape, 1e-6) for p in params]
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        for i in rng.permutation(len(data)).tolist():
            rows, y = data[i]
            s = model.scores(rows)
            n = len(s)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = s[0] + model.first
            for t in range(1, n):
                ahead[t] = _log_add(ahead[t - 1][:, None] + model.step) + s[t]
            for t in range(n - 2, -1, -1):
                behind[t] = _log_add((model.step + s[t + 1] + behind[t + 1]).T)
            z = _log_add(ahead[-1])
            node = np.exp(ahead + behind - z)
            g_step = np.zeros((2, 2))
            for t in range(1, n):
                g_step -= np.exp(ahead[t - 1][:, None] + model.step + s[t] + behind[t] - z)
                g_step[y[t - 1], y[t]] += 1
            g_first = -node[0]
            g_first[y[0]] += 1
            delta = -node
            delta[np.arange(n), y] += 1
            g_state = np.zeros_like(model.state)
            for t, r in enumerate(rows):
                g_state[r] += delta[t]
            touched = np.abs(g_state) > 0
            g_state -= ridge * model.state * touched
            for p, g, h in zip(params, (g_state, g_step, g_first), seen, strict=True):
                h += g * g
                p += rate * g / np.sqrt(h)
    return model


def main_text(model: Field, page: str | None, known: frozenset[str] | None = None) -> str:
    """The main blocks of a page; ``known``: the marks that the model has, if they are at hand."""
    blocks = parse(page, model.marks() if known is None else known)
    if not blocks:
        return ""
    labels = viterbi(model.scores(model.numbers(blocks)), model.step, model.first)
    return "\n".join(b.text for b, y in zip(blocks, labels, strict=True) if y)


def extract(pages: DataFrame, model: Field, page_column: str = "page_id") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        known = own.marks()
        for batch in batches:
            texts = [main_text(own, h, known) for h in batch["html"].tolist()]
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(page_column).cast("long").alias("page_id"), "url", "html")
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
