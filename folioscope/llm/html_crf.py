"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read once into its leaf blocks, the runs of text that no block-level tag interrupts. A block's features are the tags and classes that
it stands in and figures of its text; the chain's labels are content and boilerplate. The field is trained by likelihood on a bounded sample
of labelled pages and a page is decoded by Viterbi's algorithm.

The supplied pages have no labels of their own. A page whose address ends in the number of a document is labelled by it: a block is
content if its words stand in that document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.arrow_text import map_batches, per_text, slices
from folioscope.llm.lbfgs import minimise
from folioscope.llm.scratch import drawn

BITS = 14
SAMPLE = 800
_PART = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9]*)|([^<]+|<)", re.S)
_STOP = re.compile("[>\"']")
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "noscript", "template", "svg")}  # elements whose content isn't parsed
DEEPEST = 512  # as in browsers, an element that would lie deeper is put beside the deepest one
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEAD = frozenset("title meta link base".split())  # any other tag ends the head, whose text is none of the page's
#: An opening tag ends these, if one is open.
_ENDS = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)} | dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split(), ("p",))


class _Ends:
    """Where the tags of a page end: each at the first ``>`` outside quotes. A quote that nothing closes is a character like any other.

    Whatever the page, its characters are passed over a bounded number of times: what a search that found no end has seen ends later ones.
    """

    def __init__(self, html: str):
        self.html, self.dead = html, set()
        self.last = {c: html.rfind(c) for c in ">\"'"}
        self.clear = (0, -1)  # no stop from the first place to before the second, which is one

    def behind(self, i: int) -> int:
        """The place of the ``>`` that ends a tag whose name ends at ``i``; -1 if there is none."""
        seen = []
        if i > self.last[">"]:
            return -1
        if not self.clear[0] <= i <= self.clear[1]:
            m = _STOP.search(self.html, i)
            self.clear = (i, m.start() if m else len(self.html))
        j = self.clear[1]
        while j <= self.last[">"] and j not in self.dead:
            c = self.html[j]
            if c == ">":
                return j
            seen.append(j)
            close = self.html.find(c, j + 1) if j < self.last[c] else -1
            m = _STOP.search(self.html, (close if close >= 0 else j) + 1)
            j = m.start() if m else len(self.html)
        self.dead.update(seen)
        return -1


class Page:
    """The leaf blocks of a page: their texts, their own features, and the node each stands in. Nodes form a tree (``parent``, before its children) and have the
    features that their element adds to those above it, so that a page's size bounds that of its features however deep it is."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.own: list[list[int]] = []
        self.node: list[int] = []
        self.parent: list[int] = [0]
        self.names: list[list[int]] = [[]]

    def features(self) -> list[list[int]]:
        """Each block's features and those of all that it stands in."""
        above: list[list[int]] = [[]]
        for k in range(1, len(self.parent)):
            above.append(above[self.parent[k]] + self.names[k])
        return [own + above[k] for own, k in zip(self.own, self.node)]

    def size(self) -> int:
        """How many features ``features`` would list."""
        above = [0]
        for k in range(1, len(self.parent)):
            above.append(above[self.parent[k]] + len(self.names[k]))
        return sum(len(own) + above[k] for own, k in zip(self.own, self.node))


def blocks(html: str) -> Page:
    """The leaf blocks in order. Unclosed and stray tags are borne as browsers do, roughly; a tag without an end is text."""
    page = Page()
    stack: list[tuple[str, tuple[str, ...], int]] = []
    open_: dict[str, int] = {}
    heads: list[tuple[str, int, int]] = []
    run: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal run, linked
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text and "head" not in open_:
                heads.append((next((t for t, _, _ in reversed(stack) if t not in _INLINE), "none"), linked, len(stack)))
                page.texts.append(text)
                page.node.append(stack[-1][2] if stack else 0)
            run, linked = [], 0

    def pop() -> None:
        for x in stack.pop()[1]:
            if open_[x] == 1:
                del open_[x]
            else:
                open_[x] -= 1

    ends, at = _Ends(html), 0
    while at < len(html):
        m = _PART.match(html, at)
        at = m.end()
        tag, text = m[2], m[3]
        end = ends.behind(at) if tag else -1
        if tag and end < 0:
            tag, text, at = None, "<", m.start() + 1
        if text is not None:
            run.append(text)
            if "a" in open_:
                linked += len(text)
            continue
        if tag is None:
            continue
        attributes, at, tag = html[at:end], end + 1, tag.lower()
        if tag in _RAW and not m[1]:
            found = _RAW[tag].search(html, at)
            at = found.end() if found else len(html)
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag not in _INLINE:
            close()
        if m[1]:
            if tag in open_:
                while stack:
                    t = stack[-1][0]
                    pop()
                    if t == tag:
                        break
            continue
        if tag in _VOID:
            continue
        if "head" in open_ and tag not in _HEAD:
            while "head" in open_:
                pop()
        ended = _ENDS.get(tag, ())
        while stack and (stack[-1][0] in ended or (stack[-1][0] in _INLINE and len(stack) > 1 and stack[-2][0] in ended)):
            pop()
        while len(stack) >= DEEPEST:
            pop()
        names = (tag,)
        if attributes and (c := _CLASS.search(attributes)):
            names += tuple(f"{tag}.{x.lower()}" for x in (c[1] or c[2] or c[3] or "").split())
        page.parent.append(stack[-1][2] if stack else 0)
        page.names.append([_code("in " + x) for x in dict.fromkeys(names) if x not in open_])
        for x in names:
            open_[x] = open_.get(x, 0) + 1
        stack.append((tag, names, len(page.names) - 1))
    close()
    n = len(page.texts)
    page.own = [_features(t, *h, i, n) for i, (t, h) in enumerate(zip(page.texts, heads))]
    return page


_KNOWN: dict[str, int] = {}


def _code(name: str) -> int:
    at = _KNOWN.get(name)
    if at is None:
        at = zlib.crc32(name.encode()) & ((1 << BITS) - 1)
        if len(_KNOWN) < 50_000:
            _KNOWN[name] = at
    return at


def _features(text: str, parent: str, linked: int, depth: int, i: int, n: int) -> list[int]:
    size = len(text)
    words = text.count(" ") + 1
    stops = text.count(".") + text.count("!") + text.count("?")
    names = ["bias", f"parent {parent}", f"size {size.bit_length()}", f"words {words.bit_length()}", f"links {min(4, 5 * linked // size)}", f"stops {stops.bit_length()}", f"commas {text.count(',').bit_length()}", f"ends {text[-1] in '.!?…'}", f"depth {min(depth, 12)}", f"from top {min(i, 4)}", f"from end {min(n - 1 - i, 4)}", f"third {3 * i // n}", f"digits {min(4, 5 * sum(map(text.count, '0123456789')) // size)}"]
    return [_code(x) for x in names]


class ChainField:
    """Weights of features for each of two labels, and of a label after another."""

    def __init__(self, weight: np.ndarray, step: np.ndarray):
        self.weight, self.step = weight, step

    def sums(self, features: list[list[int]]) -> np.ndarray:
        """The weights of each list of features, a row for each."""
        size = np.array([len(f) for f in features], np.int64)
        flat = np.fromiter((x for f in features for x in f), np.int64, int(size.sum()))
        return per_text(self.weight[flat], np.concatenate([[0], np.cumsum(size)]))

    def labels(self, page: Page) -> list[int]:
        """The labels of the best path over a page's blocks."""
        above = self.sums(page.names).tolist()
        for k in range(1, len(above)):
            (u, v), (x, y) = above[k], above[page.parent[k]]
            above[k] = (u + x, v + y)
        return self.best((self.sums(page.own) + np.array(above)[page.node]).tolist()) if page.own else []

    def decode(self, features: list[list[int]]) -> list[int]:
        """The labels of the best path over blocks whose features are listed in full."""
        return self.best(self.sums(features).tolist()) if features else []

    def best(self, unary: list[list[float]]) -> list[int]:
        """Viterbi's algorithm over scores of each block's two labels."""
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = unary[0]
        back = []
        for u, v in unary[1:]:
            from0, from1 = b + s10 > a + s00, b + s11 > a + s01
            back.append((from0, from1))
            a, b = (b + s10 if from0 else a + s00) + u, (b + s11 if from1 else a + s01) + v
        at = int(b > a)
        path = [at]
        for row in reversed(back):
            at = int(row[at])
            path.append(at)
        return path[::-1]


def fit_pages(pages: list[tuple[list[list[int]], list[int]]], *, l2: float = 0.5) -> ChainField:
    """Penalised maximum likelihood over (features, labels) of each page, by forward and backward sums over all pages at once."""
    pages = sorted((p for p in pages if p[1]), key=lambda p: -len(p[1]))
    width = 1 << BITS
    if not pages:
        return ChainField(np.zeros((width, 2)), np.zeros((2, 2)))
    size = np.array([len(y) for _, y in pages])
    most, n = int(size[0]), len(pages)
    first = np.cumsum(size) - size
    flat = np.array([x for p, _ in pages for f in p for x in f])
    row = np.repeat(np.arange(size.sum()), [len(f) for p, _ in pages for f in p])
    y = np.array([v for _, p in pages for v in p])
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(most)]  # pages longer than t
    follows = np.ones(len(y), bool)
    follows[first] = False
    pairs = np.flatnonzero(follows)
    seen_step = np.zeros((2, 2))
    np.add.at(seen_step, (y[pairs - 1], y[pairs]), 1)
    seen = np.zeros((width, 2))
    np.add.at(seen, (flat, y[row]), 1)
    used = np.flatnonzero(seen.sum(1))
    to = np.zeros(width, np.int64)
    to[used] = np.arange(len(used))
    col, seen = to[flat], seen[used]

    def f(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, step = x[:-4].reshape(-1, 2), x[-4:].reshape(2, 2)
        u = np.stack([np.bincount(row, w[col, k], len(y)) for k in (0, 1)], 1)
        alpha, beta = np.zeros((most, n, 2)), np.zeros((most, n, 2))
        alpha[0] = u[first]
        for t in range(1, most):
            m = live[t]
            alpha[t, :m] = np.logaddexp(alpha[t - 1, :m, :1] + step[0], alpha[t - 1, :m, 1:] + step[1]) + u[first[:m] + t]
        for t in range(most - 2, -1, -1):
            m = live[t + 1]
            after = u[first[:m] + t + 1] + beta[t + 1, :m]
            beta[t, :m] = np.stack([np.logaddexp(*(step[k] + after).T) for k in (0, 1)], 1)
        z = np.logaddexp(*alpha[size - 1, np.arange(n)].T)
        post = np.zeros((len(y), 2))
        want = np.zeros((2, 2))
        for t in range(most):
            m = live[t]
            post[first[:m] + t] = np.exp(alpha[t, :m] + beta[t, :m] - z[:m, None])
            if t:
                after = u[first[:m] + t] + beta[t, :m]
                want += np.exp(alpha[t - 1, :m, :, None] + step + after[:, None, :] - z[:m, None, None]).sum(0)
        score = u[np.arange(len(y)), y].sum() + (step * seen_step).sum()
        grad = np.stack([np.bincount(col, post[row, k], len(used)) for k in (0, 1)], 1) - seen
        value = z.sum() - score + l2 / 2 * (x * x).sum()
        return float(value), np.concatenate([grad.ravel(), (want - seen_step).ravel()]) + l2 * x

    x = minimise(f, np.zeros(2 * len(used) + 4), 60)
    weight = np.zeros((width, 2))
    weight[used] = x[:-4].reshape(-1, 2)
    return ChainField(weight, x[-4:].reshape(2, 2))


def label(texts: list[str], document: str) -> list[int]:
    """1 for each block whose words stand in a row in ``document``, or for one of over four words three quarters of its runs of four; 0 for a single word."""
    words = document.split()
    known = {n: {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} for n in (2, 3, 4)}
    out = []
    for t in texts:
        words = t.split()
        n = min(4, len(words))
        runs = [tuple(words[k : k + n]) for k in range(0, max(1, len(words) - 3), 4)]
        out.append(int(n > 1 and sum(r in known[n] for r in runs) >= 0.75 * len(runs)))
    return out


def labelled_pages(pages: DataFrame, docs: DataFrame, *, most: int = SAMPLE) -> DataFrame:
    """(page_id, html, document) of at most ``most`` page ids, those of least hash, whose address ends in the number of a document.

    Only ids and numbers are broadcast, of which ``most`` bounds the number; pages and documents, which may be of any length, meet in a join.
    """
    number = F.regexp_extract(F.regexp_replace("url", r"[?#].*$", ""), r"/(\d{1,18})(?:\.html)?/?$", 1)
    known = pages.filter("html is not null").withColumn("number", F.when(number != "", number).cast("long")).filter("number is not null")
    few = pages.sparkSession.createDataFrame(drawn(known.select("page_id", "number").distinct(), F.struct("page_id", "number"), most).collect(), "page_id long, number long")
    wanted = docs.select("doc_id", F.col("text").alias("document")).join(F.broadcast(few.select("number").distinct()), F.col("doc_id") == F.col("number"), "left_semi")
    given = known.select("page_id", "number", "html").join(F.broadcast(few), ["page_id", "number"], "left_semi")
    return given.join(wanted.filter("document is not null"), F.col("number") == F.col("doc_id")).select("page_id", "html", "document")


def fit(labelled: DataFrame, *, most_features: int = 200_000) -> ChainField:
    """The field of (page_id, html, document) rows, of which there is a bounded number; a page of more than ``most_features`` teaches nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feats, labels = [], []
            for html, document in zip(batch.column("html").to_pylist(), batch.column("document").to_pylist()):
                page = blocks(html)
                fits = page.size() <= most_features
                feats.append(page.features() if fits else [])
                labels.append(label(page.texts, document) if fits else [])
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(feats, pa.list_(pa.list_(pa.int32()))), pa.array(labels, pa.list_(pa.int32()))], names=["page_id", "features", "labels"])

    rows = map_batches(labelled, run, "page_id long, features array<array<int>>, labels array<int>").toArrow().sort_by("page_id")
    # a page none of whose blocks stand in the document isn't that document's
    return fit_pages([(f, y) for f, y in zip(rows.column("features").to_pylist(), rows.column("labels").to_pylist()) if sum(y)])


def extracted(pages: DataFrame, model: ChainField, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, n_blocks, n_content, text) of each page; ``text`` joins its content blocks by line ends.

    A null page has a null text and 0 blocks, an empty one or one without text an empty text. A page of any length, however malformed, is read in time that grows with
    its length. Of labels that score the same the block is boilerplate. Repeated rows give repeated results; other columns are ignored, whatever their names.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    one = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch):
                out: list[str | None] = []
                n, kept = [], []
                for html in part.column("text").to_pylist():
                    page = blocks(html or "")
                    chosen = [t for t, y in zip(page.texts, m.labels(page)) if y]
                    n.append(len(page.texts))
                    kept.append(len(chosen))
                    out.append(None if html is None else "\n".join(chosen))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int32()), pa.array(kept, pa.int32()), pa.array(out, pa.string())], names=["id", "n_blocks", "n_content", "text"])

    return map_batches(one, run, f"id {one.schema['id'].dataType.simpleString()}, n_blocks int, n_content int, text string").withColumnRenamed("id", id_col)
