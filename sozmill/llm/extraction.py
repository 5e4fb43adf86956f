"""Main text of pages by a tree-structured graphical model.

A block element is content or not. A potential on each element comes from its
tag, its class and id names, the length and shape of its text and its links;
pair potentials connect parent and child. Sum-product messages, once up the tree
and once down, give each element's exact marginal; training on labelled pages
climbs their exact likelihood, whose gradient is labels less marginals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, lean, with_fields
from .dom import Page, assemble, parse
from .labelled_pages import labelled_pages
from .logistic import probability

#: Bound of the pages of the table that are learned from, on average over hashes of their ids.
SAMPLE, ELEMENTS = 300, 2_000
#: The sample weighs this much of the hand-labelled pages, whose variety it lacks.
SAMPLE_WEIGHT = 0.25
RIDGE, STEPS = 0.1, 600
_LIMIT = 30.0


def features(page: Page) -> list[list[str]]:
    """Discrete features of each element; of its own text those that a reader sees."""
    length, ends = [0] * len(page.tag), [False] * len(page.tag)
    for node, piece in page.runs:
        if piece is not None:
            size = len(piece.strip())
            length[node] += size
            if size and (piece[-1] in ".!?:;,\n " or ". " in piece or ", " in piece) and any(c in piece for c in ".!?,"):
                ends[node] = True
    out = []
    for tag, names, n, link, point in zip(page.tag, page.names, length, page.link, ends):
        if n:
            share = link / n
            shape = [f"len={min(4, n // 40) if n < 200 else 5}", f"point={point}",
                     f"link={0 if not link else 1 if share < 0.3 else 2 if share < 0.8 else 3}"]
        else:
            shape = ["len=none"]
        out.append([f"tag={tag}", *shape, *[f"name={x}" for x in names]])
    return out


# Elements that go with what they stand in; other blocks may be set off from it.
FLOW = frozenset(
    "p li h1 h2 h3 h4 h5 h6 td th tr tbody thead tfoot caption blockquote pre dt dd ul ol dl table figure "
    "figcaption".split())


def visible(page: Page) -> tuple[list[str], list[int], list[int]]:
    """Features, parents and labels of the elements that a reader sees, the page itself first."""
    place, found, parent, label = {}, [], [], []
    for i, names in enumerate(features(page)):
        if not page.hidden[i]:
            place[i] = len(found)
            found.append(" ".join(names))
            parent.append(place.get(page.parent[i], -1))
            label.append(page.label[i])
    return found, parent, label


@dataclass
class TreeModel:
    """Log odds of each feature, and what parent and child gain by having one label.

    The gain is one for boxes and another for elements of the text's flow.
    """

    unary: dict[str, float]
    same: tuple[float, float]

    def marginals(self, page: Page) -> list[float]:
        """Log odds that each element is content, by messages up and down the tree."""
        find, parent, hidden, exp, log = self.unary.get, page.parent, page.hidden, math.exp, math.log
        belief = [sum(find(x, 0.0) for x in found) for found in features(page)]
        belief[0] = -_LIMIT  # the page itself is no content
        box, flow = map(exp, self.same)
        gain = [flow if tag in FLOW else box for tag in page.tag]
        up = [0.0] * len(belief)
        for i in range(len(belief) - 1, 0, -1):
            if not hidden[i]:
                odds = exp(max(-_LIMIT, min(_LIMIT, belief[i])))
                same = gain[i]
                up[i] = message = log((1 + same * odds) / (same + odds))
                belief[parent[i]] += message
        for i in range(1, len(belief)):
            if not hidden[i]:
                odds = exp(max(-_LIMIT, min(_LIMIT, belief[parent[i]] - up[i])))
                same = gain[i]
                belief[i] += log((1 + same * odds) / (same + odds))
        return belief


class Forest:
    """Labelled trees side by side, for messages on whole levels at once."""

    def __init__(self, trees: list[tuple[list[str], list[int], list[int]]], weight: list[float]):
        self.names = sorted({x for found, _, _ in trees for names in found for x in names.split()})
        place = {x: i for i, x in enumerate(self.names)}
        parent, label, share, depth, kind, self.node, self.feature = [], [], [], [], [], [], []
        for (found, up, labels), w in zip(trees, weight):
            first = len(parent)
            for i, names in enumerate(found):
                for x in names.split():
                    self.node.append(first + i)
                    self.feature.append(place[x])
                kind.append(int(names.split(" ", 1)[0].removeprefix("tag=") in FLOW))
                parent.append(first + up[i] if i else -1)
                depth.append(depth[first + up[i]] + 1 if i else 0)
            label += labels
            share += [w] * len(found)
        self.parent, self.label, self.share = np.array(parent), np.array(label, dtype=float), np.array(share)
        self.node, self.feature = np.array(self.node), np.array(self.feature)
        depth, self.kind = np.array(depth), np.array(kind)
        self.roots = depth == 0
        self.levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max()) + 1)]

    def gradient(self, unary: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slope of the likelihood in the feature weights and in the pair potentials."""
        gains = np.exp(same)[self.kind]

        def message(odds, gain):
            odds = np.exp(np.clip(odds, -_LIMIT, _LIMIT))
            return np.log((1 + gain * odds) / (gain + odds))

        own = np.bincount(self.node, weights=unary[self.feature], minlength=len(self.parent))
        own[self.roots] = -_LIMIT
        up = np.zeros(len(own))
        for level in reversed(self.levels):
            up[level] = message(own[level], gains[level])
            np.add.at(own, self.parent[level], up[level])
        full = own.copy()
        slope = np.zeros(2)
        for level in self.levels:
            above = np.clip(full[self.parent[level]] - up[level], -_LIMIT, _LIMIT)
            below = np.clip(own[level], -_LIMIT, _LIMIT)
            gain = gains[level]
            full[level] += message(above, gain)
            both = gain * (1 + np.exp(above + below))
            equal = self.label[level] == self.label[self.parent[level]]
            part = self.share[level] * (equal - both / (both + np.exp(above) + np.exp(below)))
            slope += np.bincount(self.kind[level], weights=part, minlength=2)
        rest = self.share * (self.label - probability(full))
        rest[self.roots] = 0
        return np.bincount(self.feature, weights=rest[self.node], minlength=len(unary)), slope

    def train(self) -> TreeModel:
        """The model of greatest likelihood less a ridge, by scaled gradient steps."""
        w, seen = np.zeros(len(self.names) + 2), np.full(len(self.names) + 2, 1e-6)
        w[-2:] = 1.0
        for _ in range(STEPS):
            unary, same = self.gradient(w[:-2], w[-2:])
            slope = np.append(unary, same) - RIDGE * w
            seen += slope ** 2
            w += 0.5 * slope / np.sqrt(seen)
            w[-2:] = np.maximum(0.0, w[-2:])
        return TreeModel(dict(zip(self.names, w.tolist())), tuple(w[-2:].tolist()))


def label_by_tag(page: Page) -> bool:
    """Label a page that marks its article by tag; False if it has none.

    Inside article or main all is content but what tags mark as beside the point.
    """
    if not any(tag in ("article", "main") for tag in page.tag):
        return False
    page.label = [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        inside = page.label[page.parent[i]] or page.tag[i] in ("article", "main")
        page.label[i] = int(bool(inside) and page.tag[i] not in ("nav", "aside", "footer", "form", "menu", "dialog")
                            and not page.hidden[i])
    return True


def fit(pages: DataFrame, id: str = "page_id", html: str = "html") -> TreeModel:
    """Learn from the labelled pages of this package and a bounded sample of ``pages``.

    The sample is labelled by the tags of pages that mark their article; pages of
    more than ``ELEMENTS`` elements are not learned from. An empty table leaves
    the labelled pages.
    """
    total = pages.count()
    share = min(1.0, SAMPLE / max(1, total))
    some = pages.filter(F.pmod(F.xxhash64(F.col(id).cast("string"), F.length(html)), F.lit(1 << 30))
                        < int(share * (1 << 30)))

    def run(batches):
        for batch in batches:
            trees = []
            for value in as_bytes(batch.column(0)):
                page = parse(value.as_py().decode())
                if label_by_tag(page) and len(page.tag) <= ELEMENTS:
                    trees.append(visible(page))
            kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([t[i] for t in trees], kind) for i, kind in enumerate(kinds)],
                ["features", "parent", "label"])

    rows = some.select(html).mapInArrow(lean(run), "features array<string>, parent array<int>, label array<int>")
    return trained(sorted(tuple(row) for row in rows.collect()))


def trained(sample: list[tuple[list[str], list[int], list[int]]]) -> TreeModel:
    """The model of the hand-labelled pages and, scaled to their weight, the sample."""
    hand = [visible(parse(source)) for source in labelled_pages()]
    sizes = [sum(len(t[0]) for t in trees) for trees in (hand, sample)]
    scale = SAMPLE_WEIGHT * sizes[0] / max(1, sizes[1])
    return Forest(hand + sample, [1.0] * len(hand) + [scale] * len(sample)).train()


def extract(pages: DataFrame, model: TreeModel, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars``.

    Blocks whose marginal is content, in page order, white space folded and
    character references decoded; empty if none. Null html is an empty page.
    Each page is taken whole and on its own, so repeated rows get equal texts. Columns of these
    names are replaced.
    """
    pages = pages.drop("text", "n_chars")
    others = [c for c in pages.columns if c != html]
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = []
            for value in as_bytes(batch.column(html)):
                page = parse(value.as_py().decode())
                odds = shared.value.marginals(page)
                texts.append(assemble(page, [o > 0 and not h for o, h in zip(odds, page.hidden)]))
            batch = batch.drop_columns([html])
            batch = batch.append_column("text", pa.array(texts, pa.string()))
            yield batch.append_column("n_chars", pa.array([len(t) for t in texts], pa.int64()))

    return pages.select(*others, html).mapInArrow(
        lean(run), with_fields(pages.select(*others), "text string, n_chars long"))
