"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks (``html_blocks``). A logistic classifier gives every block a cost for
each label; the costs become capacities from a source (content) and to a sink
(boilerplate). Smoothness edges join blocks that follow each other, weaker the further apart they lie
in the element tree, and blocks of the same element and of the element around it. A maximum flow
then gives the labelling of least cost: blocks on the source's side are the text.

The classifier needs no labelled pages. Blocks inside elements that say what they are (article,
nav, a class such as ``cookie-notice``) are its examples. Each serves three times: as it
is; with boilerplate marks hidden, so that text beside a marked article is learnt; with all marks
hidden, so that pages without any are judged by shape (length, links, punctuation, element).
Shape counts only where no mark speaks. Fitted weights are drawn to stated prior ones, which hold
where a table has nothing to learn from.

Defined results: null or empty html, and a page without text, give an empty text; blocks have single
spaces inside and are joined by one newline; equal costs count as content; repeated rows give
repeated rows; an empty table gives an empty result. Other columns are dropped, whatever their names.

Scale: one pass over the pages and no shuffle; the fit counts equal feature rows in Spark on at most
``FIT_PAGES`` pages (all marked blocks of them) and collects at most some thousand counts. A page is
the unit of work; its flow is bounded by its edges' capacities.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm._text import record, workers_find_package
from ledgerlake.llm.html_blocks import CONTENT, NONE, STRONG, WEAK, Block, blocks

FIT_PAGES = 2000
UNITS = 100  # capacities are whole numbers: so many to one unit of log odds
FOLLOWS, SAME_ELEMENT, NEAR_ELEMENT = 1.0, 0.5, 0.25  # log odds by which two blocks would rather share a label
ENDINGS = ".!?…:;。！？\"”»)"
# Prior weights, by which a block is judged without any examples.
PRIOR = {"content": 6.0, "weak": -4.0, "strong": -6.0, "beside": -3.0, "bias": -1.0, "words": 2.0, "links": -4.0, "ends": 1.0, "commas": 0.5, "p": 1.0, "heading": 0.5, "item": -0.5, "cell": -0.5}
NAMES = list(PRIOR)
_SHAPE = "words int, links int, ends int, commas int, tag int"
_TAGS = {"p": 1, "blockquote": 1, "pre": 1, **{f"h{k}": 2 for k in range(1, 7)}, "li": 3, "dd": 3, "dt": 3, "td": 4, "th": 4}


def shape_of(block: Block) -> tuple[int, int, int, int, int]:
    """Coarse features, so that the fit can count equal ones: log2 of words, links in fifths, ending, commas, element."""
    words = block.text.count(" ") + 1
    commas = block.text.count(",") * 10 // words
    return min(words.bit_length(), 10), 5 * block.linked // max(block.raw, 1), int(block.text[-1] in ENDINGS), min(commas, 2), _TAGS.get(block.tag, 0)


def _row(state: int, beside: int, shape: tuple[int, int, int, int, int]) -> list[float]:
    """The features of a block, in the order of NAMES."""
    if state != NONE:
        return [float(state == s) for s in (CONTENT, WEAK, STRONG)] + [0.0] * (len(NAMES) - 3)
    words, links, ends, commas, tag = shape
    return [0.0, 0.0, 0.0, float(beside), 1.0, words / 5, links / 5, float(ends), commas / 2, *(float(tag == k) for k in (1, 2, 3, 4))]


def fit(pages: DataFrame, bound: int = FIT_PAGES, rounds: int = 30, penalty: float = 1.0) -> dict[str, float]:
    """Weights learnt from the marked blocks of at most ``bound`` pages (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    order = F.xxhash64("page_id", "url", F.lit("blocks"))
    picks = pages.select(order.alias("_order")).distinct().orderBy("_order").limit(bound)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(b.state, *shape_of(b)) for page in batch.column(0).to_pylist() for b in blocks(page or "") if b.state != NONE]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            names = ["state", "words", "links", "ends", "commas", "tag"]
            yield record(**{n: pa.array(c, pa.int32()) for n, c in zip(names, columns, strict=True)})

    workers_find_package(pages.sparkSession)
    sample = pages.withColumn("_order", order).join(F.broadcast(picks), "_order", "left_semi").select("html")
    counted = sample.mapInArrow(task, f"state int, {_SHAPE}").groupBy("state", "words", "links", "ends", "commas", "tag").count().collect()
    rows, label, weight = [], [], []
    for state, *shape, n in sorted(map(tuple, counted)):
        good = float(state == CONTENT)
        seen = [(state, 0), (NONE, 0)] + ([] if good else [(NONE, 1)])
        for s, beside in seen:
            rows.append(_row(s, beside, tuple(shape)))
            label.append(good)
            weight.append(float(n))
    prior = np.array([PRIOR[n] for n in NAMES])
    w = prior.copy()
    if rows:
        x, y, m = np.array(rows), np.array(label), np.array(weight)
        for _ in range(rounds):  # Newton steps, halved until the penalised likelihood rises
            odds = x @ w
            p = 1 / (1 + np.exp(-odds))
            slope = x.T @ (m * (y - p)) - penalty * (w - prior)
            bend = (x * (m * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
            step = np.linalg.solve(bend, slope)
            value = lambda v: float(m @ (y * (x @ v) - np.logaddexp(0, x @ v)) - penalty / 2 * ((v - prior) ** 2).sum())
            size = 1.0
            while size > 1e-6 and value(w + size * step) < value(w):
                size /= 2
            w = w + size * step
    return {n: round(float(v), 4) for n, v in zip(NAMES, w, strict=True)}


def min_cut(cost: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut; of all such cuts, the one with most of them.

    A node of positive ``cost`` is joined to the source by as much, one of negative cost to the sink;
    ``edges`` are (node, node, capacity), good in both directions. Blocking flows along shortest paths.
    """
    n = len(cost)
    source, sink = [max(c, 0) for c in cost], [max(-c, 0) for c in cost]
    to: list[int] = []
    room: list[int] = []  # what an edge can still take; edge e runs back as e ^ 1
    leaving: list[list[int]] = [[] for _ in range(n)]
    for a, b, capacity in edges:
        leaving[a].append(len(to))
        leaving[b].append(len(to) + 1)
        to += [b, a]
        room += [capacity, capacity]
    while True:
        level = [0 if s else -1 for s in source]
        queue = [i for i in range(n) if source[i]]
        starts, met = len(queue), False
        for u in queue:
            met = met or sink[u] > 0
            for e in leaving[u]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if not met:
            break
        tried = [0] * n
        for s in queue[:starts]:
            path: list[int] = []
            u = s
            while source[s]:
                if sink[u]:
                    flow = min([source[s], sink[u], *(room[e] for e in path)])
                    source[s] -= flow
                    sink[u] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, u = [], s
                    continue
                out = leaving[u]
                while tried[u] < len(out) and not (room[out[tried[u]]] and level[to[out[tried[u]]]] == level[u] + 1):
                    tried[u] += 1
                if tried[u] < len(out):
                    path.append(out[tried[u]])
                    u = to[path[-1]]
                elif path:
                    u = to[path.pop() ^ 1]
                    tried[u] += 1
                else:
                    break
    # the sink's side: whatever can still send to the sink
    queue = [i for i in range(n) if sink[i]]
    kept = [s == 0 for s in sink]
    for u in queue:
        for e in leaving[u]:
            if room[e ^ 1] and kept[to[e]]:
                kept[to[e]] = False
                queue.append(to[e])
    return kept


def label(found: list[Block], weights: dict[str, float]) -> list[bool]:
    """Which blocks of a page are content."""
    w = [weights[n] for n in NAMES]
    beside = int(any(b.state == CONTENT for b in found))
    cost = [round(UNITS * sum(map(float.__mul__, _row(b.state, beside, shape_of(b)), w))) for b in found]
    strength: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}  # the latest block that stands for an element: each block has few edges, however long the page
    for k, b in enumerate(found):
        if k:
            strength[k - 1, k] = FOLLOWS * 2 / max(b.distance, 2)
        near = [(b.container, SAME_ELEMENT)] + ([] if b.container in last or b.outer == b.container else [(b.outer, NEAR_ELEMENT)])
        for element, share in near:
            if element in last:
                strength[last[element], k] = strength.get((last[element], k), 0.0) + share
            last[element] = k
    return min_cut(cost, [(a, b, round(UNITS * s)) for (a, b), s in strength.items()])


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, the main ``text`` of each page, its length and its numbers of blocks and of those kept."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page in batch.column(2).to_pylist():
                found = blocks(page or "")
                kept = list(itertools.compress((b.text for b in found), label(found, weights)))
                rows.append(("\n".join(kept), len(found), len(kept)))
            text = [r[0] for r in rows]
            yield record(
                page_id=batch.column(0), url=batch.column(1), text=pa.array(text, pa.string()), n_chars=pa.array(map(len, text), pa.int64()),
                n_blocks=pa.array([r[1] for r in rows], pa.int64()), n_kept=pa.array([r[2] for r in rows], pa.int64()),
            )

    workers_find_package(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(task, f"page_id {kind}, url string, text string, n_chars long, n_blocks long, n_kept long")
