"""Toxicity: a linear classifier held even under swaps of identity terms.

A document's features are the hashed words and word beginnings (4 to 6 bytes)
that it holds, A-Z lower-cased; how often does not matter. A logistic model is
fitted on labelled documents with a counterfactual penalty: wherever a sentence
names a group, the name is swapped for every other of its list, and the squared
change of the score is added to the loss. A neutral mention of a group then
hardly moves a score, whichever group it is.

``fit_classifier`` uses at most ``FIT_DOCUMENTS`` labelled documents, half of them of each
label where there are as many, those of smallest hashed id; class shares are
weighted back. Scoring covers every word of every document.

Defined results: null and empty texts get the intercept's score; repeated rows
score alike; a document labelled twice counts as toxic if any label says so;
null labels are ignored; without labels of both kinds every score is 0.
Labels, language, source and doc_id are never features. Other columns are
dropped by ``score`` and kept by ``drop_toxic``.

Scale: scoring is one pass without shuffle; the model is one sparse vector of
at most ``MAX_FEATURES`` weights. The fit's sample reaches the driver as hashed
numbers, bounded by FIT_DOCUMENTS documents of at most FIT_WORDS distinct features each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm._text import Run, map_runs, mix, record

U64 = np.uint64
FIT_DOCUMENTS = 6000
FIT_WORDS = 20000
MAX_FEATURES = 1 << 14
MIN_CHI = 25.0  # features whose presence hardly tells the classes apart are chance
SPACE_BITS = 20
PREFIXES = (4, 5, 6)
THRESHOLD = 0.5
COUNTERFACTUAL = 2.0
# Names of groups that a neutral sentence may mention, by language.
IDENTITY_TERMS = (
    "women men girls boys gay lesbian straight transgender muslim jewish christian hindu atheist black white asian latino immigrants refugees disabled deaf blind elderly young".split(),
    "frauen männer mädchen jungen schwule lesben muslime juden christen schwarze weiße asiaten einwanderer flüchtlinge behinderte alte".split(),
    "femmes hommes filles garçons gays lesbiennes musulmans juifs chrétiens noirs blancs asiatiques immigrés réfugiés handicapés vieux".split(),
    "mujeres hombres chicas chicos gays lesbianas musulmanes judíos cristianos negros blancos asiáticos inmigrantes refugiados discapacitados ancianos".split(),
)


def _hashed(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every word and word beginning, with repeats."""
    doc, start, end = run.words()
    shift = U64(64 - SPACE_BITS)
    docs, found = [doc], [run.hashes(start, end, lower=True) >> shift]
    for k in PREFIXES:
        some = end - start >= k
        docs.append(doc[some])
        found.append(mix(run.hashes(start[some], start[some] + k, lower=True) + U64(k)) >> shift)
    return np.concatenate(docs), np.concatenate(found).astype(np.int64)


def _held(run: Run, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature); only features marked in ``some``, if given."""
    doc, found = _hashed(run)
    if some is not None:
        keep = some[found]
        doc, found = doc[keep], found[keep]
    key = np.unique((doc << SPACE_BITS) | found)
    return key >> SPACE_BITS, key & ((1 << SPACE_BITS) - 1)


def term_features(term: str) -> np.ndarray:
    return np.unique(_hashed(Run(pa.array([term])))[1])


def fit_classifier(docs: DataFrame, labels: DataFrame, bound: int = FIT_DOCUMENTS, counterfactual: float = COUNTERFACTUAL, rounds: int = 150) -> dict:
    """Weights of the features, from documents (doc_id, text) and labels (doc_id, toxic)."""
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity"))
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    none = {"index": [], "weight": [], "bias": -40.0}
    if not sizes.get(0) or not sizes.get(1):
        return none
    picks = known.where("toxic = 1").orderBy(order, "doc_id").limit(bound // 2).unionByName(known.where("toxic = 0").orderBy(order, "doc_id").limit(bound - min(sizes[1], bound // 2)))
    sample = docs.select("doc_id", "text").join(F.broadcast(picks), "doc_id")

    def held(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        doc, found = _held(run)
        cut = np.searchsorted(doc, np.arange(run.n + 1))
        rows = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            f = found[a:b]
            rows.append((f if len(f) <= FIT_WORDS else f[:: -(-len(f) // FIT_WORDS)]).astype(np.int32).tobytes())
        return record(toxic=part.column(2).cast(pa.int32()), held=pa.array(rows, pa.binary()))

    got = sorted(((r.toxic, bytes(r.held)) for r in map_runs(sample, ["doc_id", "text", "toxic"], held, "toxic int, held binary").collect()))
    y = np.array([t for t, _ in got], dtype=float)
    if len(set(y.tolist())) < 2:
        return none
    rows = [np.frombuffer(h, np.int32) for _, h in got]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows)
    del rows, got
    # the features whose presence differs most between the classes
    weight = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (1 - y).sum())
    weight *= len(y) / weight.sum()
    n1, n0 = y.sum(), (1 - y).sum()
    c1, c0 = np.bincount(col, weights=y[row], minlength=1 << SPACE_BITS), np.bincount(col, weights=1 - y[row], minlength=1 << SPACE_BITS)
    all_ = c1 + c0
    expected = all_ * n1 / (n1 + n0)
    chi = np.where(all_ >= 3, (c1 - expected) ** 2 / np.maximum(expected * (1 - all_ / (n1 + n0)), 0.3), 0)
    pairs = [(term_features(a), term_features(b)) for terms in IDENTITY_TERMS for a in terms for b in terms if a < b]
    best = np.argsort(-chi, kind="stable")[: MAX_FEATURES // 2]
    chosen = np.unique(np.concatenate([best[chi[best] >= MIN_CHI], *[t for p in pairs for t in p]]))
    place = np.full(1 << SPACE_BITS, -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[col] >= 0
    row, col = row[keep], place[col[keep]]
    size = len(chosen)
    # swap pairs: how often a labelled sentence names the term, at least once
    named = np.bincount(col, minlength=size)
    swaps = [(place[a], place[b], 1.0 + (named[place[a]].min() + named[place[b]].min()) / 2) for a, b in pairs]
    from_ = np.concatenate([np.full(len(a), k) for k, (a, _, _) in enumerate(swaps)] + [np.full(len(b), k) for k, (_, b, _) in enumerate(swaps)])
    sign = np.concatenate([np.ones(len(a)) for a, _, _ in swaps] + [-np.ones(len(b)) for _, b, _ in swaps])
    at = np.concatenate([a for a, _, _ in swaps] + [b for _, b, _ in swaps])
    times = np.array([c for _, _, c in swaps])
    w, bias, gsum, bsum, ridge = np.zeros(size), -2.0, np.full(size, 1e-6), 1e-6, 0.05
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, weights=w[col], minlength=len(y)), -40, 40)))
        error = (p - y) * weight
        change = np.bincount(from_, weights=sign * w[at], minlength=len(swaps))
        g = np.bincount(col, weights=error[row], minlength=size) + ridge * w + 2 * counterfactual * np.bincount(at, weights=sign * (times * change)[from_], minlength=size)
        gsum += g * g
        w -= 0.5 * g / np.sqrt(gsum)
        bsum += error.sum() ** 2
        bias -= 0.5 * error.sum() / np.sqrt(bsum)
    big = np.abs(w) >= 1e-4
    return {"index": chosen[big].tolist(), "weight": np.round(w[big], 6).tolist(), "bias": round(float(bias), 6)}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_runs(docs, ["doc_id", "text"], _scores(model, lambda part, p: record(doc_id=part.column(0), score=p)), f"doc_id {kind}, score double", setup=_weights(model))


def drop_toxic(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is under ``threshold``, with all their columns."""
    return map_runs(docs, docs.columns, _scores(model, lambda part, p: part.filter(pa.array(p < threshold))), docs.schema, setup=_weights(model))


def _weights(model: dict):
    index, weight = np.array(model["index"], dtype=np.int64), np.array(model["weight"])

    def setup() -> np.ndarray:
        w = np.zeros(1 << SPACE_BITS)
        w[index] = weight
        return w

    return setup


def _scores(model: dict, result):
    bias = model["bias"]

    def scored(part: pa.RecordBatch, run: Run, w: np.ndarray) -> pa.RecordBatch:
        doc, found = _held(run, w != 0)
        logit = bias + np.bincount(doc, weights=w[found], minlength=run.n)
        return result(part, 1 / (1 + np.exp(-np.clip(logit, -40, 40))))

    return scored
