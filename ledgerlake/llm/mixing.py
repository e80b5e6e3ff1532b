"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source x language x topic. Token weights of the
cells are raked: source, language and topic factors are adjusted in turn until
the kept tokens meet each marginal's target share, with every cell's keep
probability at most 1 (a saturated cell gives way to the others). Documents are
then drawn by their cell's calibrated probability, from a hash of doc_id, so that
a draw can be repeated and does not depend on partitions.

Targets by default flatten the observed shares (share ** temperature) of the
``MAX_SOURCES`` largest sources and ``MAX_LANGS`` languages; all others, and
nulls, are one category each; topics are flattened within their language. So the cells that reach the driver are bounded by
these parameters. Topics come from spherical k-means over hashed words,
fitted on all documents that have words.

Defined results: tokens are words and at least 1 a document, so that an empty
or null text keeps its chance; null source or language is its category;
rows of equal doc_id share a draw; an empty table gives an empty result; an
unreachable target (a category without tokens) is left out and the others
renormalised. ``mix`` keeps all columns; ``probabilities`` drops other ones.

Scale: one pass over the texts that writes a vector of 512 bytes a document before compression;
the topics' starts and rounds read these, at most 23 times, and shuffle a few thousand sums a task. Sums per cell are
partial aggregates; the probability table (bounded as above) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm._store import stored
from ledgerlake.llm._text import Run, map_runs, record

U64 = np.uint64
MAX_SOURCES, MAX_LANGS, TOPICS = 64, 32, 8
DIMENSIONS = 256
SCALE = 16384  # steps of a vector's unit length, so that sums of vectors are exact
TEMPERATURE = {"source": 0.7, "lang": 0.8, "topic": 0.8}
KEEP = 0.5
OTHER = "(other)"


def _vectors(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of hashed lower-cased word counts (square roots) in steps of 1 / SCALE, and word counts."""
    doc, start, end = run.words()
    at = (run.hashes(start, end, lower=True) >> U64(56)).astype(np.int64)
    x = np.sqrt(np.bincount(doc * DIMENSIONS + at, minlength=run.n * DIMENSIONS).reshape(run.n, DIMENSIONS))
    return np.rint(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9) * SCALE).astype(np.int16), np.bincount(doc, minlength=run.n)


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, n_tokens and x, the vector's bytes, of every document."""

    def rows(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
        x, n = _vectors(run)
        return record(doc_id=part.column(0), source=part.column(2), lang=part.column(3), n_tokens=np.maximum(n, 1).astype(np.int64), x=pa.array([v.tobytes() for v in x], pa.binary()))

    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "source", "lang")}
    return map_runs(docs, ["doc_id", "text", "source", "lang"], rows, f"doc_id {kinds['doc_id']}, source {kinds['source']}, lang {kinds['lang']}, n_tokens long, x binary")


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), np.int16).reshape(len(column), DIMENSIONS)


def _far(centres: np.ndarray):
    """Of each batch of (x, u): the document that a draw by squared distance to the centres takes first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column(0))
            away = np.maximum(1 - (x @ centres.T / SCALE).max(axis=1), 0) if len(centres) else np.ones(len(x))
            wait = -np.log(batch.column(1).to_numpy()) / np.maximum(np.where(x.any(axis=1), away, 0), 1e-12)
            first = np.lexsort([*x.T[::-1], wait])[:1] if len(x) else []
            found = [k for k in first if x[k].any() and away[k] > 1e-6]
            yield record(wait=wait[found], x=pa.array([x[k].tobytes() for k in found], pa.binary()))

    return task


def _sums(centres: np.ndarray):
    """Of each task's documents (x): per topic and dimension the sum of vectors, in whole steps."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), DIMENSIONS), np.int64)
        for batch in batches:
            x = _unpacked(batch.column(0))
            own = (x @ centres.T).argmax(axis=1)
            for k in range(len(centres)):
                total[k] += x[own == k].sum(axis=0, dtype=np.int64)
        cell = np.flatnonzero(total)
        yield record(cell=cell.astype(np.int32), total=total.ravel()[cell])

    return task


def fit_topics(found: DataFrame, topics: int = TOPICS, rounds: int = 15) -> np.ndarray:
    """Topic centres (topics, DIMENSIONS) of all documents of ``vectors`` that have words.

    Each start is drawn by squared distance to those before it (k-means++); the draw is a race of waiting
    times from hashes of doc_id, so it depends on neither partitions nor order. A round sums whole
    numbers per topic, which add up alike in any order; only these sums reach the driver.
    """
    u = (F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("topics")), F.lit(1 << 53)) + 1) / F.lit(float((1 << 53) + 1))
    drawn = found.select("x", u.alias("u"))
    chosen = np.zeros((0, DIMENSIONS))
    for _ in range(topics):
        top = drawn.mapInArrow(_far(chosen), "wait double, x binary").orderBy("wait", "x").limit(1).collect()
        if not top:
            break
        chosen = np.vstack([chosen, np.frombuffer(bytes(top[0].x), np.int16) / SCALE])
    centres = np.zeros((topics, DIMENSIONS))
    centres[np.arange(topics), np.arange(topics)] = 1.0
    centres[: len(chosen)] = chosen
    for _ in range(rounds if len(chosen) else 0):
        total = np.zeros(topics * DIMENSIONS)
        for r in found.select("x").mapInArrow(_sums(centres), "cell int, total long").groupBy("cell").agg(F.sum("total").alias("total")).collect():  # topics * DIMENSIONS at most
            total[r.cell] = r.total
        total = total.reshape(topics, DIMENSIONS)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        moved = np.round(np.where(size > 0, total / np.maximum(size, 1e-300), centres), 6)
        if (moved == centres).all():
            break
        centres = moved
    return centres


def measure(found: DataFrame, centres: np.ndarray) -> DataFrame:
    """doc_id, source, lang, topic and n_tokens of every document of ``vectors``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            topic = (_unpacked(batch.column(4)) @ centres.T).argmax(axis=1)
            yield record(doc_id=batch.column(0), source=batch.column(1), lang=batch.column(2), topic=topic.astype(np.int32), n_tokens=batch.column(3))

    kinds = {c: found.schema[c].dataType.simpleString() for c in ("doc_id", "source", "lang")}
    return found.select("doc_id", "source", "lang", "n_tokens", "x").mapInArrow(task, f"doc_id {kinds['doc_id']}, source {kinds['source']}, lang {kinds['lang']}, topic int, n_tokens long")


def _reachable(goal: np.ndarray, most: np.ndarray) -> np.ndarray:
    """``goal`` with categories limited to ``most``; what they cannot give goes to the others in proportion."""
    fixed = np.zeros(len(goal), dtype=bool)
    out = goal.copy()
    for _ in range(len(goal)):
        over = (out > most * (1 + 1e-12)) & ~fixed
        if not over.any():
            break
        fixed |= over
        out[fixed] = most[fixed]
        free = goal[~fixed].sum()
        if free > 0:
            out[~fixed] = goal[~fixed] * (goal.sum() - out[fixed].sum()) / free
    return np.minimum(out, most) if fixed.all() else out


def rake(tokens: np.ndarray, targets: list[np.ndarray], keep: float, rounds: int = 500) -> np.ndarray:
    """Keep probabilities (at most 1) of the cells of ``tokens``.

    Kept tokens add up to ``keep`` of all and to each axis's target shares. A
    category too small for its target gives half of what it could still give beyond
    ``keep``, the others the rest. A target is one share per category of its axis.
    """
    total = tokens.sum()
    factors = [np.ones(n) for n in tokens.shape]
    goals = []
    for axis, target in enumerate(targets):
        held = tokens.sum(axis=tuple(a for a in range(tokens.ndim) if a != axis))
        share = np.where(held > 0, target, 0)
        goals.append(_reachable(share / max(share.sum(), 1e-300) * keep * total, held * min(1.0, (1 + keep) / 2)))
    shape = lambda f, axis: f.reshape([-1 if a == axis else 1 for a in range(tokens.ndim)])

    def odds() -> np.ndarray:
        out = np.full(tokens.shape, keep)
        for axis, f in enumerate(factors):
            out = out * shape(f, axis)
        return out

    for _ in range(rounds):
        worst = 0.0
        for axis, goal in enumerate(goals):
            other = tuple(a for a in range(tokens.ndim) if a != axis)
            raw = odds()
            # the factor that meets the goal with cells held at 1
            for _ in range(30):
                p = np.minimum(raw * shape(factors[axis] * 0 + 1, axis), 1)
                held, fixed = (tokens * p).sum(axis=other), (tokens * (raw >= 1)).sum(axis=other)
                free = held - fixed
                step = np.where(free > 1e-9 * total, np.maximum(goal - fixed, 1e-12) / np.maximum(free, 1e-300), np.where(held > goal, goal / np.maximum(held, 1e-300), 1))
                step = np.clip(step, 0.2, 5)
                worst = max(worst, float(np.abs(step - 1).max()))
                if np.abs(step - 1).max() < 1e-10:
                    break
                factors[axis] = np.minimum(factors[axis] * step, 1e6)
                raw = odds()
        if worst < 1e-8:
            break
    return np.minimum(odds(), 1)


def probabilities(measured: DataFrame, keep: float = KEEP, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """``measured`` with ``probability``; ``targets`` may give shares per source, lang or topic."""
    axes = ("source", "lang", "topic")
    sums = stored(measured.groupBy(*axes).agg(F.sum("n_tokens").alias("tokens")), "cells")
    names: dict[str, list[str]] = {}
    for axis, most in zip(axes, (MAX_SOURCES, MAX_LANGS, TOPICS), strict=True):
        if targets and axis in targets:
            names[axis] = sorted(str(k) for k in targets[axis] if str(k) != OTHER)
        else:
            top = sums.where(F.col(axis).isNotNull()).groupBy(axis).agg(F.sum("tokens").alias("t")).orderBy(F.desc("t"), axis).limit(most)
            names[axis] = sorted(str(r[axis]) for r in top.collect())
    group = {a: F.when(F.col(a).cast("string").isin(names[a]) if names[a] else F.lit(False), F.col(a).cast("string")).otherwise(F.lit(OTHER)).alias(f"g_{a}") for a in axes}
    cells = sums.groupBy(*group.values()).agg(F.sum("tokens").alias("tokens")).collect()  # bounded by the numbers of names
    spark = measured.sparkSession
    if not cells:
        return measured.withColumn("probability", F.lit(0.0))
    place = {a: {n: k for k, n in enumerate([*names[a], OTHER])} for a in axes}
    tokens = np.zeros([len(place[a]) for a in axes])
    for r in cells:
        tokens[tuple(place[a][r[f"g_{a}"]] for a in axes)] = r.tokens
    goals = []
    for k, a in enumerate(axes):
        share = tokens.sum(axis=tuple(j for j in range(3) if j != k)) / tokens.sum()
        if targets and a in targets:
            goals.append(np.array([float({str(n): v for n, v in targets[a].items()}.get(n, 0.0)) for n in place[a]]))
        elif a == "topic":
            # flattened within each language, so that a topic of one language never contradicts the languages' targets
            within = tokens.sum(axis=0) ** TEMPERATURE[a]
            goals.append((within / np.maximum(within.sum(axis=1, keepdims=True), 1e-300) * (goals[1] / goals[1].sum())[:, None]).sum(axis=0))
        else:
            goals.append(share ** TEMPERATURE[a])
    p = rake(tokens, goals, keep)
    table = spark.createDataFrame([(*[r[f"g_{a}"] for a in axes], float(p[tuple(place[a][r[f"g_{a}"]] for a in axes)])) for r in cells], "g_source string, g_lang string, g_topic string, probability double")
    grouped = measured.select("*", *group.values())
    return grouped.join(F.broadcast(table), ["g_source", "g_lang", "g_topic"]).select("doc_id", *axes, "n_tokens", "probability")


def chosen(seed: str = "mixing"):
    """The draw of a row with doc_id and probability."""
    u = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return u < F.col("probability")


def weigh(docs: DataFrame, keep: float = KEEP, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Per document: doc_id, source, lang, topic, n_tokens, probability, chosen."""
    found = stored(vectors(docs), "vectors")
    measured = stored(measure(found, fit_topics(found)), "measured")
    return probabilities(measured, keep, targets).withColumn("chosen", chosen())


def mix(docs: DataFrame, keep: float = KEEP, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The drawn documents, with all their columns; rows without doc_id go."""
    drawn = weigh(docs, keep, targets).where("chosen").select("doc_id").distinct()
    return docs.join(drawn, "doc_id", "left_semi").select(*docs.columns)
