from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import periodic_runs
from ledgerlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w: list) -> int:
    """By the border table of the whole list."""
    border = [0] * len(w)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = border[k - 1]
        k += w[i] == w[k]
        border[i] = k
    return len(w) - (border[-1] if w else 0)


def runs_brute(w: list) -> list[tuple[int, int, int]]:
    """Every lag, every maximal stretch that agrees with itself, kept if the lag is its smallest period."""
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and smallest_period(w[i : i + length]) == q:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_brute(w: list, runs) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted_brute(doc_id, text) -> list:
    w = WORD.findall(text or "")
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def digest(lines: str) -> str:
    return hashlib.sha256(lines.encode()).hexdigest()


def shapes() -> list[str | None]:
    r = random.Random(11)
    out = [None, "", " \n\t", "x " * 23, "x " * 24, "x " * 25, "x\n" * 3000, "a b " * 11 + "a", "a b " * 12, "a b c d e f g h " * 3, "a b c d e f g h i " * 3]
    for _ in range(150):  # few different words, so that runs meet and overlap
        out.append(" ".join(r.choice("ab") for _ in range(r.randrange(1, 300))))
    for _ in range(150):
        root = [str(r.randrange(60)) for _ in range(r.randrange(1, 80))]
        times = r.choice([2, 3, 3, 4, 9])
        body = (root * (times + 1))[: times * len(root) + r.choice([-1, 0, 1, len(root) // 2])]
        if r.random() < 0.3 and len(body) > 5:
            body[r.randrange(len(body))] = "odd"
        out.append(" ".join([*(f"p{k}" for k in range(r.randrange(5))), *body, *body[: r.randrange(9)], *(f"s{k}" for k in range(r.randrange(5)))]))
    inner = (["u", "v"] * 20 + ["w"]) * 5  # runs within a run
    out += [" ".join(inner), " ".join(inner * 3 + ["z"] + inner), " ".join(["k"] * 40 + ["m"] * 40) + " k" * 40]
    fib = ["a", "ab"]
    while len(fib[-1]) < 1200:
        fib.append(fib[-1] + fib[-2])
    return [*out, " ".join(fib[-1]), " ".join(fib[-1] * 3)]


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(shapes())]


def test_runs_and_collapsed_text(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in periodic_runs.find_runs(docs).collect()}
    assert set(found) == {i for i, _ in rows}
    some = 0
    for i, text in rows:
        w = WORD.findall(text or "")
        runs = runs_brute(w) if len(set(w)) > 1 or len(w) < 100 else ([(0, len(w), 1)] if w else [])
        some += len(runs)
        assert [tuple(x) for x in found[i].runs] == runs, (i, text)
        assert found[i].collapsed == collapsed_brute(w, runs)
        assert found[i].n_words == len(w)
    assert some > 150


def test_query_matches_brute_force(spark, tmp_path, rows, corpus):
    more = [(1000 + i, t) for i, t in corpus if t is None or len(t) < 20_000] + [(None, "a b c " * 20), (None, None), (7, "q " * 30), (7, "q " * 30)]
    rows = [*rows, *more]
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in rows], "doc_id long, text string, runs string, length int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = []
    planted = 0
    for i, text in rows:
        w = planted_brute(i, text)
        planted += w != WORD.findall(text or "")
        runs = runs_brute(w) if len(set(w)) > 1 or len(w) < 100 else [(0, len(w), 1)]
        best = (None,) * 4
        if runs:
            top = runs[0]
            for s, n, q in runs:
                left, right = n * top[2], top[1] * q
                if left > right or (left == right and (s, q) < (top[0], top[2])):
                    top = (s, n, q)
            best = (*top, 1000 * top[1] // top[2])
        want.append((i, len(runs), *best, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(collapsed_brute(w, runs))))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert planted > 10
    assert sorted((tuple(r) for r in got.select(got.columns[:8]).collect()), key=key) == sorted(want, key=key)


def test_one_repeated_word_stays_linear(spark):
    """200,000 equal words have 2e10 pairs of equal grams; one run comes back at once."""
    docs = spark.range(1).select(F.lit(1).alias("doc_id"), F.repeat(F.lit("w "), 200_000).alias("text"))
    row = periodic_runs.find_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(0, 200_000, 1)] and row.collapsed == "w"


def test_nothing(spark, no_docs):
    assert periodic_runs.digests(periodic_runs.find_runs(no_docs)).count() == 0
    assert periodic_runs.planted(no_docs).count() == 0
