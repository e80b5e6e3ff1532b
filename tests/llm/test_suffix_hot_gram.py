"""A gram of very many distinct stretches is not sorted as one text."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest

from ledgerlake.llm import suffix_dedup as s
from ledgerlake.llm._text import Run


def bucket(texts: list[str]) -> pa.Table:
    """What one bucket gets from these texts, all grams held to be shared; a text's row is its number."""
    part = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)), pa.int64())], names=["text", "row"])
    run = Run(part.column(0))
    _, doc, gram = s.windows(run)
    at: list[list[int]] = [[] for _ in texts]
    for d, g in sorted(set(zip(doc.tolist(), gram.tolist(), strict=True))):
        at[d].append(g - int(run.offsets[d]))
    marked = pa.RecordBatch.from_arrays([*part.columns, pa.array(at, pa.list_(pa.int64()))], names=["text", "row", "marks"])
    return pa.Table.from_batches([s._stretches_of(1)(marked, run)])


def brute(texts: list[str]) -> set[tuple[int, int]]:
    raw = [t.encode() for t in texts]
    seen = Counter(b[k : k + s.LENGTH] for b in raw for k in range(len(b) - s.LENGTH + 1))
    return {(i, k + x) for i, b in enumerate(raw) for k in range(len(b) - s.LENGTH + 1) if seen[b[k : k + s.LENGTH]] > 1 for x in range(s.LENGTH)}


@pytest.mark.parametrize("line", [45, 130, 185, 230])
def test_hot_line_in_differing_contexts(line, monkeypatch):
    """Most contexts differ, some repeat near the line, on one side or both; the sorted texts stay small and nothing is missed."""
    r = random.Random(line)
    noise = lambda n: "".join(r.choice("abcdé ") for _ in range(n))
    hot, ends = noise(line), [noise(260) for _ in range(6)]
    texts = [noise(260 - k % 7) + hot + noise(260) for k in range(150)]
    texts += [noise(300) + ends[r.randrange(6)][r.randrange(200) :] + hot + ends[r.randrange(6)][: r.randrange(260)] + noise(20) for _ in range(100)]
    texts += [noise(220) + texts[3][100:420] + noise(220), "xy" * 300, texts[5]]
    sorted_bytes = []
    order = s.suffix_order
    monkeypatch.setattr(s, "PART", 4096)
    monkeypatch.setattr(s, "suffix_order", lambda text, *a: sorted_bytes.append(len(text)) or order(text, *a))
    out = s._covered(bucket(texts))
    got = {(i, x) for i, a, b in zip(*(c.to_pylist() for c in out.columns), strict=True) for x in range(a, b)}
    assert got == brute(texts)
    assert max(sorted_bytes) < 2 * 4096


def test_longer_grams_of_windows():
    """Equal windows have equal grams of any length; one of the window's length is the window."""
    r = random.Random(4)
    shared = "".join(r.choice("ab ") for _ in range(240))
    run = Run(pa.array(["c" * 30 + shared, shared + "d" * 50]))
    for length in (40, 120, 199, 200):
        start, doc, gram = s.windows(run, length)
        assert (gram >= start).all() and (gram + length <= start + s.LENGTH).all()
        first, second = (gram - start)[(doc == 0) & (start >= 30)], (gram - start)[(doc == 1) & (start < run.offsets[1] + 41)]
        assert len(first) == 41 and (first == second).all()
