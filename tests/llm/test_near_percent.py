"""Thresholds other than the default, and the pipeline's own of 80 percent."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from brute import shingle_set

from ledgerlake.llm import near_dedup as n


def pairs_of(percent_low: int, percent_high: int, count: int, seed: int) -> list[tuple[int, str]]:
    """Pairs of texts (2k, 2k + 1) whose similarity is within the bounds."""
    r = random.Random(seed)
    rows: list[tuple[int, str]] = []
    while len(rows) < 2 * count:
        words = [f"w{r.randrange(10**6)}" for _ in range(r.randrange(60, 300))]
        other = list(words)
        for _ in range(r.randrange(1, 30)):
            other[r.randrange(len(other))] = f"e{r.randrange(10**6)}"
        a, b = shingle_set(" ".join(words)), shingle_set(" ".join(other))
        if percent_low <= 100 * len(a & b) / len(a | b) < percent_high:
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    return rows


def brute(rows: list[tuple[int, str]], percent: int) -> dict[int, int]:
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_links_at_other_thresholds(spark, percent):
    rows = pairs_of(percent, percent + 4, 120, percent) + [(1000 + i, t) for i, t in pairs_of(percent - 5, percent, 60, percent + 1)]
    got = {r.doc_id: r.component_id for r in n.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()}
    assert got == brute(rows, percent)


def test_pipeline_stage_drops_copies_of_80_percent(spark):
    import corpus_pipeline

    rows = pairs_of(80, 85, 60, 3) + [(1000 + i, t) for i, t in pairs_of(70, 80, 30, 4)]
    out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, top in brute(rows, 80).items() if i == top)


def test_bands_and_sketch_follow_percent():
    assert n.banding(85) == (25, 5) and n.sketch_bits(85) == 28
    for percent in range(15, 101):
        bands, rows = n.banding(percent)
        assert bands * rows <= n.SLOTS and (1 - (percent / 100) ** rows) ** bands <= n.MISS
        p = (1 - percent / 100) / 2
        assert n.sketch_bits(percent) + 1 > n.SLOTS * p + 6 * (n.SLOTS * p * (1 - p)) ** 0.5
    for percent in (0, 5, 101):
        with pytest.raises(ValueError):
            n.banding(percent)


def test_whole_pipeline_against_plain_versions_at_80(spark, tmp_path_factory, monkeypatch):
    """test_pipeline's comparison of all stages, with its brute force at the stage's threshold."""
    import corpus_pipeline
    import test_pipeline

    def near(rows, percent=80):
        rows = list(rows)
        return {i: (len(shingle_set(dict(rows)[i])), top, i == top) for i, top in brute(rows, 80).items()}

    monkeypatch.setattr(test_pipeline, "near_brute", near)
    test_pipeline.test_stages_and_run(spark, corpus_pipeline, tmp_path_factory)
