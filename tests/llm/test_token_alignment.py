from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import pair_bitmaps, token_alignment
from ledgerlake.llm._text import Run
from ledgerlake.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
CONTRACT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def odd_texts() -> list[str | None]:
    r = random.Random(3)
    some = [None, "", " ", "  ", "\n", "\t x", "a\r\nb {\r\n}", "x ▁ y", "▁", "<s> </s> <unk> <0x0A> <|endoftext|> b", "a\x00b", "é è   ñ", "字字 字　x", "😀 😀😀", "don't we'll I'D", "12345 678,90", "      deep", "end   ", "ﬁ Å é", "a\x1cb\x1d c", " x", "same same same " * 50]
    for _ in range(250):
        some.append("".join(r.choice(["a", "th", "é", " ", "  ", "\n", "\r", "\t", ".", "'s", "9", "字", "😀", "_", "ou", " the", " ", "<", ">", "s"]) for _ in range(r.randrange(1, 60))))
    return some


def plain(rows):
    """Every token of every whole text, every overlapping pair, one by one."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in seen} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in seen)}
    out, counts, docs = [], Counter(), defaultdict(set)
    for n, (doc_id, text) in enumerate(rows):
        links, groups, ia, ib = Counter(), [], [], []
        if text:
            ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
            bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
            whole = (" " + text).encode()
            if b"".join(ba) != whole or b"".join(bb) != whole:
                ia, ib = [], []
            else:
                spans = []
                for side in (ba, bb):
                    at, found = 0, []
                    for t in side:
                        found.append((at, at + len(t)))
                        at += len(t)
                    spans.append(found)
                j = 0
                for i, (s, e) in enumerate(spans[0]):
                    while spans[1][j][1] <= s:
                        j += 1
                    k = j
                    while k < len(ib) and spans[1][k][0] < e:
                        links[ia[i], ib[k]] += 1
                        k += 1
                cut, ga, gb = {e for _, e in spans[0]} & {e for _, e in spans[1]}, 0, 0
                for e in sorted(cut):
                    left, right = [], []
                    while ga < len(ia) and spans[0][ga][1] <= e:
                        left.append(str(ia[ga]))
                        ga += 1
                    while gb < len(ib) and spans[1][gb][1] <= e:
                        right.append(str(ib[gb]))
                        gb += 1
                    groups.append(",".join(left) + "|" + ",".join(right))
        counts.update(links)
        for p in links:
            docs[p].add(n)
        out.append((doc_id, len(ia), len(ib), groups, links))
    top = {}
    for (_, y), c in counts.items():
        top[y] = max(top.get(y, 0), c)
    rows = []
    for doc_id, na, nb, groups, links in out:
        text = ";".join(groups)
        best = sum(c for p, c in links.items() if counts[p] == top[p[1]])
        rows.append((doc_id, na, nb, len(groups), sum(links.values()), best, sum(c * counts[p] for p, c in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else "", text))
    return rows, counts, docs, top


@pytest.fixture(scope="module")
def rows(corpus):
    odd = [(10_000 + i, t) for i, t in enumerate(odd_texts())]
    return [*corpus, *odd, (None, "no id"), (None, None), (5, "twice here"), (5, "twice here")]


def test_query_matches_plain_version(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(token_alignment, "TASKS_A_PART", 2)  # several parts and salts on a small table
    docs = spark.createDataFrame([(t, i, 5, "x") for i, t in rows], "text string, doc_id long, n_a int, part string")
    docs.repartition(13).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_token_alignment"](spark, str(tmp_path)).select(CONTRACT).collect()
    want, _, _, _ = plain(rows)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((r[:8] for r in want), key=key)
    assert sum(r[1] == 0 for r in want) == 8 and sum(r[5] for r in want) > 1000


def test_pair_counts_and_groups(spark, rows):
    found = token_alignment.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), A, B, with_groups=True)
    want, counts, docs, top = plain(rows)
    got = {(r.a, r.b): (r.n_docs, r.n_links, r.best) for r in found.pair_counts().collect()}
    assert got == {p: (len(docs[p]), c, c == top[p[1]]) for p, c in counts.items()}
    texts = sorted((str(r.doc_id), r.groups or "") for r in found.documents().collect())
    assert texts == sorted((str(r[0]), r[8]) for r in want)


def test_small_flushes_give_the_same(spark, rows, monkeypatch):
    """Bitmaps of one container that arrive in several pieces merge."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = sorted(map(str, token_alignment.align(docs, A, B).documents().collect()))

    def small(batch, column="text"):
        from ledgerlake.llm._text import slices

        return slices(batch, column, 500)

    monkeypatch.setattr(token_alignment, "FLUSH_LINKS", 50)
    monkeypatch.setattr(token_alignment, "slices", small)
    assert sorted(map(str, token_alignment.align(docs, A, B).documents().collect())) == want


def test_full_cache_starts_anew(monkeypatch):
    texts = [" " + t for t in odd_texts() if t]
    aligner = token_alignment.Aligner(A, B)
    live = np.ones(1, dtype=bool)
    want = [aligner.align(Run(pa.array([t])), live) for t in texts]
    monkeypatch.setattr(token_alignment, "CACHE_UNITS", 5)
    for t, (stats, groups, _, pair) in zip(texts, want, strict=True):
        again = aligner.align(Run(pa.array([t])), live)
        assert (again[0] == stats).all() and again[1] == groups and sorted(again[3]) == sorted(pair)
    assert len(aligner.place) < 300


def test_nothing(spark, no_docs):
    found = token_alignment.align(no_docs, A, B)
    assert found.documents().count() == 0 and found.pair_counts().count() == 0


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, token_alignment.align(docs, A, B).documents().drop("groups").collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_bitmaps_round_trip():
    r = np.random.Generator(np.random.PCG64(1))
    for n, keys, docs in ((0, 1, 1), (1, 1, 1), (5000, 3, 9000), (5000, 4000, 1 << 31), (60_000, 2, 40_000)):
        key = r.integers(0, keys, n).astype(np.uint64)
        entry, times = np.unique((key << np.uint64(32)) | r.integers(0, docs, n).astype(np.uint64), return_counts=True)
        times = times * r.integers(1, 70, len(times))
        half = r.random(len(entry)) < 0.5
        packs = [pair_bitmaps.pack(pair_bitmaps.planes_of(entry[m], times[m])) for m in (half, ~half, half)]
        planes = pair_bitmaps.merged(packs)
        for x, y in zip(planes, pair_bitmaps.planes_of(entry, times), strict=True):
            assert (x == y).all()
        found = pair_bitmaps.counts(planes)
        uniq = np.unique(entry >> np.uint64(32))
        assert (found[0] == uniq).all()
        assert found[1].tolist() == [int((entry >> np.uint64(32) == u).sum()) for u in uniq]
        assert found[2].tolist() == [int(times[entry >> np.uint64(32) == u].sum()) for u in uniq]
        value = r.integers(0, 1 << 40, len(uniq))
        number, (total,) = pair_bitmaps.sums(planes, uniq, [value])
        want: dict[int, int] = {}
        for e, t in zip(entry.tolist(), times.tolist(), strict=True):
            want[e & 0xFFFFFFFF] = want.get(e & 0xFFFFFFFF, 0) + t * int(value[np.searchsorted(uniq, np.uint64(e >> 32))])
        assert dict(zip(number.tolist(), total.tolist(), strict=True)) == want


def test_hot_pair_is_bits(spark):
    """A pair that all documents hold costs about a bit a document."""
    entry = (np.uint64(7) << np.uint64(32)) | np.arange(1 << 16, dtype=np.uint64)
    assert len(pair_bitmaps.pack([entry])) < (1 << 16) / 8
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the the").alias("text"))
    assert {r.n_docs for r in token_alignment.align(docs, A, B).pair_counts().collect()} == {3000}
