from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import pack_brute
from tokenizers import Tokenizer

from ledgerlake.llm import packing as p
from ledgerlake.llm._text import Run
from ledgerlake.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    return t


def test_round_trip(docs, corpus, tokenizer, monkeypatch):
    monkeypatch.setattr(p, "RANK_BLOCK", 3)
    pack_brute(p.pack(docs, tokenizer_path()).collect(), corpus, tokenizer)


def test_sample_tables_have_little_padding(spark, tokenizer):
    d = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert pack_brute(QUERIES["op6_packing"](spark, d).collect(), texts, tokenizer) > 0.98


def test_units_encode_alike_anywhere(tokenizer):
    r = random.Random(8)
    parts = [" ", "  ", "\n", "\t", "a", "don't", "'s", "42", "é", " ", " ", "’s", "\x1c", "<|endoftext|>", "!!", "字", "\r\n", "we'll", "　x", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 30))) for _ in range(800)] + ["", " ", "a ", " a"]
    known = p.Units(tokenizer_path())
    for k in range(0, len(texts), 100):
        some = texts[k : k + 100]
        ids, counts = known.encode(Run(pa.array(some)))
        cut = np.concatenate([[0], np.cumsum(counts)])
        for t, a, b in zip(some, cut[:-1], cut[1:], strict=True):
            assert ids[a:b].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0], repr(t)


def test_patterns_hold_the_histogram():
    r = random.Random(2)
    for _ in range(40):
        histogram = {r.randrange(1, 1025): r.randrange(1, 3000) for _ in range(r.choice([1, 5, 300]))}
        patterns = p.shortest_pack_first(histogram)
        held = Counter()
        for count, lengths in patterns:
            assert count > 0 and sum(lengths) <= 1024
            for k in lengths:
                held[k] += count
        assert held == Counter(histogram)
        assert len(patterns) < 6000


def test_with_ids(docs):
    rows = p.pieces(docs, tokenizer_path(), with_ids=True).collect()
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_empty_repeated_and_null_ids(spark, no_docs):
    assert p.pack(no_docs, tokenizer_path()).count() == 0
    rows = p.pack(spark.createDataFrame([(None, "a b"), (None, "a b"), (4, "c")], "doc_id long, text string"), tokenizer_path()).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_special_strings_as_the_tokenizer_file_has_them(spark):
    """The contract's call, on whole texts."""
    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|>\n<|endoftext|>", "<|endoftext", " <|endoftext|> a"]
    rows = p.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tokenizer_path(), with_ids=True).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: [*plain.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert [64, 220, 50256, 275, 0] in [r.ids for r in rows]
