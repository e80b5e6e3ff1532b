"""Personal data in texts without any digit or ``@``."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from ledgerlake.llm import pii as p
from ledgerlake.llm._text import Run

NAMES = "ann bob carla dmitri eve farid gita hugo iris jonas".split()


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(2)
    rows = [(i, f"words go here in mail and on year {r.randrange(1900, 2030)} v{i}.{i}.2 id {r.randrange(10**9)}") for i in range(300)]
    for i in range(300):
        name, host = r.choice(NAMES), r.choice(NAMES)
        secret = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(14, 22)))
        rows.append((1000 + i, f"write to {name}.{host}@{host}.example.com or call +1 ({200 + i}) 555-{1000 + i} and {r.choice(['password', 'token'])}{r.choice(['=', ': '])}{secret} end"))
    return p.fit_scorer(spark.createDataFrame(rows, "doc_id long, text string"))


TEXTS = [
    "please write to jane.doe [at] example [dot] com soon",
    "please write to name(at)host.org soon",
    "then password=correcthorsebattery end",
    "and token: abcdefghijklmnop end",
    "plain words in a line",
    None,
]


def test_spans_do_not_need_a_digit_elsewhere(spark, model):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, f"{t} and more words here to be 7") for i, t in enumerate(TEXTS[:5])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in p.find_pii(frame, model).collect()}
    assert [found[i] for i in range(5)] == [p.written(p.all_spans(t, model)[1]) for t in TEXTS[:5]]
    assert all(found[i] for i in range(4)) and not found[4] and not found[5]
    assert {i: found[i] for i in range(4)} == {i: found[100 + i] for i in range(4)}
    clean = {r.doc_id: r.text for r in p.redact(frame, model).collect()}
    assert "[EMAIL]" in clean[0] and "[EMAIL]" in clean[1] and "correct" not in clean[2] and "abcdef" not in clean[3]
    assert clean[4] == TEXTS[4] and clean[5] is None


def test_prefilter_keeps_every_candidate():
    r = random.Random(1)
    parts = ["[at]", "(at)", "(at]", "at", "]", "(", "password", "PwD", "paſſword", "toKen", "apiKey", "api_key", "=", ":", " ", '"', "abcdefgh", "x-y_z", "é", "\n", "secret", ".", "correcthorse", "7", "@"]
    for _ in range(60):
        texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 9))) for _ in range(200)]
        for text, marked in zip(texts, p._marked(Run(pa.array(texts))), strict=True):
            assert bool(marked) == bool(re.search(p.POSSIBLE, text)), text
            assert marked or not (p.candidates(text) or p.base_spans(text)), text


def test_documents_without_digits_are_fitted_on(spark):
    rows = [(i, f"some words and password={'abcdefghij' * 2}{NAMES[i % 10]} here unquestionablylongword{NAMES[i % 7]}") for i in range(200)]
    assert p.fit_scorer(spark.createDataFrame(rows, "doc_id long, text string"))["trees"]
