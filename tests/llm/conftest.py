from __future__ import annotations

import random

import pytest

# Texts with every awkward shape: null, empty, blank, few words, odd white space, repeats, copies, very long.
WORDS = "the of and ti on Re ha nd St inga éaux öß ñas 字 Loser x1 a-b 42 #! &".split()


def texts() -> list[str | None]:
    r = random.Random(5)
    prose = [" ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(r.randrange(1, 160))) for _ in range(40)]
    edited = []
    for t in prose[:12]:
        w = t.split()
        if len(w) > 20:
            w[r.randrange(len(w))] = "edit"
        edited.append(" ".join(w))
    passage = " ".join(f"shared{k}" for k in range(70))
    odd = [None, "", " \n\t ", "one", "one two three", "\n\n\n", "line one\nline one\n\n line one\nx", "a\x0bb\x0cc\rd\u00a0e \u2003f", "same " * 60, "a b c d e " * 30, "#" * 50 + " $ | <tag>", "é" * 300, "\n".join(["x y z w v u"] * 9)]
    mixed = [f"{prose[k]} {passage} {prose[k + 1]}" for k in range(6)]
    long = " ".join(str(r.randrange(3000)) for _ in range(30000))
    return [*odd, *prose, *edited, *mixed, *prose[:5], *prose[:5], "same " * 60, long, long + " tail", None]


@pytest.fixture(scope="session")
def corpus() -> list[tuple[int, str | None]]:
    """(doc_id, text) with gaps in the ids and in no order."""
    rows = [(3 * i + 1, t) for i, t in enumerate(texts())]
    random.Random(9).shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with further columns whose names clash with the operators' own."""
    rows = [(t, i, "en", "src1", 7, 1.0, "x", 3) for i, t in corpus]
    schema = "text string, doc_id long, lang string, source string, n_chars long, score double, kept string, n_words int"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
