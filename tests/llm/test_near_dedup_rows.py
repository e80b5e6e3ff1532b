"""drop_near_duplicates decides by row: repeated and null doc_ids."""

from __future__ import annotations

from ledgerlake.llm import near_dedup as n

WORDS = [f"w{k}" for k in range(80)]
COPIED = " ".join(WORDS)
NEAR = " ".join([*WORDS[:-1], "end"])
CLEAN, LONE = " ".join(f"x{k}" for k in range(30)), " ".join(f"y{k}" for k in range(30))


def kept(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "doc_id long, text string, component string").repartition(parts)
    out = n.drop_near_duplicates(frame)
    assert out.schema == frame.schema
    return sorted(map(tuple, out.collect()), key=str)


def test_clean_text_of_a_repeated_id_stays(spark):
    rows = [(3, COPIED, "a"), (7, CLEAN, "b"), (7, NEAR, "c")]
    assert kept(spark, rows) == [(3, COPIED, "a"), (7, CLEAN, "b")]


def test_null_ids_without_copies_stay(spark):
    rows = [(None, LONE, "a"), (None, COPIED, "b"), (None, NEAR, "c"), (9, COPIED, "d"), (None, None, "e"), (None, " ", "f"), (4, "", "g"), (4, "", "g"), (4, None, "h")]
    assert kept(spark, rows) == sorted([(None, LONE, "a"), (9, COPIED, "d"), (None, None, "e"), (None, " ", "f"), (4, "", "g"), (4, None, "h")], key=str)


def test_ties_have_one_result(spark):
    rows = [(5, NEAR, "z"), (5, COPIED, "y"), (5, COPIED, "x"), (None, CLEAN, "q"), (None, CLEAN, "p")]
    want = sorted([(5, min(COPIED, NEAR), "z" if NEAR < COPIED else "x"), (None, CLEAN, "p")], key=str)
    assert kept(spark, rows, 1) == want
    assert kept(spark, rows[::-1], 4) == want


def test_rows_without_rivals_are_not_compared(spark):
    """Only groups of several rows write texts, and their JSON, to the last grouping."""
    words = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(12)]
    rows = [(i, w, "a") for i, w in enumerate(words)] + [(3, words[3], "b"), (50, words[4], "a"), (51, "", "a"), (51, "", "b"), (None, " ", "c")]
    out = n.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    expected = [(i, w, "a") for i, w in enumerate(words)] + [(51, "", "a"), (None, " ", "c")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") and any("Filter" in line and "alone" in line for line in plan.splitlines())
