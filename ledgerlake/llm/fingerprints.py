"""Document fingerprints from closed syncmers.

Native: DataFrame and SQL functions only.

A text is a sequence of units: pairs of neighbouring words, and, where a text is short
or has few words, grams of ``CHARS`` characters. ``SPAN`` neighbouring
units make a k-mer; it is an anchor (a closed syncmer) if its least unit, by hash, is its
first or its last. Whether a k-mer is an anchor depends on itself alone, so
an edit disturbs only the anchors it touches. An anchor's entry hashes its
content and the distance to the next anchor: entries match where equal
anchors stand at equal distances, wherever in the texts. The fingerprint is the
``KEEP`` smallest entries of each kind of unit, a bottom-k sketch of all of them;
likeness is the Jaccard similarity that two sketches show, the greater of
the two kinds.

The edited text of a document has its last quarter replaced from the next
document by doc_id. Next documents are found without a global sort: documents are
dealt into ranges of doc_id (approximate percentiles), ``lead`` works within a range,
and each range also receives the first document of the following one.

Defined results: a null text is empty; an empty text has an empty
fingerprint, which is like itself (1) and nothing else (0); a text without
any anchor is its own single entry; null doc_ids come last, ties are in order of
text; a single document is its own next one; other columns are dropped.

Scale: one shuffle of texts and sketches by range of doc_id; ranges follow the
number of shuffle partitions (only their bounds reach the driver); nothing grows with
the size of a group of equal or similar texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPAN = 7  # units of a k-mer: 8 words, or 12 characters
CHARS = 6
KEEP = 128
SHORT_CHARS, FEW_WORDS = 600, 40  # grams of characters for texts shorter than this, or with longer words on average
MAX_LONG = (1 << 63) - 1


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _positions(units: str, taken: int) -> Column:
    """0 .. size - taken, or nothing."""
    size = F.size(F.col(units))
    return F.when(size >= taken, F.sequence(F.lit(0), size - taken)).otherwise(F.array().cast("array<int>"))


def _anchor(units: str):
    """Whether the k-mer at a position has its least unit at an edge."""

    def test(i: Column) -> Column:
        u = [F.get(F.col(units), i + k) for k in range(SPAN)]
        return F.least(u[0], u[-1]) == F.least(*u)

    return test


def _entry(units: str, anchors: str):
    """The entry of the j-th anchor: its units and the way to the next anchor."""

    def value(j: Column) -> Column:
        at = F.get(F.col(anchors), j)
        return F.xxhash64(*[F.get(F.col(units), at + k) for k in range(SPAN)], F.coalesce(F.get(F.col(anchors), j + 1), at) - at)

    return value


def with_fingerprint(frame: DataFrame, text: str, words: str, chars: str) -> DataFrame:
    """Adds the two sketches of column ``text`` as sorted arrays ``words`` and ``chars``.

    Intermediate arrays are columns of their own, so that each is computed once.
    """
    kept = frame.columns
    pair = lambda i: F.xxhash64(F.get("_hash", i), F.get("_hash", i + 1))
    gram = lambda i: F.xxhash64(*[F.get("_char", i + k) for k in range(CHARS)])
    frame = frame.withColumn("_hash", F.transform(F.filter(F.split(text, SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)))
    length = F.char_length(text)
    by_char = (length < SHORT_CHARS) | (F.size("_hash") * FEW_WORDS < length)
    frame = frame.withColumn("_char", F.when(by_char & (length > 0), F.filter(F.split(text, ""), lambda c: c != "")).otherwise(F.array().cast("array<string>")))
    frame = frame.withColumns({"_u1": F.transform(_positions("_hash", 2), pair), "_u2": F.transform(_positions("_char", CHARS), gram)})
    frame = frame.withColumns({"_a1": F.filter(_positions("_u1", SPAN), _anchor("_u1")), "_a2": F.filter(_positions("_u2", SPAN), _anchor("_u2"))})
    whole = F.when((length > 0) & (F.size("_a1") + F.size("_a2") == 0), F.array(F.xxhash64(text))).otherwise(_none())
    for units, anchors, out, rest in (("_u1", "_a1", words, _none()), ("_u2", "_a2", chars, whole)):
        entries = F.concat(F.transform(_positions(anchors, 1), _entry(units, anchors)), rest)
        frame = frame.withColumn(out, F.slice(F.sort_array(F.array_distinct(entries)), 1, KEEP))
    return frame.select(*kept, words, chars)


def _jaccard(a: str, b: str) -> Column:
    """Of two bottom-k sketches; null if either is empty."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, KEEP)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / F.size(union))


def likeness(words: str, chars: str, other_words: str, other_chars: str) -> Column:
    empty = (F.size(words) + F.size(chars) == 0) & (F.size(other_words) + F.size(other_chars) == 0)
    return F.when(empty, F.lit(1.0)).otherwise(F.coalesce(F.greatest(_jaccard(words, other_words), _jaccard(chars, other_chars)), F.lit(0.0)))


def written(words: str, chars: str) -> Column:
    """A fingerprint as text: entries in hexadecimal, words' first."""
    hexed = lambda a: F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")
    return F.when(F.size(words) + F.size(chars) == 0, F.lit("")).otherwise(F.concat(F.lit("w"), hexed(words), F.lit("c"), hexed(chars)))


def _range(bounds: list[int]):
    """The number of bounds at or below a key, looked up in two steps."""
    if not bounds:
        return lambda key: F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    rows = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(r[0]).cast("long") for r in rows])
    table = F.array(*[F.array(*[F.lit(b).cast("long") for b in r]) for r in rows])

    def number(key: Column) -> Column:
        row = F.size(F.filter(heads, lambda b: b <= key)) - 1
        return F.when(row < 0, F.lit(0)).otherwise(row * step + F.size(F.filter(F.get(table, row), lambda b: b <= key)))

    return number


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) the columns of the module's contract."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_LONG)).alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select("key").agg(F.percentile_approx("key", [k / parts for k in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    number = _range(sorted(set(cuts or [])))
    # the first key of each range; a range's last document is followed by the next range's first one
    firsts = rows.select("key").groupBy(number(F.col("key")).alias("part")).agg(F.min("key").alias("key")).orderBy("part").collect()
    if not firsts:
        firsts_of = {}
    else:
        firsts_of = {firsts[k].key: firsts[k - 1].part for k in range(len(firsts))}  # the first range's goes to the last range
    signed = with_fingerprint(rows, "text", "w", "c").withColumns({"part": number(F.col("key")), "lent": F.lit(0)})
    lent = rows.where(F.col("key").isin(list(firsts_of) or [MAX_LONG]))
    lent = lent.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("text"))).where("nth = 1").drop("nth")
    goes_to = F.create_map(*[F.lit(x).cast("long") for pair in (firsts_of or {0: 0}).items() for x in pair])
    lent = with_fingerprint(lent, "text", "w", "c").withColumns({"part": F.get(F.array(F.element_at(goes_to, F.col("key"))), F.lit(0)).cast("int"), "lent": F.lit(1)})
    order = Window.partitionBy("part").orderBy("lent", "key", "text")
    both = signed.withColumn("part", F.col("part").cast("int")).unionByName(lent)
    both = both.withColumn("next", F.lead(F.struct("text", "w", "c")).over(order)).where("lent = 0")
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - quarter), F.left(F.col("next.text"), quarter))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "w", "c", F.col("next.w").alias("nw"), F.col("next.c").alias("nc"), edited.alias("edited"))
    both = with_fingerprint(both, "edited", "ew", "ec")
    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), written("w", "c").alias("fingerprint"), written("ew", "ec").alias("edited_fingerprint"),
        likeness("w", "c", "ew", "ec").alias("near_edited"), likeness("w", "c", "nw", "nc").alias("near_next"),
    )
