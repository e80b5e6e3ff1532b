"""MinHash near-dedup with SuperMinHash signatures.

1. Each document's set of word shingles gives a SuperMinHash signature: every
   element walks the slots in its own random permutation, offering rank + fraction,
   until no slot of the document can still be lowered. Ranks within a
   signature are correlated, which lowers its variance, and long documents stop
   after a few ranks.
2. Equal sets (by two 64-bit set hashes) become one representative, the smallest doc_id.
3. Slots are banded (``banding``: 25 bands of 5 at 85 percent, 32 of 4 at 80). In each bucket every
   representative is compared with one member taken at random: a star, linear in the
   bucket. A pair survives exact bounds (set sizes, and shingles that no
   other candidate holds) and a 128-bit sketch of the signature (``sketch_bits``, over six
   standard deviations away from any true link).
4. Each document's likeliest centre (by sketch) is verified on full shingle
   sets and union-find grouping (``_store.components``) merges the links;
   then its likeliest centre outside its group; in buckets that still hold several groups,
   ``STARS`` further stars around random members of the largest one.
5. Exact rest: buckets that still hold several groups are searched in blocks:
   members outside the bucket's largest group, against all its members, as far as a second
   exact bound, from parity sketches of the full sets, leaves room for a link; again the
   likeliest pair of each is verified first, then all whose ends are still
   apart. So a group of copies costs about two verifications a member however large
   it is, and no candidate of any bucket is left out.

A linked pair at the threshold shares no band with probability
(1 - (percent / 100) ** rows) ** bands, ``MISS`` at most: 4e-7 at 85 percent, 5e-8
at 80. A percent for which no banding reaches that is refused.

Defined results: null, empty and blank texts have an empty set and are linked
with nothing; fewer words than a shingle give one shingle; a null doc_id has
null component and is not kept; rows of equal doc_id are one document for
links (``drop_near_duplicates`` decides by row instead); other columns are ignored. An empty table gives an empty result.

Scale: texts are read twice; those in shared buckets are shuffled once, and their sets
with the pairs that ask for them. About
250 bytes a document are written and 25 rows of two numbers a representative
shuffled; ``drop_near_duplicates`` reads the texts three times more and shuffles them once, those
of groups with several rows to choose from twice. Copies are merged by a partial aggregate before any join. Joins are
equi-joins that AQE may split at hot keys. Nothing is collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm._store import components, labelled_ends, merged, stored
from ledgerlake.llm._text import Run, distinct, map_runs, mix, record, shingles, workers_find_package

U64 = np.uint64
SHINGLE = 5
SLOTS = 128
PERCENT = 85
MISS = 1e-6
DEVIATIONS = 6.25
BLOCK = 1024
FILTER_BITS = 1 << 26  # of the bitmap of documents in shared buckets
SIGN_BYTES = 1 << 19  # of texts signed at a time: the walks take some 50 bytes a byte of text
STARS = 4  # further stars in buckets that still hold several groups
ODD_WORDS = 16  # of 64 bits, in a parity sketch of a shingle set


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest rows by which a pair at the threshold is missed with ``MISS`` at most."""
    for rows in range(SLOTS, 0, -1):
        bands = SLOTS // rows
        if 0 < percent <= 100 and (1 - (percent / 100) ** rows) ** bands <= MISS:
            return bands, rows
    raise ValueError(f"{SLOTS} slots do not find pairs of {percent} percent")


def sketch_bits(percent: int) -> int:
    """Most differing sketch bits of a link; at 85 percent their mean is 9.6 and their deviation 3."""
    p = (1 - percent / 100) / 2
    return int(SLOTS * p + DEVIATIONS * (SLOTS * p * (1 - p)) ** 0.5)


def super_minhash(doc: np.ndarray, value: np.ndarray, n_docs: int, m: int = SLOTS) -> np.ndarray:
    """Signatures (n_docs, m) of rank * 2**32 + fraction; ``value`` distinct per document."""
    out = np.full(n_docs * m, np.iinfo(np.uint64).max, dtype=U64)
    live = np.arange(len(value))
    seeds = value * U64(0x9E3779B97F4A7C15)
    swaps: list[np.ndarray] = []
    order = None
    for j in range(m):
        z = mix(seeds[live] + U64((j + 1) * 0xD1B54A32D192ED03 & (2**64 - 1)))
        k = j + ((z & U64(0xFFFFFFFF)) * U64(m - j) >> U64(32)).astype(np.int64)
        if order is None:
            # few ranks so far: follow the earlier swaps back instead of storing permutations
            slot = k.copy()
            for t in range(j - 1, -1, -1):
                slot = np.where(slot == swaps[t], t, slot)
            swaps.append(k)
        else:
            rows = np.arange(len(live))
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
        np.minimum.at(out, doc[live] * m + slot, (U64(j) << U64(32)) | (z >> U64(32)))
        top = (out.reshape(n_docs, m).max(axis=1) >> U64(32)) > U64(j)
        keep = top[doc[live]]
        if not keep.any():
            break
        live = live[keep]
        if order is not None:
            order = order[keep]
        else:
            swaps = [s[keep] for s in swaps]
            if j == 3:
                order = np.tile(np.arange(m, dtype=np.uint8), (len(live), 1))
                rows = np.arange(len(live))
                for t, s in enumerate(swaps):
                    order[rows, s], order[:, t] = order[:, t].copy(), order[rows, s]
    return out.reshape(n_docs, m)


def shingle_sets(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """(document, 54-bit shingle), distinct and sorted, of A-Z lower-cased words."""
    doc, start, end = run.words()
    value, owner = shingles(run.hashes(start, end, lower=True), doc, run.n, SHINGLE)
    return distinct(owner, value)


def _sign(part: pa.RecordBatch, run: Run, n_bands: int, n_rows: int) -> pa.RecordBatch:
    doc, value = shingle_sets(run)
    counts = np.bincount(doc, minlength=run.n)
    cut = np.concatenate([[0], np.cumsum(counts)])

    def total(x: np.ndarray) -> np.ndarray:
        s = np.concatenate([np.zeros(1, U64), np.cumsum(x, dtype=U64)])
        return mix(s[cut[1:]] - s[cut[:-1]]).astype(np.int64)

    signature = super_minhash(doc, value, run.n)
    bits = np.packbits((signature & U64(1)).astype(bool), axis=1).view(np.int64)
    bands = np.zeros((run.n, n_bands), dtype=U64)
    for b in range(n_bands):
        acc = np.full(run.n, b + 1, dtype=U64)
        for t in range(n_rows):
            acc = mix(acc * U64(0x9FB21C651E98DF25) + signature[:, b * n_rows + t])
        bands[:, b] = acc
    keys = pa.ListArray.from_arrays(np.arange(0, run.n * n_bands + 1, n_bands, dtype=np.int32), pa.array(bands.ravel().astype(np.int64)))
    return record(
        doc_id=part.column(0).cast(pa.int64()), n=counts.astype(np.int64), h1=total(mix(value + U64(0x1234567))), h2=total(mix(value ^ U64(0x5851F42D4C957F2D))),
        s1=np.ascontiguousarray(bits[:, 0]), s2=np.ascontiguousarray(bits[:, 1]), bands=keys,
    )


def _sets(part: pa.RecordBatch, run: Run) -> pa.RecordBatch:
    doc, value = shingle_sets(run)
    cut = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=run.n))])
    rows = [value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    odd = np.zeros((run.n, ODD_WORDS), dtype=U64)
    bit = value % U64(64 * ODD_WORDS)
    np.bitwise_xor.at(odd, (doc, (bit >> U64(6)).astype(np.int64)), U64(1) << (bit & U64(63)))
    odds = pa.ListArray.from_arrays(np.arange(0, run.n * ODD_WORDS + 1, ODD_WORDS, dtype=np.int32), pa.array(odd.ravel().astype(np.int64)))
    return record(doc_id=part.column(0).cast(pa.int64()), items=pa.array(rows, pa.binary()), odd=odds)


def _linked(percent: int):
    def task(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.sort(np.concatenate([x, y]))
                inter = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return task


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of doc_ids whose full shingle sets are similar enough; other documents' sets are not shuffled."""
    sets = _maybe(sets.select("doc_id", "items"), pairs.select("a").union(pairs.select("b")))
    both = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b").join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
    return stored(both.select("a", "b", "x", "y").mapInArrow(_linked(percent), "a long, b long").distinct(), "links")


def _differ():
    """Sketch bits in which two documents differ."""
    return F.bit_count(F.col("s1").bitwiseXOR(F.col("t1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("t2")))


def _near(percent: int):
    """Whether a pair can be similar enough.

    Shingles that no other member holds are outside any intersection, so a
    pair shares at most ``most`` of them and the union has the lone ones of both
    besides. That bound is exact; the sketch is far from any true link.
    """
    most = F.least(F.col("n") - F.col("lone"), F.col("n2") - F.col("lone2"))
    return (most * 100 >= (most + F.col("lone") + F.col("lone2")) * percent) & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent) & (_differ() <= sketch_bits(percent))


def _odd_near(percent: int):
    """Whether the parities of two sets leave room for a link.

    A bit in which the parity sketches differ needs an element that only one of the sets holds, so
    the differing bits are at most the size of the symmetric difference, which a link bounds by
    (100 - percent) / (100 + percent) of both sizes. No link is lost, whatever the sets.
    """
    differing = F.lit(0)
    for k in range(ODD_WORDS):
        differing = differing + F.bit_count(F.get("odd", F.lit(k)).bitwiseXOR(F.get("odd2", F.lit(k))))
    return differing * (100 + percent) <= (F.col("held") + F.col("held2")) * (100 - percent)


def _items(batches):
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).to_numpy() // 8
        values = np.frombuffer(b"".join(x.as_py() for x in batch.column(1)), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(np.repeat(batch.column(0).to_numpy(), sizes))], names=["item", "doc_id"])


def lone_items(sets: DataFrame) -> DataFrame:
    """(rep, lone): how many of a document's shingles no other document of ``sets`` holds."""
    items = sets.select("doc_id", "items").mapInArrow(_items, "item long, doc_id long")
    once = items.groupBy("item").agg(F.count("*").alias("c"), F.min("doc_id").alias("rep")).where("c = 1")
    return once.groupBy("rep").agg(F.count("*").alias("lone"))


def _other(members: DataFrame):
    return members.select("key", F.col("rep").alias("a"), F.col("n").alias("n2"), F.col("lone").alias("lone2"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))


def _best(pairs: DataFrame) -> DataFrame:
    """For each b its likeliest partner: pairs are (a, b, differ)."""
    return pairs.groupBy("b").agg(F.min(F.struct("differ", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    return labelled_ends(pairs, groups).where("of_a <> of_b").drop("of_a", "of_b")


def _maybe(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The ``rows`` whose ``column`` can be among ``ids`` (one column), told by a bitmap of hashed ids.

    The bitmap has ``FILTER_BITS`` bits whatever the corpus (8 MB, so it may be broadcast); rows that
    no id asks for are then not shuffled. An exact join follows: a full bitmap costs its effect, never a row.
    That join must not be a semi-join, which Spark moves below this one, to where all rows still are.
    """

    def hashed(c: str):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(FILTER_BITS))

    part, bit = F.expr("_h div 32768"), F.expr("_h % 32768")
    held = ids.select(hashed(ids.columns[0]).alias("_h")).groupBy(part.alias("_part")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    marked = rows.withColumn("_h", hashed(column)).withColumn("_part", part).join(F.broadcast(held), "_part")
    byte = F.conv(F.hex(F.expr("substring(_bits, int(_h % 32768 div 8) + 1, 1)")), 16, 10).cast("int")
    return marked.where(byte.bitwiseAND(F.expr("shiftleft(1, int(_h % 8))")) != 0).select(*rows.columns)


def _asked(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The ``rows`` whose ``column`` is among ``ids`` (one column)."""
    return _maybe(rows, ids, column).join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column)


def linked_groups(docs: DataFrame, heads: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of the representatives ``heads`` (rep, n, s1, s2, bands) that have a link."""
    keys = heads.select("rep", F.explode("bands").alias("key"))
    mark = F.xxhash64("rep", "key")
    shared = stored(keys.groupBy("key").agg(F.count("*").alias("size"), F.min(mark).alias("head")).where("size > 1"), "shared")
    members = _maybe(keys, shared.select("key"), "key").join(shared, "key").select("key", "rep", (mark == F.col("head")).alias("head"))
    members = stored(members.join(heads.select("rep", "n", "s1", "s2"), "rep"), "buckets")
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    sets = stored(map_runs(_asked(texts, members.select("rep")), ["doc_id", "text"], _sets, "doc_id long, items binary, odd array<long>"), "sets")
    members = stored(members.join(lone_items(sets), "rep", "left").fillna(0, ["lone"]), "members")
    # a star in each bucket, around a member taken at random: first each member's likeliest centre
    star = members.where("NOT head").join(_other(members.where("head")), "key").where(_near(percent) & (F.col("rep") != F.col("a")))
    star = stored(star.select("a", F.col("rep").alias("b"), _differ().alias("differ")).distinct(), "star")
    tested = stored(_best(star), "first")
    groups = stored(components(verified(tested, sets, percent)), "groups")
    # then its likeliest centre of another component
    second = stored(_best(_apart(star, groups)), "second")
    groups = merged(groups, verified(second, sets, percent))
    # buckets of several components: further stars, each around a random member of the bucket's largest one
    members = stored(members.join(_opened(members, groups).select("key"), "key", "left_semi"), "open")
    odd = sets.select(F.col("doc_id").alias("rep"), "odd", F.expr("length(items) div 8").alias("held"))
    members = stored(members.join(_maybe(odd, members.select("rep"), "rep"), "rep"), "open_members")
    tried = [tested, second]
    for k in range(STARS):
        labelled = stored(_labelled(members, groups).join(_opened(members, groups), "key"), "open_buckets")
        mark = F.xxhash64("rep", "key", F.lit(k))
        centre = labelled.where("component = largest").groupBy("key").agg(F.min_by(F.struct("rep", "n", "lone", "s1", "s2", "odd", "held"), mark).alias("c"))
        around = centre.select("key", F.col("c.rep").alias("a"), F.col("c.n").alias("n2"), F.col("c.lone").alias("lone2"), F.col("c.s1").alias("t1"), F.col("c.s2").alias("t2"), F.col("c.odd").alias("odd2"), F.col("c.held").alias("held2"))
        pairs = labelled.where("component <> largest").join(around, "key").where(_near(percent) & _odd_near(percent))
        near = stored(_best(pairs.select("a", F.col("rep").alias("b"), _differ().alias("differ"))), "more")
        if near.isEmpty():
            break
        groups = merged(groups, verified(near, sets, percent))
        tried.append(near)
    # what is left is searched in blocks
    rest = stored(_labelled(members, groups).join(_opened(members, groups), "key"), "open_buckets")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    base = rest.select("key", block.alias("block"), F.col("rep").alias("a"), F.col("component").alias("other"), F.col("n").alias("n2"), F.col("lone").alias("lone2"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), "largest", F.col("odd").alias("odd2"), F.col("held").alias("held2"))
    asked = rest.where("component <> largest").select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "rep", "component", "n", "lone", "s1", "s2", "odd", "held")
    cross = asked.join(base, ["key", "block"]).where((F.col("component") != F.col("other")) & ((F.col("other") == F.col("largest")) | (F.col("a") < F.col("rep"))) & _near(percent) & _odd_near(percent))
    cross = cross.select("a", F.col("rep").alias("b"), _differ().alias("differ")).distinct()
    for seen in tried:
        cross = cross.join(seen.select("a", "b"), ["a", "b"], "left_anti").join(seen.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
    cross = stored(cross, "cross")
    if cross.isEmpty():
        return groups
    likeliest = stored(_best(cross), "third")
    groups = merged(groups, verified(likeliest, sets, percent))
    last = stored(_apart(cross.join(likeliest, ["a", "b"], "left_anti"), groups).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "last")
    if last.isEmpty():
        return groups
    return merged(groups, verified(last, sets, percent))


def _labelled(members: DataFrame, groups: DataFrame) -> DataFrame:
    return members.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _opened(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Buckets that hold several components: key, the largest one and the number of blocks."""
    counts = _labelled(members, groups).groupBy("key", "component").agg(F.count("*").alias("c"))
    opened = counts.groupBy("key").agg(F.sum("c").alias("size"), F.count("*").alias("groups"), F.max(F.struct("c", "component")).alias("top")).where("groups > 1")
    return opened.select("key", F.col("top.component").alias("largest"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    workers_find_package(docs.sparkSession)
    n_bands, n_rows = banding(percent)
    signed = stored(map_runs(docs, ["doc_id", "text"], lambda part, run: _sign(part, run, n_bands, n_rows), "doc_id long, n long, h1 long, h2 long, s1 long, s2 long, bands array<long>", limit=SIGN_BYTES), "signatures")
    full = signed.where("n > 0 AND doc_id IS NOT NULL")
    reps = stored(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "representatives")
    heads = full.join(reps.withColumnRenamed("rep", "doc_id"), ["h1", "h2", "doc_id"], "left_semi").dropDuplicates(["doc_id", "h1", "h2"])
    heads = stored(heads.select(F.col("doc_id").alias("rep"), "n", "s1", "s2", "bands"), "heads")
    groups = linked_groups(docs, heads, percent)
    named = reps.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    out = signed.join(named, ["h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, with all its columns, decided by each row's own text.

    The row of smallest doc_id stays, rows without doc_id counting as larger than all;
    of several the smallest text, then the smallest other columns. So rows of equal doc_id
    whose texts are unlike all stay. Blank texts are copies of nothing: only repeats
    of the same doc_id and text become one.
    """
    node = F.xxhash64("text")
    blank = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), node.alias("node"), blank.alias("blank"),
        F.col("doc_id").isNull().cast("int").alias("without"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
    )
    # a distinct text is a document of its own, so that links never pass through a doc_id
    linked = near_duplicates(docs.select(node.alias("doc_id"), "text"), percent).where("n_shingles > 0")
    of = linked.select(F.col("doc_id").alias("node"), F.col("component_id").alias("component")).distinct()
    counted = rows.where("NOT blank").groupBy("node", "without", "id").agg(F.count("*").alias("rows"))
    nodes = counted.groupBy("node").agg(F.min(F.struct("without", "id", "rows")).alias("top")).join(of, "node").select("node", "component", "top.*")
    nodes = stored(nodes, "nodes")
    tops = nodes.groupBy("component").agg(F.min(F.struct("without", "id")).alias("top")).select("component", "top.without", "top.id")
    heads = stored(nodes.join(tops, ["component", "without", "id"]), "tops")
    # a group that has one such row keeps it as it is; only the others' rows are compared
    alone = heads.groupBy("component").agg((F.sum("rows") == 1).alias("alone"))
    heads = stored(heads.join(alone, "component").select("node", "without", "id", "component", "alone"), "heads")
    texts = rows.where("NOT blank").join(heads, ["node", "without", "id"]).select("row", "component", F.lit(None).cast("long").alias("id"), "alone")
    blanks = rows.where("blank AND without = 0").select("row", F.col("node").alias("component"), "id")
    smallest = F.min_by("row", F.struct(F.col("row.text"), F.to_json("row"))).alias("row")
    compared = texts.where("NOT alone").drop("alone").unionByName(blanks).groupBy("component", "id").agg(smallest)
    return compared.select("row").unionByName(texts.where("alone").select("row")).unionByName(rows.where("blank AND without = 1").select("row")).select("row.*")
