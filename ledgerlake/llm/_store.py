"""Written intermediates and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm._text import workers_find_package
from ledgerlake.session import scratch_path


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not the plan above.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one task's edges: (node, smallest node of its tree)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.get(top, top) != top:
            top = root[top]
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            root.setdefault(a, a)
            root.setdefault(b, b)
            if x != y:
                root[max(x, y)] = min(x, y)
    nodes = [n for n in root if find(n) != n]
    for k in range(0, len(nodes), 65536):
        part = nodes[k : k + 65536]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(n) for n in part], pa.int64())], names=["a", "b"])


def _rows(frame: DataFrame) -> int:
    return frame.agg(F.count("*")).first()[0]


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has one root and no root has another one."""
    if _rows(edges.groupBy("a").agg(F.count("*").alias("c")).where("c > 1")):
        return False
    return not _rows(edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest reachable node.

    Union-find shrinks the edges of each task to a forest; alternating star
    rounds then merge the forests until all trees are stars. A round is two joins
    on node ids with a partial minimum before the shuffle; each round is written, and
    rounds grow with the logarithm of the longest chain. No task or driver holds all links.
    """
    workers_find_package(edges.sparkSession)
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    now = stored(edges.mapInArrow(_forest, "a long, b long").distinct(), "forest")
    while not _is_star(now):
        # large star: every larger neighbour of a node goes to the node's smallest neighbour
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(small, "a")
        now = stored(pairs.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))).distinct(), "stars")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def labelled_ends(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """``pairs`` with the components of their ends as ``of_a`` and ``of_b``; a node without one is its own."""
    for end in ("a", "b"):
        pairs = pairs.join(groups.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    return pairs.withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")})


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (node, component) after new ``links``: only components that a link joins are worked on."""
    ends = labelled_ends(links.select("a", "b"), groups).where("of_a <> of_b")
    joins = stored(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct(), "joins")
    if not _rows(joins):
        return groups
    top = stored(components(joins), "joined")
    moved = groups.join(top.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
    moved = moved.select("node", F.coalesce("now", "component").alias("component"))
    fresh = top.join(groups.select("node"), "node", "left_anti")
    return stored(moved.unionByName(fresh.select("node", "component")), "groups")
