"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import remove, scratch, skewed_join


class Forest:
    """Union-find over hashable nodes; the smallest of a set is its root."""

    def __init__(self, edges: Iterable[tuple] = ()):
        self.up: dict = {}
        for a, b in edges:
            self.join(a, b)

    def root(self, x):
        up = self.up
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.up[high] = low
        self.up.setdefault(low, low)
        return True

    def stars(self) -> list[tuple]:
        """(node, root) of every node that isn't a root."""
        return [(x, r) for x in self.up if (r := self.root(x)) != x]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the task's edges, as stars."""
    forest = Forest()
    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            forest.join(x, y)
    stars = forest.stars()
    yield pa.RecordBatch.from_pydict({"a": pa.array([s[0] for s in stars], pa.int64()), "b": pa.array([s[1] for s in stars], pa.int64())})


#: A node with so large a share of all edges is broadcast: there are at most twice as many.
HOT_SHARE = 1000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a and b); root is the smallest node reachable.

    A union-find within each task first, then alternating large and small stars (Kiveris et al.,
    2014) over all edges until nothing changes. Each round is a table in the shared folder; the one before goes.
    """
    spark = edges.sparkSession
    path = ""

    def round_(df: DataFrame) -> DataFrame:
        nonlocal path
        before, path = path, scratch(spark, "edges")
        df.coalesce(max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)).write.parquet(path)
        if before:
            remove(spark, before)
        return spark.read.schema("a long, b long").parquet(path)

    now = round_(edges.where("a != b").select("a", "b").mapInArrow(_local, "a long, b long").distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        met = skewed_join(both.where("v > u"), low, ["u"], F.col("n") * HOT_SHARE >= 2 * seen[0])
        large = met.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))  # a node leads to few others by now, each smaller than it
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = round_(small.select("e.*").where("a != b").distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
