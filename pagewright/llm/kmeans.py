"""Exact k-means over quantised vectors with Hamerly's bounds.

Vectors with exactly ``DIMS`` components, none null or non-finite, are kept; component x becomes the integer floor(256 * x), x as a
double. The first centroids are the vectors with the smallest SHA-256 of ``2:<vec_id>``. A round assigns every vector to
the nearest centroid by squared Euclidean distance (ties: the smaller number) and replaces each centroid that has vectors by the
componentwise floor of their mean; after the last round vectors are assigned once more.

Beside its vector each row keeps one upper bound of the distance to its own centroid and one lower bound of the distance to the
second nearest (Hamerly, 2010). Moved centroids loosen them: the upper by the own centroid's drift, the lower by the largest
drift of the others. A vector whose upper bound is below its lower one, or below half of the way from its centroid to the nearest other one,
stays where it is without a look; of the rest the upper bound is made exact, and those that are still ambiguous are compared with all
centroids in integers. Bounds are floats, widened by more than their rounding; whatever they can't tell apart, ties included, is scanned, so they never decide a result.

A round reads the table of rows of the round before and writes its own, in the shared folder, without a shuffle; the table before goes.
Sums aren't made anew: a task gives the change of each centroid's sums and count by the vectors that moved. These few rows are added up by key, and
only centroids (k * ``DIMS`` integers) meet on the driver.

Whole numbers below ``FLOAT_EXACT`` go through float products, which are exact then; a batch with larger ones is worked out in Python's integers. Sums are
added up in limbs, so nothing overflows; where a result is larger than a long holds, the largest long stands for it. A component whose 256-fold isn't
finite counts as non-finite. A null vec_id is hashed as nothing behind the colon. Rows that repeat an id are vectors of their own; of equal hashes the smaller vector
comes first. Fewer vectors than centroids are centroids all. An empty table gives no rows. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import remove, scratch, tidy

K = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
#: Whole numbers up to this have exact products and sums of 64 products in doubles.
FLOAT_EXACT = 1 << 22
#: Relative and absolute width that bounds get beyond their value.
SLACK = 1e-9
#: Roots of what is larger aren't taken; the diagonal of the centroids' distances.
HUGE = 10**600
#: Bits of a limb of a large sum.
LIMB = 40
LONGEST = 2**63 - 1

STATE = "vec_id long, x array<double>, cluster int, upper double, lower double, distance long, delta array<struct<cluster: int, dim: int, limb: int, value: long>>"


def quantised(dims: int = DIMS) -> Column:
    """floor(256 * x) of each component as doubles, which hold it exactly; null for a vector that isn't kept."""
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.lit(float(SCALE)) * x)
    fit = (F.size(whole) == dims) & F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # floor() of a double is a long, which large ones don't fit; those are whole already
    return F.when(fit, F.transform(whole, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)))


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(number, signed limb) of the limbs of ``value`` that aren't zero."""
    sign, rest, at = (1 if value >= 0 else -1), abs(value), 0
    while rest:
        if low := rest & ((1 << LIMB) - 1):
            yield at, sign * low
        rest, at = rest >> LIMB, at + 1


def integers(x: np.ndarray) -> np.ndarray:
    """Rows of whole numbers, as doubles if products stay exact and as Python's integers if not."""
    if not x.size or np.abs(x).max() < FLOAT_EXACT:
        return x.astype(np.float64)
    return np.array([[int(v) for v in row] for row in x], object)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every centroid."""
    if x.dtype != object and centroids.dtype != object:
        return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)
    return np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(row, c)) for c in centroids] for row in x], object)


def own_squared(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to the same row of ``others``."""
    if x.dtype != object and others.dtype != object:
        return ((x - others) ** 2).sum(1)
    return np.array([sum((int(a) - int(b)) ** 2 for a, b in zip(row, c)) for row, c in zip(x, others)], object)


def above(square: np.ndarray) -> np.ndarray:
    """Roots, or more."""
    if square.dtype != object:
        return wider(np.sqrt(square))
    return wider(np.array([float(math.isqrt(v) + 1) if v < HUGE else math.inf for v in map(int, square)]))


def below(square: np.ndarray) -> np.ndarray:
    """Roots, or less."""
    if square.dtype != object:
        return narrower(np.sqrt(square))
    return narrower(np.array([float(math.isqrt(min(v, HUGE))) for v in map(int, square)]))


def wider(value: np.ndarray) -> np.ndarray:
    return value * (1 + SLACK) + SLACK


def narrower(value: np.ndarray) -> np.ndarray:
    return value * (1 - SLACK) - SLACK


class Bounds:
    """What a round knows of its centroids: their drift, and half of each one's way to the nearest other."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None):
        self.centroids, k = integers(np.array(centroids, object)), len(centroids)
        between = squared(self.centroids, self.centroids).astype(object)
        between[np.arange(k), np.arange(k)] = HUGE
        self.half = narrower(below(between.min(1)) / 2)
        self.drift = above(own_squared(self.centroids, integers(np.array(before, object)))) if before else np.zeros(k)
        self.others = np.array([np.delete(self.drift, c).max(initial=0.0) for c in range(k)])

    def assign(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """New (cluster, upper, lower) and how many rows were scanned; a cluster of -1 isn't known yet."""
        cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
        known = cluster >= 0
        upper[known] = wider(upper[known] + self.drift[cluster[known]])
        lower[known] = narrower(lower[known] - self.others[cluster[known]])
        floor = np.where(known, np.maximum(lower, self.half[cluster]), -np.inf)
        look = np.flatnonzero(~(upper < floor))
        again = look[known[look]]
        if len(again):
            upper[again] = above(own_squared(x[again], self.centroids[cluster[again]]))
            look = np.flatnonzero(~(upper < floor))
        if len(look):
            far = squared(x[look], self.centroids)
            best = far.argmin(1).astype(np.int64)  # of equal ones the first
            rows = np.arange(len(look))
            cluster[look], upper[look] = best, above(far[rows, best])
            if far.shape[1] > 1:
                second = far.copy()
                second[rows, best] = second.max() + 1
                lower[look] = below(second.min(1))
            else:
                lower[look] = np.inf
        return cluster, upper, lower, len(look)


def _step(centroids: list[list[int]], before: list[list[int]] | None, last: bool):
    """The task of one round. At its end comes a row with the change of the sums: dims 0 and on, then the count, then (in the last) the distances."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, dims = Bounds(centroids, before), len(centroids[0])
        change: dict[tuple[int, int], int] = defaultdict(int)
        schema = pa.schema([("vec_id", pa.int64()), ("x", pa.list_(pa.float64())), ("cluster", pa.int32()), ("upper", pa.float64()), ("lower", pa.float64()), ("distance", pa.int64()), ("delta", DELTA)])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = integers(batch.column("x").flatten().to_numpy().reshape(batch.num_rows, dims))
            was = batch.column("cluster").to_numpy()
            cluster, upper, lower, _ = bounds.assign(x, was, batch.column("upper").to_numpy(), batch.column("lower").to_numpy())
            distance = pa.nulls(batch.num_rows, pa.int64())
            if last:
                far = own_squared(x, bounds.centroids[cluster])
                for c in np.unique(cluster).tolist():
                    change[c, dims + 1] += sum(map(int, far[cluster == c]))
                distance = pa.array([min(int(d), LONGEST) for d in far], pa.int64())
            else:
                for c, rows, sign in [(c, x[(was == c) & (cluster != c)], -1) for c in np.unique(was).tolist() if c >= 0] + [(c, x[(cluster == c) & (was != c)], 1) for c in np.unique(cluster).tolist()]:
                    change[c, dims] += sign * len(rows)
                    for d, v in enumerate(rows.sum(0).tolist() if len(rows) else ()):
                        change[c, d] += sign * int(v)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower), distance, pa.nulls(batch.num_rows, DELTA)], schema=schema)
        delta = [{"cluster": c, "dim": d, "limb": at, "value": v} for (c, d), total in change.items() for at, v in limbs(total)]
        if delta:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in list(schema)[:-1]] + [pa.array([delta], DELTA)], schema=schema)

    return run


DELTA = pa.list_(pa.struct([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]))


def changes(state: DataFrame) -> dict[tuple[int, int], int]:
    """The tasks' changes, added up by (cluster, dim): k * (DIMS + 2) numbers at most."""
    each = state.where("delta is not null").select(F.inline("delta"))
    total: dict[tuple[int, int], int] = defaultdict(int)
    for r in each.groupBy("cluster", "dim", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        total[r["cluster"], r["dim"]] += int(r["value"]) << (LIMB * r["limb"])
    return total


def first_centroids(kept: DataFrame, k: int) -> list[list[int]]:
    hashed = kept.select(F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256).alias("h"), "x")
    return [[int(v) for v in r["x"]] for r in hashed.orderBy("h", "x").limit(k).collect()]


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row for each kept vector."""
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(dims).alias("x")).where("x is not null")
    centroids = first_centroids(kept, k)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state = kept.select("vec_id", "x", F.lit(-1).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    sums: dict[tuple[int, int], int] = defaultdict(int)
    before, path = None, ""
    for number in range(rounds + 1):
        last = number == rounds
        gone, path = path, scratch(spark, "vectors")
        state.mapInArrow(_step(centroids, before, last), STATE).write.parquet(path)
        if gone:
            remove(spark, gone)
        written = spark.read.schema(STATE).parquet(path)
        found = changes(written)
        state = written.where("delta is null").select("vec_id", "x", "cluster", "upper", "lower")
        if not last:
            for at, v in found.items():
                sums[at] += v
            before, centroids = centroids, [[sums[c, d] // n for d in range(dims)] if (n := sums[c, dims]) else old for c, old in enumerate(centroids)]
    inertia = {c: found[c, dims + 1] for c in range(len(centroids))}
    total = min(sum(inertia.values()), LONGEST)
    named = [(c, min(inertia[c], LONGEST), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    names = spark.createDataFrame(named, "cluster int, cluster_inertia long, centroid_sha256 string")  # k rows
    out = written.where("delta is null").select("vec_id", "cluster", "distance").join(F.broadcast(names), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


def op12_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(k: int = K, rounds: int = ROUNDS, dims: int = DIMS) -> str:
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = {dims})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), x) - 1 AS c, x FROM v QUALIFY c < {k})",
    ]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS MATERIALIZED (SELECT r, c, v.x AS x, list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c{i}.x[i]) * (v.x[i] - c{i}.x[i])))::BIGINT AS d FROM v, c{i}),
a{i} AS MATERIALIZED (SELECT r, any_value(x) AS x, min(d) AS d, arg_min(c, (d, c)) AS c FROM d{i} GROUP BY r)""")
        if i < rounds:
            parts.append(f"""e{i} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM a{i}) GROUP BY c, i),
m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM e{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (c))""")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, a{rounds}.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{rounds}.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.c = a{rounds}.c
"""


QUERIES = {"op12_kmeans": op12_kmeans}
ORACLES = {"op12_kmeans": _sql()}
