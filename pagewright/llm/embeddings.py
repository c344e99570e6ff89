"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are compared if their labels are equal, in double precision. Equal vectors
of a label are one node with a count. The nodes are scaled to length 1 and turned to their principal
axes, the strongest first, by a rotation that the sums of products over all vectors give; a rotation changes
no product, so vectors of a size that few have (under one in SIZES) or that is above MOST_AXES go as they are. A label's nodes are cut into tiles
along the first axis. A pair of tiles accumulates the
products of the leading axes and bounds the rest by the product of the suffix norms; a pair of vectors
stops as soon as its cosine cannot reach the threshold, a pair of tiles without pairs left stops, and tiles meet by bins of the first axis, so that
those too far apart never do. What is left is judged by the cosine of the
original vectors.

A tile pair sends the number of links of each node and a spanning forest of the links, never the pairs
of a group. Vectors that are null, zero, or hold a null or non-finite component, and vectors without
a label, link with nothing; vectors of different sizes don't either. Repeated rows are vectors of their own:
n_links counts the other rows linked. Null ids sort first. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import NULL_ID, merged, partitions, rows, skewed_join, tidy, written
from ._components import Forest, connected_components

THRESHOLD = 0.93
#: Vectors of a tile, and axes accumulated at a step.
TILE = 1024
STEP = 8
#: Sizes of vectors that are turned: those of one vector in SIZES at least, up to MOST_AXES components.
SIZES = 16
MOST_AXES = 2048
#: Vectors with one in so many rows as copies are joined by broadcast: there are that many at most.
HOT_SHARE = 1000
#: Allowance for rounding where a bound rules a pair out; pairs kept are judged exactly.
SLACK = 1e-9


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def tile_pairs(a: np.ndarray, b: np.ndarray, same: bool, threshold: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) whose product can reach the threshold; ``a`` and ``b`` are unit rows on principal axes. ``same``: i < j only."""
    n, d = a.shape
    rest_a = np.sqrt(np.maximum(np.cumsum((a * a)[:, ::-1], 1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum(np.cumsum((b * b)[:, ::-1], 1)[:, ::-1], 0))
    least = threshold - SLACK
    lead = min(step, d)
    part = a[:, :lead] @ b[:, :lead].T
    open_ = part + (np.outer(rest_a[:, lead], rest_b[:, lead]) if lead < d else 0) >= least
    if same:
        open_ &= np.arange(n)[:, None] < np.arange(len(b))[None, :]
    i, j = np.nonzero(open_)
    part = part[i, j]
    while lead < d and len(i):
        to = min(lead + step, d)
        part = part + np.einsum("ij,ij->i", a[i, lead:to], b[j, lead:to])
        ok = part + (rest_a[i, to] * rest_b[j, to] if to < d else 0) >= least
        i, j, part, lead = i[ok], j[ok], part[ok], to
    return i, j


def principal_axes(nodes: DataFrame, sizes: list[int]) -> dict[int, np.ndarray]:
    """For each of some sizes the axes (columns), the strongest first, of the unit vectors of ``nodes`` (size, raw). One job for all."""
    if not sizes:
        return {}

    @tidy
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {n: np.zeros((n, n)) for n in sizes}
        for b in batches:
            for n, at, raw in _by_size(b):
                if n in total:
                    x = _unit(raw)
                    total[n] += x.T @ x
        for n, sums in total.items():
            yield pa.RecordBatch.from_pydict({"size": pa.array([n] * n, pa.int32()), "row": pa.array(range(n), pa.int32()), "sums": [r.astype("<f8").tobytes() for r in sums]})

    def added(t: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(x, "<f8") for x in t.column("sums").to_pylist()], axis=0)
        return pa.table({"size": t.column("size")[:1], "row": t.column("row")[:1], "sums": pa.array([sums.tobytes()], pa.binary())})

    # a row of a matrix from each task; the driver gets at most SIZES matrices
    kind = "size int, row int, sums binary"
    matrices = {n: np.zeros((n, n)) for n in sizes}
    for r in nodes.select("size", "raw").mapInArrow(products, kind).groupBy("size", "row").applyInArrow(added, kind).collect():
        matrices[r["size"]][r["row"]] = np.frombuffer(r["sums"], "<f8")
    return {n: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for n, m in matrices.items()}


def _by_size(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The batch's vectors (columns size, raw) by size: size, rows, matrix."""
    raw, size = b.column("raw").to_pylist(), b.column("size").to_numpy()
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield int(n), at, np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(-1, n)


@tidy
def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, label and the raw vector as doubles, null where it links with nothing: a row per row, in whole arrays."""
    for batch in batches:
        key, label, vector = batch.columns
        starts, flat = vector.offsets.to_numpy(), vector.values
        gaps = flat.is_null().to_numpy(zero_copy_only=False) if flat.null_count else None
        values = flat.fill_null(0.0).to_numpy(zero_copy_only=False) if flat.null_count else flat.to_numpy()
        bad = ~np.isfinite(values)
        if gaps is not None:
            bad |= gaps
        count = lambda mask: (sums := np.concatenate([[0], np.cumsum(mask)]))[starts[1:]] - sums[starts[:-1]]
        ok = (count(bad) == 0) & (count(values != 0) > 0)
        ok &= ~vector.is_null().to_numpy(zero_copy_only=False) & ~label.is_null().to_numpy(zero_copy_only=False)
        raw = [values[a:b].astype("<f8").tobytes() if good else None for a, b, good in zip(starts[:-1].tolist(), starts[1:].tolist(), ok.tolist())]
        yield pa.RecordBatch.from_arrays([key, label, pa.array(raw, pa.binary())], names=["key", "label", "raw"])


def _unit(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(1, keepdims=True)  # the squares neither overflow nor vanish
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """key (vec_id, NULL_ID for null), n_links, component (smallest key reachable): a row per row of ``embeddings``.

    Ids may be null or repeated: a row is judged by its own vector and a node has a number of its own; keys only name components.
    """
    ids = F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID))
    every = embeddings.select(ids.alias("key"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    judged = every.mapInArrow(_usable, "key long, label string, raw binary")
    judged = written(judged.withColumn("size", F.octet_length("raw") / F.lit(8)).withColumn("size", F.col("size").cast("int")), "vectors")
    usable = judged.where("raw is not null")
    nodes = usable.groupBy("label", "size", "raw").agg(F.count("*").alias("copies"), F.min("key").alias("least"))
    nodes = written(merged(nodes).withColumn("node", F.monotonically_increasing_id()), "vector-nodes")  # fixed once written
    bare = nodes.select("label", "size", "raw", "copies", "node")
    by_size = nodes.groupBy("size").agg(F.count("*").alias("n"), F.sum("copies").alias("rows"))
    totals = by_size.agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")).first()
    common = by_size.where((F.col("n") * SIZES >= (totals["n"] or 0)) & (F.col("size") <= MOST_AXES)).collect()  # SIZES rows at most
    axes = principal_axes(bare, sorted(r["size"] for r in common))

    @tidy
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = np.zeros(b.num_rows)
            for n, at, raw in _by_size(b):
                first[at] = _unit(raw) @ axes[n][:, 0] if n in axes else _unit(raw)[:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first)], names=[*b.schema.names, "first"])

    # tiles along the first axis: a range partition of (label, size, first), cut into at most ``tile`` rows
    turned = (
        bare.mapInArrow(turn, "label string, size int, raw binary, copies long, node long, first double")
        .repartitionByRange(partitions(embeddings.sparkSession), "label", "size", "first", "node")
        .sortWithinPartitions("label", "size", "first", "node")
        .withColumn("place", F.monotonically_increasing_id())  # its first row's place names a tile
    )
    tiles = written(turned.mapInArrow(lambda b: _tiles(b, tile), "label string, size int, tile long, low double, high double, narrow boolean, data binary"), "vector-tiles")
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9  # unit vectors with this cosine are no farther apart, on any axis
    wide = max(reach, 1e-3)  # of a bin
    place = lambda c: F.floor(c / F.lit(wide)).cast("int")
    # a tile lies in the bins it covers and looks into those within reach; a pair meets in the first bin that both have
    left = tiles.select("label", "size", F.col("tile").alias("s"), "low", "high", place(F.col("low") - reach).alias("from1"), F.explode(F.sequence(place(F.col("low") - reach), place(F.col("high") + reach))).alias("bin"))
    right = tiles.select("label", "size", F.col("tile").alias("t"), F.col("low").alias("low2"), F.col("high").alias("high2"), place(F.col("low")).alias("from2"), F.explode(F.sequence(place(F.col("low")), place(F.col("high")))).alias("bin"))
    near = (F.col("s") <= F.col("t")) & (F.col("low2") <= F.col("high") + reach) & (F.col("low") <= F.col("high2") + reach)
    met = left.join(right, ["label", "size", "bin"]).where(near & (F.col("bin") == F.greatest("from1", "from2")))
    bodies = tiles.select("tile", "narrow", "data")  # the vectors alone: a task turns them again, which costs less than to send them twice
    pairs = (
        met.select("s", "t", "size")
        .join(bodies.select(F.col("tile").alias("s"), F.col("narrow").alias("narrow_a"), F.col("data").alias("a")), "s")
        .join(bodies.select(F.col("tile").alias("t"), F.col("narrow").alias("narrow_b"), F.col("data").alias("b")), "t")
        .repartition(partitions(embeddings.sparkSession), "s", "t")
        .select("s", "t", "size", "narrow_a", "a", "narrow_b", "b")
    )
    found = written(pairs.mapInArrow(lambda b: _compared(b, threshold, axes), "node long, other long, links long"), "vector-links")
    roots = connected_components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("linked"))
    named = roots.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("first_key"))
    known = (
        nodes.join(counts, "node", "left")
        .join(roots.join(named, "root"), "node", "left")
        .select("label", "raw", "copies", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("first_key", "least").alias("component"))
    )
    linked = skewed_join(usable.select("key", "label", "raw"), written(known, "vector-known"), ["label", "raw"], F.col("copies") * HOT_SHARE >= (totals["rows"] or 0)).select("key", "n_links", "component")
    alone = judged.where("raw is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    return merged(linked).union(merged(alone))


@tidy
def _tiles(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of one label and size, in order, as tiles: ids, copies and raw vectors in one blob, in single precision where that loses nothing."""
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        label, size = held[0][0], held[0][1]
        ids = np.array([h[4] for h in held], "<i8")
        copies = np.array([h[3] for h in held], "<i8")
        raw = np.frombuffer(b"".join(h[2] for h in held), "<f8")
        with np.errstate(over="ignore"):
            single = raw.astype("<f4")
        narrow = bool((single.astype("<f8") == raw).all())
        data = ids.tobytes() + copies.tobytes() + (single if narrow else raw).tobytes()
        row = {"label": [label], "size": pa.array([size], pa.int32()), "tile": pa.array([held[0][6]], pa.int64()), "low": [held[0][5]], "high": [held[-1][5]], "narrow": [narrow], "data": [data]}
        return pa.RecordBatch.from_pydict(row)

    for row in rows(batches):
        if held and (len(held) >= most or row[:2] != held[0][:2]):
            yield out()
            held = []
        held.append(row)
    if held:
        yield out()


@tidy
def _compared(batches: Iterator[pa.RecordBatch], threshold: float, axes: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """For each tile pair: (node, null, copies linked) of nodes with links, and (node, other, 0) of a spanning forest."""

    def parts(data: bytes, size: int, narrow: bool):
        kind = np.dtype("<f4" if narrow else "<f8")
        n = len(data) // (16 + kind.itemsize * size)
        ids, copies = np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i8", n, 8 * n)
        raw = np.frombuffer(data, kind, n * size, 16 * n).reshape(n, size).astype("<f8")
        return ids, copies, raw, _unit(raw) @ axes[size] if size in axes else _unit(raw)

    for s, t, size, narrow_a, a, narrow_b, b in (r for batch in batches for i in range(batch.num_rows) for r in rows([batch.slice(i, 1)])):
        ids, copies, raw, unit = parts(a, size, narrow_a)
        ids2, copies2, raw2, unit2 = parts(b, size, narrow_b)
        i, j = tile_pairs(unit, unit2, s == t, threshold)
        if not len(i):
            continue
        ok = np.concatenate([exact(raw[i[k : k + 65536]], raw2[j[k : k + 65536]]) >= threshold for k in range(0, len(i), 65536)])
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        linked = np.bincount(i, copies2[j], len(ids)), np.bincount(j, copies[i], len(ids2))
        forest = Forest(zip(ids[i].tolist(), ids2[j].tolist()))
        stars = forest.stars()
        node, links = [], []
        for own, n in ((ids, linked[0]), (ids2, linked[1])):
            at = np.flatnonzero(n)
            node += own[at].tolist()
            links += n[at].astype(np.int64).tolist()
        yield pa.RecordBatch.from_pydict({
            "node": pa.array(node + [x for x, _ in stars], pa.int64()),
            "other": pa.array([None] * len(node) + [r for _, r in stars], pa.int64()),
            "links": pa.array(links + [0] * len(stars), pa.int64()),
        })


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the raw vectors, scaled by powers of two so that no square overflows or vanishes."""
    scale = lambda x: np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return cosines(scale(a), scale(b))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    vec, component = F.nullif("key", F.lit(NULL_ID)), F.nullif("component", F.lit(NULL_ID))
    return found.select(vec.alias("vec_id"), "n_links", component.alias("component_id"), (F.col("key") == F.col("component")).alias("kept"))


QUERIES = {"op7_embeddings": op7_embeddings}
ORACLES = {
    "op7_embeddings": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
roots AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN roots USING (r) LEFT JOIN counts USING (r)
"""
}
