"""Sharding along a Hilbert curve over several metadata dimensions, by DataFrame functions alone.

Each dimension is quantised to 2**BITS levels between its approximate quantiles (a string by its first
seven bytes as a number, so that order is kept; null: lowest level). The cell's place on the Hilbert
curve orders the rows, equal texts of a cell next to each other, and runs of the order are cut into
shards. Neighbours on the curve are near in every dimension, so the files of a shard have narrow
minima and maxima in all of them and a filter on any prunes files.

The law is ``rows``: the shards' row counts differ by one at most. Ties of everything are broken
by doc_id; rows that are repeated altogether are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ._common import doc_key, fresh, partitions, written

BITS = 5
SHARDS = 24
#: Bytes of a row besides its text.
ROW_BYTES = 8


def hilbert_index(levels: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a cell, given by one level of ``bits`` bits a dimension."""
    n = len(levels)
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]

    def turn(x: Column, step: Column) -> Column:
        # reflect or exchange the lower bits of dimensions 0 and i by bit q of dimension i
        q, i = step["q"], step["i"]
        mine, first = F.get(x, i), F.get(x, F.lit(0))
        is_set = mine.bitwiseAND(q) != 0
        t = F.when(is_set, q - 1).otherwise(first.bitwiseXOR(mine).bitwiseAND(q - 1))
        return F.transform(x, lambda v, j: F.when((j == 0) | ((j == i) & ~is_set & (i != 0)), v.bitwiseXOR(t)).otherwise(v))

    x = F.array(*[c.cast("long") for c in levels])
    if steps:
        x = F.aggregate(F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q, i in steps]), x, turn)
    # Gray code: dimension i takes in those before it, then all take in the flips of the last
    x = F.transform(x, lambda _, j: F.aggregate(F.slice(x, F.lit(1), j + 1), F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v)))
    # interleave, the highest bits first
    flips = lambda last: F.aggregate(
        F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]),
        F.lit(0).cast("long"),
        lambda a, q: F.when(last.bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a),
    )
    x = F.aggregate(F.array(x), F.array().cast("array<long>"), lambda _, g: F.transform(g, lambda v: v.bitwiseXOR(flips(F.get(g, F.lit(n - 1))))))
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    gather = lambda g: F.aggregate(
        places, F.lit(0).cast("long"), lambda a, p: a * 2 + F.when(F.get(g, p["i"]).bitwiseAND(F.element_at(F.array(*[F.lit(1 << b).cast("long") for b in range(bits)]), p["b"] + 1)) != 0, 1).otherwise(0)
    )
    return F.get(F.transform(F.array(x), gather), F.lit(0))


def _number(df: DataFrame, name: str) -> Column:
    """A dimension as a number in the same order."""
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        head = F.substring(F.col(name).cast("binary"), 1, 7)
        return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def assign(docs: DataFrame, keep: list[str], dimensions: list[str] | None = None, shards: int = SHARDS, bits: int = BITS, name: str = "_pw") -> DataFrame:
    """``keep`` columns and a struct ``name``: size, text_crc32, law, shard, slot, grown_shard (null by this law), hilbert.

    ``dimensions``: columns that order the rows; by default those of source and lang that are there,
    and the size, so that equal texts of one source and language are neighbours (a group is cut only where a shard ends).
    """
    keep = [c for c in keep if c != name]
    named = dimensions if dimensions is not None else [c for c in ("source", "lang") if c in docs.columns]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    slim = written(
        docs.select(
            F.struct(*[f"`{c}`" for c in keep]).alias("kept") if keep else F.lit(None).cast("struct<none:int>").alias("kept"),
            doc_key().alias("key"), size.alias("size"), F.crc32(text.cast("binary")).alias("crc"),
            F.array(*[_number(docs, c) for c in named], size.cast("double")).alias("dims"),
        ),
        "shard-keys",
    )
    n_dims = len(named) + 1
    levels = 1 << bits
    cuts = slim.select(*[F.percentile_approx(F.col("dims")[i], [k / levels for k in range(1, levels)], 10_000).alias(f"d{i}") for i in range(n_dims)]).first()
    level = [
        F.coalesce(sum([(F.col("dims")[i] > float(c)).cast("int") for c in cuts[i] or []] or [F.lit(0)], F.lit(0)), F.lit(0))
        for i in range(n_dims)
    ]
    placed = written(slim.withColumn("hilbert", hilbert_index(level, bits)).drop("dims"), "shard-index")  # the curve once, before ranges are sampled
    ordered = written(
        placed
        .repartitionByRange(partitions(docs.sparkSession), "hilbert", "crc", "size", "key")
        .sortWithinPartitions("hilbert", "crc", "size", "key")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "shard-order",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"))  # a row per partition
    total = counts.agg(F.sum("n")).first()[0] or 0
    bases = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.col("base") + F.col("place")
    shard = F.expr(f"((base + place) * {shards}L) div {max(total, 1)}L")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return (
        ordered.join(F.broadcast(bases) if partitions(docs.sparkSession) <= 100_000 else bases, "part")
        .withColumn("shard", shard)
        .select(
            *[F.col(f"kept.`{c}`").alias(c) for c in keep],
            F.struct(
                "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                (rank - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert",
            ).alias(name),
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, rows_per_file: int = 1_000_000) -> None:
    """Writes all columns as files of Parquet, one folder a shard, each file a run of the curve; a column named shard gives way to the folders'."""
    name = fresh(docs.columns)
    run = fresh([*docs.columns, name], "_run")
    found = assign(docs, docs.columns, shards=shards, name=name)
    (
        found.withColumn("shard", F.col(name)["shard"])
        .withColumn(run, F.floor(F.col(name)["slot"] / rows_per_file))
        .repartition(partitions(docs.sparkSession), "shard", run)
        .sortWithinPartitions("shard", F.col(name)["slot"])
        .drop(run, name)
        .write.partitionBy("shard")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    return found.select("doc_id", *[f"_pw.{c}" for c in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")])


QUERIES = {"op5_hilbert_shards": op5_hilbert_shards}
ORACLES: dict[str, str] = {}
