"""SimHash near-duplicates by covering locality-sensitive hashing.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case; a shingle is three consecutive
words joined by a space (the whole sequence if there are fewer), repeats included. A bit of the 64-bit
fingerprint is set if more than half of the shingles' XXH64 values (seed 42) have it set; without words
it is zero.

Covering hashing (Pagh, 2016) for radius r: each bit position gets a non-zero vector of r + 1 bits, and
table v, for each non-zero v of r + 1 bits, keeps the positions whose vector has an odd product with
v. The vectors of the r or fewer positions in which two fingerprints differ leave some v orthogonal to
all of them, so the pair agrees on all that table v keeps: every pair within the radius collides
in one of 2**(r+1) - 1 tables, with certainty.

Equal fingerprints are one node. A bucket of two is compared directly. The members of larger buckets,
whatever their size, are linked without pairs: each meets, at every value one bit away from it and
at its own, the smallest fingerprint that does, and two are within two bits exactly if such a value
is common to them. Components of the links follow; the smallest doc_id names one.

A null text is an empty one. Rows that are repeated get the same result each. A null doc_id counts as
smaller than any other and is given back as null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import doc_key, flush, fresh, from_key, merged, rows, text_bytes, tidy, written
from ._components import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Shingles hashed at once.
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        slices = [joined[a:b] for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])]
        digests = b"".join(map(xxhash.xxh64_digest, slices, repeat(SEED)))
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The 2**(radius+1) - 1 masks: table v keeps the positions whose vector has an odd product with v."""
    vectors = (1 << radius + 1) - 1
    return [sum(1 << i for i in range(bits) if ((i % vectors + 1) & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@tidy
def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("th", pa.int64()), ("fp", pa.int64())])
    out: list[list] = [[], [], []]
    for key, th, text in rows(batches):
        for column, x in zip(out, (key, th, _signed(fingerprint(text)))):
            column.append(x)
        if len(out[0]) >= 4096:
            yield flush(out, schema)
    yield flush(out, schema)


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all within two bits of one another."""
    masks = [_signed(m) for m in covering_masks()]
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("masked")) for t, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(tables).alias("e")).select("fp", "e.t", "e.masked")
    buckets = written(keyed.groupBy("t", "masked").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "buckets", 8)
    pairs = buckets.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).select("a", "b")
    members = keyed.join(buckets.where("n > 2").select("t", "masked"), ["t", "masked"]).select("fp").distinct()
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    met = members.select("fp", F.explode(near).alias("z"))
    least = met.groupBy("z").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)  # 65 members at most
    return pairs.union(least.select("a", F.explode("all").alias("b")).where("a != b").distinct())


def _keyed(docs: DataFrame, key: str = "key", th: str = "th") -> DataFrame:
    """``docs`` with ``key`` (doc_id, NULL_ID for null) and ``th`` (hash of the text)."""
    return docs.withColumns({key: doc_key(), th: F.xxhash64(text_bytes())})


def components(docs: DataFrame) -> DataFrame:
    """key (doc_id, NULL_ID for null), th, fp (signed), component (the smallest key of its component) and component_th (that of the smallest key, then hash), a row per row of ``docs``."""
    texts = _keyed(docs.select("doc_id", "text")).select("key", "th", text_bytes().alias("text"))
    found = written(texts.mapInArrow(_fingerprints, "key long, th long, fp long"), "fingerprints")
    distinct = found.groupBy("fp").agg(F.min(F.struct("key", "th")).alias("least"))
    roots = connected_components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    grouped = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = grouped.groupBy("root").agg(F.min("least").alias("first"))
    return merged(found.join(grouped.select("fp", "root").join(named, "root").select("fp", F.col("first.key").alias("component"), F.col("first.th").alias("component_th")), "fp"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component, with the columns it had: that with the smallest doc_id (then text hash); of rows that repeat both, one.

    Keys alone decide; the rows move once, to meet the keys that stay, in as many tasks as their bytes call for.
    """
    key, th = fresh(docs.columns, "_key"), fresh(docs.columns, "_th")
    kept = components(docs).where("key = component and th = component_th").select(F.col("key").alias(key), F.col("th").alias(th)).distinct()
    return _keyed(docs, key, th).join(written(kept, "kept"), [key, th], "left_semi").dropDuplicates([key, th]).drop(key, th)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(from_key(F.col("key")).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), from_key(F.col("component")).alias("component_id"))


QUERIES = {"op4_simhash": op4_simhash}
ORACLES: dict[str, str] = {}
