"""Token-id files with directly addressable codes.

A segment holds the ids of consecutive documents. Every id is split into chunks of eight bits, the
lowest first. Level k stores the k-th chunk of those ids that have one, and a bitmap with a set bit
where the id goes on to level k + 1; a rank directory counts the set bits before each 512-bit block.
The place of an id in level k + 1 is the rank of its bit in level k, so any id is reached by one
byte and one rank a level, without decoding its neighbours.

Segment layout, little-endian: magic ``DAC1``, u32 levels, u64 ids; for each level u64 entries,
entries bytes of chunks, then (but for the last level) ceil(entries / 512) u32 ranks and
64 bytes of bitmap for each such block.

``write_token_files`` gives the documents' ids in ascending doc_id order (null first; equal ids by the
text's CRC-32): the ids of bucket b come before those of bucket b + 1, segment s before s + 1. Texts become ids where they
are read; ids alone are shuffled, two bytes each where all of a document fit.
``read_token_files`` reads them back; ``tokens_at`` gives single tokens of documents: the directory says which segment holds one, and of
those segments each token takes a byte and a rank a level. A null text has the end id alone; an empty table gives no
rows; repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import doc_key, few_files, flush, from_key, partitions, rows, scratch, text_bytes, tidy, written
from ._tokens import encoder, in_groups, vocabulary

MAGIC = b"DAC1"
BLOCK_BITS = 512
#: A segment ends with the document that brings it to so many ids.
SEGMENT_IDS = 1 << 17
#: Rows that repeat an id and a text may go to so many buckets.
SALTS = 1 << 16
#: Segments that are named to the reader of a table; more are joined.
NAMED = 1000

#: ``before``: ids of the bucket that stand before the segment.
_SEGMENT = "bucket int, segment int, before long, n_ids long, doc_ids binary, lengths binary, payload binary"


def dac_encode(ids: np.ndarray) -> bytes:
    """The segment of unsigned 32-bit ids."""
    rest = ids.astype(np.uint32)
    levels = max(1, -(-int(rest.max(initial=0)).bit_length() // 8))
    out = [MAGIC, struct.pack("<IQ", levels, len(rest))]
    for level in range(levels):
        out += [struct.pack("<Q", len(rest)), (rest & 0xFF).astype(np.uint8).tobytes()]
        if level < levels - 1:
            more = rest > 0xFF
            bits = np.zeros(-(-len(more) // BLOCK_BITS) * BLOCK_BITS, bool)
            bits[: len(more)] = more
            counts = bits.reshape(-1, BLOCK_BITS).sum(1)
            out += [(np.cumsum(counts) - counts).astype("<u4").tobytes(), np.packbits(bits, bitorder="little").tobytes()]
            rest = rest[more] >> 8
    return b"".join(out)


class DacReader:
    """Random access to a segment, and all of it at once."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        levels, self.n = struct.unpack_from("<IQ", payload, 4)
        at, self.levels = 16, []
        for level in range(levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            chunks = np.frombuffer(payload, np.uint8, n, at + 8)
            at += 8 + n
            ranks = bitmap = None
            if level < levels - 1:
                blocks = -(-n // BLOCK_BITS)
                ranks = np.frombuffer(payload, "<u4", blocks, at)
                bitmap = np.frombuffer(payload, np.uint8, blocks * BLOCK_BITS // 8, at + 4 * blocks)
                at += blocks * (4 + BLOCK_BITS // 8)
            self.levels.append((chunks, ranks, bitmap))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, ranks, bitmap) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK_BITS
            head = bitmap[block * BLOCK_BITS // 8 : i >> 3]
            last = int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(ranks[block]) + int(np.bitwise_count(head).sum()) + last.bit_count()
        return value

    def all(self) -> np.ndarray:
        values = np.zeros(self.n, np.uint32)
        places = None
        for level, (chunks, _, bitmap) in enumerate(self.levels):
            part = chunks.astype(np.uint32) << np.uint32(8 * level)
            if places is None:
                values |= part
            else:
                values[places] |= part
            if bitmap is not None:
                more = np.flatnonzero(np.unpackbits(bitmap, count=len(chunks), bitorder="little"))
                places = more if places is None else places[more]
        return values


def _packed(ids: bytes) -> bytes:
    """Little-endian ids in two bytes each after a zero byte, or as they are after a one."""
    wide = np.frombuffer(ids, "<u4")
    return b"\0" + wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else b"\1" + ids


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 0 else "<u4", offset=1).astype("<u4")


def _cuts(keyed: DataFrame, n: int) -> list[tuple[int, int, int]]:
    """Where n buckets of about as many documents begin, by (key, crc, salt), from some hundred rows a bucket."""
    total = keyed.count()
    rate = min(1.0, 100.0 * n / max(1, total))
    some = keyed.where(F.rand(7) < rate).select("key", "crc", F.floor(F.rand(11) * SALTS).cast("long").alias("salt")).collect()
    some = sorted(map(tuple, some))
    return [some[i * len(some) // n] for i in range(1, n)] if some else []


@tidy
def _encoded(batches: Iterator[pa.RecordBatch], path: str, kind: str, end_id: int, cuts: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    """bucket, key, crc, salt, ids: the salt of a row, by its place in the task, deals rows that repeat to several buckets."""
    from pyspark import TaskContext

    schema = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("crc", pa.int64()), ("salt", pa.int32()), ("ids", pa.binary())])
    encode, end = encoder(path, kind).encode_all, struct.pack("<I", end_id)
    n = TaskContext.get().partitionId() * 2_654_435_761
    for group in in_groups(rows(batches), 2):
        out: list[list] = [[] for _ in schema]
        for (key, crc, _), ids in zip(group, encode([t for _, _, t in group])):
            n += 40_503
            salt = (n ^ n >> 16) % SALTS
            for column, x in zip(out, (bisect_right(cuts, (key, crc, salt)), key, crc, salt, _packed(ids + end))):
                column.append(x)
        yield flush(out, schema)


@tidy
def _segments(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("lengths", pa.binary()), ("payload", pa.binary())])
    segment, before, docs, parts, held = 0, 0, [], [], 0

    def segment_row(bucket: int) -> pa.RecordBatch:
        ids = np.concatenate(parts)
        lengths = np.array([len(p) for p in parts], "<i8").tobytes()
        return flush([[bucket], [segment], [before], [len(ids)], [np.array(docs, "<i8").tobytes()], [lengths], [dac_encode(ids)]], schema)

    for bucket, doc, data in rows(batches):  # of one bucket
        docs.append(doc)
        parts.append(_unpacked(data))
        held += len(parts[-1])
        if held >= most:
            yield segment_row(bucket)
            segment, before, docs, parts, held = segment + 1, before + held, [], [], 0
    if parts:
        yield segment_row(bucket)


@tidy
def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
    for before, doc_ids, lengths, payload in rows(batches):
        ids = DacReader(payload).all().astype("<u4")
        docs, sizes = np.frombuffer(doc_ids, "<i8"), np.frombuffer(lengths, "<i8")
        ends = np.cumsum(sizes)
        for at in range(0, len(docs), 512):
            some = slice(at, at + 512)
            yield flush([docs[some].tolist(), (before + ends[some] - sizes[some]).tolist(), [ids[e - n : e].tobytes() for e, n in zip(ends[some], sizes[some])]], schema)


@tidy
def _directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each document stands: key, bucket, segment, at, n."""
    for bucket, segment, doc_ids, lengths in rows(batches):
        keys, sizes = np.frombuffer(doc_ids, "<i8"), np.frombuffer(lengths, "<i8")
        n = len(keys)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(n, bucket, np.int32)), pa.array(np.full(n, segment, np.int32)), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes)], names=["key", "bucket", "segment", "at", "n"])


@tidy
def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("token", pa.int64())])
    for payload, wanted in rows(batches):
        reader = DacReader(payload)
        yield flush([[w["key"] for w in wanted], [w["place"] for w in wanted], [reader[w["at"] + w["place"]] for w in wanted]], schema)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, kind: str = "word", end_id: int = 1, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the documents' ids as a table of segments.

    A bucket is a range of doc_id, CRC-32 of the text and a salt, numbered in ascending order. Its bounds come from a sample of
    the keys, so texts are encoded once, on the way to their bucket.
    """
    n = partitions(docs.sparkSession)
    keyed = docs.select(doc_key().alias("key"), F.crc32(text_bytes()).alias("crc"), text_bytes().alias("text"))
    cuts = _cuts(keyed.select("key", "crc"), n)
    (
        keyed.mapInArrow(lambda b: _encoded(b, tokenizer_path, kind, end_id, cuts), "bucket int, key long, crc long, salt int, ids binary")
        .repartitionById(n, "bucket")
        .sortWithinPartitions("key", "crc", "salt")
        .select("bucket", "key", "ids")
        .mapInArrow(lambda b: _segments(b, segment_ids), _SEGMENT)
        .write.parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (binary, little-endian unsigned 32-bit)."""
    segments = spark.read.schema(_SEGMENT).parquet(path)
    buckets = segments.groupBy("bucket").agg(F.sum("n_ids").alias("n"))  # a row a range partition, however many documents
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bucket_start"))
    return (
        segments.join(F.broadcast(buckets) if partitions(spark) <= 100_000 else buckets, "bucket")
        .select((F.col("bucket_start") + F.col("before")).alias("before"), "doc_ids", "lengths", "payload")
        .mapInArrow(_documents, "key long, start long, ids binary")
        .select(from_key(F.col("key")).alias("doc_id"), "start", "ids")
    )


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id, place, token of ``wanted`` (doc_id, place: from 0 within the document), for places that a document of that id has.

    Reads the directory, then the segments that hold any of them, and of each the bytes of the tokens wanted.
    """
    segments = spark.read.schema(_SEGMENT).parquet(path)
    directory = segments.select("bucket", "segment", "doc_ids", "lengths").mapInArrow(_directory, "key long, bucket int, segment int, at long, n long")
    asked = wanted.select(doc_key().alias("key"), F.col("place").cast("long").alias("place"))
    found = written(asked.join(directory, "key").where("place >= 0 and place < n"), "wanted")
    where = found.select("bucket", "segment").distinct().limit(NAMED + 1).collect()
    if len(where) <= NAMED:  # so few are named to the reader
        some = F.lit(False)
        for bucket in sorted({w["bucket"] for w in where}):
            some = some | ((F.col("bucket") == bucket) & F.col("segment").isin([w["segment"] for w in where if w["bucket"] == bucket]))
        segments = segments.where(some)
    by_segment = found.groupBy("bucket", "segment").agg(F.collect_list(F.struct("key", "place", "at")).alias("wanted"))
    return (
        segments.select("bucket", "segment", "payload").join(by_segment, ["bucket", "segment"])
        .select("payload", "wanted").mapInArrow(_single, "key long, place long, token long")
        .select(from_key(F.col("key")).alias("doc_id"), "place", "token")
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch(spark, "tokens")
    write_token_files(docs, path, vocabulary("word_bpe_49k.json"))
    return few_files(
        read_token_files(spark, path).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    )


QUERIES = {"op9_token_files": op9_token_files}
ORACLES: dict[str, str] = {}
