"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case. The test strings
are the windows of 13 consecutive words of the items; an item of fewer words is one window. Windows
of one length share a table: the shift of a block of words is its least distance from the end of a
window, so positions that end no window are skipped; a block with shift 0 leads to the bucket of the
windows that end with it, and direct comparison confirms each.

Items of SHARD_BYTES of text together are broadcast. More are dealt to shards by hash, broadcast one by one: documents stream past
every shard once, each task builds a shard's tables once, and what the shards find meets by document. A null text has no
words and is clean; empty and repeated
items change nothing; an item with a null id marks words but isn't counted; an empty benchmark leaves
every document clean. Repeated documents are judged one by one.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ._common import annotate, flush, fresh, lower_alnum_words, rows, tidy, written
from ._repeats import merge

WINDOW = 13
#: Bytes of item texts whose tables a task holds at once, some 75 times as large.
SHARD_BYTES = 2 << 20


class WuManber:
    """Finds every place of every window of the items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.codes: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], frozenset]] = {}
        none: frozenset = frozenset()
        for item, words in items:
            coded = [self.codes.setdefault(w, len(self.codes) + 1) for w in words]
            mine = none if item is None else frozenset([item])
            own = by_length.setdefault(min(window, len(coded)), {})
            for at in range(max(1, len(coded) - window + 1) if coded else 0):
                p = tuple(coded[at : at + window])
                before = own.get(p, none)
                own[p] = mine if not before else before if mine <= before else before | mine
        self.base = len(self.codes) + 1
        self.tables = []
        for length, own in sorted(by_length.items()):
            if not own:
                continue
            block = 3 if length >= 6 else min(2, length)
            shift: dict[int, int] = {}
            for end in range(block, length + 1):  # nearer ends of a window overwrite
                shift.update(dict.fromkeys((self._key(p[end - block : end]) for p in own), length - end))
            buckets: dict[int, list] = {}
            for p, owners in own.items():
                buckets.setdefault(self._key(p[-block:]), []).append((p, owners))
            self.tables.append((length, block, shift, buckets))

    def _key(self, words) -> int:
        key = 0
        for w in words:
            key = key * self.base + w
        return key

    def find(self, words: list[bytes]) -> list[tuple[int, int, frozenset]]:
        """(first word, past the last word, items) of each place."""
        coded = list(map(self.codes.get, words, repeat(0)))
        found, n, base = [], len(coded), self.base
        for length, block, shift, buckets in self.tables:
            get, far, i = shift.get, length - block + 1, length
            while i <= n:
                if block == 3:
                    key = (coded[i - 3] * base + coded[i - 2]) * base + coded[i - 1]
                elif block == 2:
                    key = coded[i - 2] * base + coded[i - 1]
                else:
                    key = coded[i - 1]
                step = get(key, far)
                if step:
                    i += step
                    continue
                start = i - length
                first, here = coded[start], None
                for pattern, owners in buckets[key]:
                    if pattern[0] == first:
                        here = here or tuple(coded[start:i])
                        if here == pattern:
                            found.append((start, i, owners))
                            break  # patterns differ from one another
                i += 1
        return found


_FIELDS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<long>"


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").cast("binary").alias("t")).where("t is not null").distinct()


def _tables(items: list[tuple[str | None, bytes]], window: int) -> WuManber:
    return WuManber([(i, lower_alnum_words(t)) for i, t in items], window)


def _judged(n_words: int, edges: list[tuple[int, int]], items: set[str], share: int) -> tuple:
    """The fields of a document, from the places and owners of windows in it."""
    steps = np.zeros(n_words + 1, np.int64)
    for start, end in edges:
        steps[start] += 1
        steps[end] -= 1
    hit = np.cumsum(steps) > 0
    n_hit = int(hit.sum())
    bounds = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).tolist() if n_hit else []
    sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return (n_words, n_hit, len(items), sha, n_hit > 0 and share * n_hit >= n_words, bounds)


def flag(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, share: int = 20, name: str = "_pw") -> DataFrame:
    """``keep`` columns and a struct ``name``: n_words, n_hit, n_items, items_sha256, contaminated, spans (starts and ends of runs of hit words).

    A document is contaminated if at least one word in ``share`` is hit.
    """
    spark = docs.sparkSession
    items = _items(benchmark)
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if total > SHARD_BYTES:
        return _flag_by_shards(docs, items, -(-2 * total // SHARD_BYTES), keep, window, share, name)
    shard = spark.sparkContext.broadcast([(r.i, bytes(r.t)) for r in items.collect()])  # SHARD_BYTES at most

    def make():
        tables = _tables(shard.value, window)

        def work(texts: list[bytes | None]) -> list[tuple]:
            out = []
            for text in texts:
                words = lower_alnum_words(text or b"")
                found = tables.find(words)
                out.append(_judged(len(words), [f[:2] for f in found], set().union(*(f[2] for f in found)), share))
            return out

        return work

    return annotate(docs, keep, _FIELDS, make, name)


def _flag_by_shards(docs: DataFrame, items: DataFrame, shards: int, keep: list[str], window: int, share: int, name: str) -> DataFrame:
    """``flag`` with the items dealt to so many shards, each about half of SHARD_BYTES."""
    spark = docs.sparkSession
    keep = [c for c in keep if c != name]
    taken = [*docs.columns, name, "text"]
    rid, found = fresh(taken, "_rid"), fresh(taken, "_found")
    text = fresh(taken, "_words_of")
    # a row's number is fixed once it is written
    held = written(docs.select(*[f"`{c}`" for c in keep], F.col("text").cast("string").cast("binary").alias(text)).withColumn(rid, F.monotonically_increasing_id()), "contamination")
    kind = "rid long, edges array<long>, items array<string>"

    def search(k: int):
        shard = spark.sparkContext.broadcast([(r.i, bytes(r.t)) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == k).collect()])

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = _tables(shard.value, window)
            schema = pa.schema([("rid", pa.int64()), ("edges", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
            out: list[list] = [[] for _ in schema]
            for row, words in rows(batches):
                places = tables.find(lower_alnum_words(words or b""))
                if places:
                    start, end = merge(np.array([p[0] for p in places]), np.array([p[1] for p in places]))
                    for column, x in zip(out, (row, np.stack([start, end], 1).reshape(-1).tolist(), sorted(set().union(*(p[2] for p in places))))):
                        column.append(x)
                if len(out[0]) >= 1024:
                    yield flush(out, schema)
            yield flush(out, schema)

        return held.select(rid, text).mapInArrow(run, kind)

    hits = functools.reduce(DataFrame.unionAll, [search(k) for k in range(shards)])  # rows of documents with a window alone
    by_row = hits.groupBy("rid").agg(F.flatten(F.collect_list("edges")).alias("edges"), F.flatten(F.collect_list("items")).alias("items"))
    joined = held.join(by_row.select(F.col("rid").alias(rid), F.struct("edges", "items").alias(found)), rid, "left")

    @tidy
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for words, places in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    edges = np.array(places["edges"] if places else [], np.int64).reshape(-1, 2)
                    out.append(_judged(len(lower_alnum_words(words or b"")), edges.tolist(), set(places["items"] if places else ()), share))
                kinds = [to_arrow_type(f.dataType) for f in schema_of]
                structs = pa.StructArray.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], schema_of.names)
                yield pa.RecordBatch.from_arrays([*part.columns[2:], structs], names=[*keep, name])

    schema_of = _parse_datatype_string(_FIELDS)
    return joined.select(text, found, *[f"`{c}`" for c in keep]).mapInArrow(finish, StructType([*held.select(*[f"`{c}`" for c in keep]).schema, StructField(name, schema_of)]))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with the columns they had."""
    name = fresh(docs.columns)
    return flag(docs, benchmark, docs.columns, name=name).where(~F.col(name)["contaminated"]).drop(name)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = flag(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
    return found.select("doc_id", "_pw.n_words", "_pw.n_hit", "_pw.n_items", "_pw.items_sha256", "_pw.contaminated")


QUERIES = {"op8_decontamination": op8_decontamination}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES = {
    "op8_decontamination": f"""
WITH b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (SELECT item_id, least(len(ws), {WINDOW}) AS n, unnest(range(0, greatest(len(ws) - {WINDOW - 1}, 1))) AS i, ws FROM b WHERE len(ws) > 0),
items AS (SELECT DISTINCT item_id, n, array_to_string(ws[i + 1:i + n], ' ') AS s FROM iw),
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
dm AS (SELECT doc_id, n, list_transform(range(0, greatest(len(ws) - n + 1, 0)), lambda i: md5_number(array_to_string(ws[i + 1:i + n], ' '))) AS ms FROM d, (SELECT DISTINCT n FROM items)),
dw AS (SELECT doc_id, n, unnest(ms) AS m, generate_subscripts(ms, 1) - 1 AS i FROM dm),
hits AS (SELECT dw.doc_id, dw.i, dw.n, items.item_id FROM dw JOIN (SELECT *, md5_number(s) AS m FROM items) items USING (n, m)),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits), range({WINDOW}) AS o(k) WHERE k < n GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN owners USING (doc_id)
"""
}
