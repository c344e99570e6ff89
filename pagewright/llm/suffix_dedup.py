"""Suffix-array dedup: later copies of long byte strings go, the first stays.

A byte of a document (its text as UTF-8) is removed if a string of ``length`` bytes that covers it also
starts earlier: in a document with a smaller doc_id, or earlier in the same one. Matches don't cross
documents; they are judged on the input, not on what is left.

``_repeats`` brings every string together with its equals; where their contexts differ, a suffix array
of the contexts decides: the suffixes are sorted as far as ``length`` bytes, with the length that neighbours share, the
previous and the next smaller position in suffix order give each suffix its longest previous factor (up to ``length``), and
the bytes of factors of ``length`` go. Equal contexts are runs in that order already, told by their hashes (192 bits); the same
rule decides there.

A null text is an empty one. Rows that repeat doc_id and text are one document and get its result each; rows
that repeat a doc_id with different texts are ordered by the texts' hashes; null ids sort first. An
empty table gives no rows. Text that remains may have lost parts of a character at a cut; such bytes are
left out of the text ``clean`` gives.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import few_files, flush, from_key
from ._repeats import Units, longest_previous_factor, merge, repeats

LENGTH = 100
#: Bytes of the grams that bring strings together.
GRAM = 32


def suffix_array(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` (each with ``length`` bytes) in the order of their first ``length`` bytes, ties by place in
    ``starts``, and for each how many of those bytes it shares with the one before."""
    m = len(starts)
    order, shares, lcp = np.arange(m), np.ones(m, bool), np.full(m, length, np.int32)
    if not m:
        return order, lcp
    shares[0], lcp[0] = False, 0
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    window = np.lib.stride_tricks.sliding_window_view(padded, 8)
    for at in range(0, length, 8):
        open_ = shares.copy()
        open_[:-1] |= shares[1:]
        active = np.flatnonzero(open_)  # suffixes still tied with a neighbour
        if not len(active):
            break
        suffixes, tie = order[active], np.cumsum(~shares)[active]
        head = np.ascontiguousarray(window[starts[suffixes] + at]).view(">u8").reshape(-1).astype(np.uint64)
        if at + 8 > length:
            head &= np.uint64((1 << 64) - (1 << 8 * (at + 8 - length)))
        by = np.lexsort((suffixes, head, tie))
        order[active] = suffixes[by]
        head, tie = head[by], tie[by]
        tied = np.concatenate([[False], tie[1:] == tie[:-1]])
        differs = np.concatenate([np.zeros(1, np.uint64), head[1:] ^ head[:-1]])
        parted = np.flatnonzero(tied & (differs != 0))
        bits = np.frexp((differs[parted] >> np.uint64(11)).astype(np.float64))[1] + 11  # of the highest that differs, exact but for the lowest 11
        small = differs[parted] < np.uint64(1 << 11)
        bits[small] = np.frexp(differs[parted][small].astype(np.float64))[1]
        lcp[active[parted]] = at + (64 - bits) // 8
        shares[active] = tied & (differs == 0)
    return order, lcp


def earlier_matches(contexts: list[tuple[int, int, int, int, bytes]], length: int) -> list[tuple[int, int, int, int]]:
    """Runs (key, th, start, end) covered by strings that start earlier, among contexts (gram, key, th, start, bytes)."""
    contexts = [c for c in contexts if len(c[4]) >= length]
    if not contexts:
        return []
    data = np.frombuffer(b"".join(c[4] for c in contexts), np.uint8)
    sizes = np.array([len(c[4]) for c in contexts])
    base = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    which = np.repeat(np.arange(len(contexts)), counts)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    ids = sorted({c[1:3] for c in contexts})
    number = {d: i for i, d in enumerate(ids)}
    document = np.array([number[c[1:3]] for c in contexts])
    place = (document[which] << 32) + np.array([c[3] for c in contexts])[which] + offset  # in the order of the whole corpus
    order, lcp = suffix_array(data, base[which] + offset, length)
    hit = order[longest_previous_factor(place[order], lcp) >= length]
    if not len(hit):
        return []
    place = np.unique(place[hit])
    start, end = merge(place, place + length)
    return [(*ids[a >> 32], int(a & 0xFFFFFFFF), int((a & 0xFFFFFFFF) + b - a)) for a, b in zip(start.tolist(), end.tolist())]


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, carry: list[Column] | None = None) -> DataFrame:
    """doc_id, kept (binary: the remaining bytes), n_bytes, n_removed, n_spans and spans (binary, pairs of little-endian 32-bit numbers) a document, and a struct ``carried`` of ``carry``."""
    found = _removed(docs, length, gram, pa.binary(), carry)
    return found.select(from_key(F.col("key")).alias("doc_id"), "kept", "n_bytes", "n_removed", "n_spans", "spans", "carried")


def _removed(docs: DataFrame, length: int, gram: int, kind: pa.DataType, carry: list[Column] | None) -> DataFrame:
    """``dedup`` with ``kept`` as bytes or, for ``kind`` string, as text without broken characters."""
    as_text = pa.types.is_string(kind)
    schema = pa.schema([("key", pa.int64()), ("kept", kind), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.binary())])

    def finish(keys, texts, spans) -> pa.RecordBatch:
        out: list[list] = [[] for _ in schema]
        for key, text, runs in zip(keys, texts, spans):
            parts, at = [], 0
            for a, b in runs.tolist():
                parts.append(text[at:a])
                at = b
            parts.append(text[at:])
            kept = b"".join(parts)
            shown = kept.decode("utf-8", "ignore") if as_text else kept
            for column, x in zip(out, (key, shown, len(text), len(text) - len(kept), len(runs), runs.astype("<i4").tobytes())):
                column.append(x)
        return flush(out, schema)

    ddl = f"key long, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long, spans binary"
    return repeats(docs, Units("bytes", length, min(gram, length)), True, lambda c: earlier_matches(c, length), finish, ddl, carry)


def clean(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with the columns they had and the text that remains; n_chars, where there is one, is counted anew. Documents that are left empty stay."""
    others = [c for c in docs.columns if c != "text"]  # the text itself isn't carried along
    row = F.struct(*others) if others else F.lit(None).cast("int")
    found = _removed(docs, length, GRAM, pa.string(), [row.alias("row"), F.col("text").isNull().alias("no_text")])
    text = F.when(~F.col("carried.no_text"), F.col("kept"))
    out = {"text": text} | ({"n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return found.select(*[out[c].alias(c) if c in out else F.col(f"carried.row.`{c}`").alias(c) for c in docs.columns])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return few_files(found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLES = {
    "op2_suffix_dedup": f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
m AS (SELECT doc_id, list_transform(range(0, greatest(length(h) // 2 - {LENGTH - 1}, 0)), lambda i: md5_number(substr(h, 2 * i + 1, {2 * LENGTH}))) AS ms FROM d),
w AS (SELECT doc_id, unnest(ms) AS m, generate_subscripts(ms, 1) - 1 AS i FROM m),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM w),
r AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {LENGTH} THEN 0 ELSE 1 END AS new FROM f WHERE k > 1),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
s AS (SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS b FROM g GROUP BY doc_id, run),
t AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM s),
k AS (SELECT doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) || substr(max(h), 2 * max(b) + 1) AS kept, sum(b - a) AS removed, count(*) AS spans FROM t JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
}
