"""Substring dedup with suffix automata: every copy of a long run of words goes.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word of a document is removed if a window of ``length``
consecutive words that covers it also starts anywhere else, in the same document or another. Windows are judged on
the input, not on what is left.

Automata of every shard of the corpus, broadcast to every task, would take work and memory by the
square of the corpus. So ``_repeats`` first brings together those stretches that can share a window: each
bucket of them is a reference shard with an automaton of its own, and the stretches of all documents that have any part in it
stream through for their matching statistics. A window that ends where the statistic reaches ``length`` repeats if its state
ends at two places or more; maximal spans of such windows go. Stretches that are equal altogether are told by their hashes (192 bits)
before, and one goes on.

A null text has no words. Rows that repeat doc_id and text are one document (not a copy of each other) and get its result
each; null ids sort first. An empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import few_files, from_key
from ._repeats import Units, repeats

LENGTH = 35
#: Words of the grams that bring stretches together.
GRAM = 15


class SuffixAutomaton:
    """Of several sequences of numbers from 0 on; knows at how many places each string ends."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]
        self.last = 0
        self.ended = 0

    def add(self, sequence: list[int]) -> None:
        """Adds the sequence and a separator that occurs nowhere else."""
        self.ended += 1
        follow, link, length, places, last = self.next, self.link, self.length, self.places, self.last
        for c in (*sequence, -self.ended):
            now = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            places.append(1)
            p = last
            while p != -1 and c not in follow[p]:
                follow[p][c] = now
                p = link[p]
            if p != -1:
                q = follow[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    clone = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    places.append(0)
                    while p != -1 and follow[p].get(c) == q:
                        follow[p][c] = clone
                        p = link[p]
                    link[q] = link[now] = clone
            last = now
        self.last = last

    def count(self) -> None:
        """Places of a state are also places of its suffixes; call once, after the last ``add``."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.places[self.link[v]] += self.places[v]

    def repeated_ends(self, sequence: list[int], window: int) -> list[int]:
        """Where windows end that occur at two places or more: matching statistics, kept to ``window`` words."""
        follow, link, length, places = self.next, self.link, self.length, self.places
        v, matched, ends = 0, 0, []
        for i, c in enumerate(sequence):
            while v and c not in follow[v]:
                v = link[v]
                matched = length[v]
            if c in follow[v]:
                v = follow[v][c]
                matched += 1
            while v and length[link[v]] >= window:
                v = link[v]
                matched = length[v]
            if matched >= window and places[v] > 1:
                ends.append(i + 1)
        return ends


def repeated_runs(contexts: list[tuple[int, int, int, int, bytes]], window: int) -> list[tuple[int, int, int, int]]:
    """Runs (key, th, start, end) of words in windows that occur at two places, among contexts (gram, key, th, start, words)."""
    stretches: list[tuple[int, int, int, list[bytes]]] = []
    runs = []
    for _, key, th, start, text in sorted(contexts, key=lambda c: c[1:4]):
        words = text.split()
        if stretches and stretches[-1][:2] == (key, th) and start <= stretches[-1][2] + len(stretches[-1][3]):
            mine = stretches[-1]
            mine[3].extend(words[mine[2] + len(mine[3]) - start :])  # the same place once
        else:
            stretches.append((key, th, start, words))
    automaton, numbers = SuffixAutomaton(), {}
    coded = [[numbers.setdefault(w, len(numbers)) for w in s[3]] for s in stretches]
    for c in coded:
        automaton.add(c)
    automaton.count()
    for (key, th, start, _), c in zip(stretches, coded):
        first = last = None
        for end in automaton.repeated_ends(c, window):
            if last is None or end - window > last:
                if last is not None:
                    runs.append((key, th, start + first, start + last))
                first = end - window
            last = end
        if last is not None:
            runs.append((key, th, start + first, start + last))
    return runs


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, kept (binary: the remaining words joined by a space), n_words, n_removed and spans (binary, pairs of little-endian 32-bit numbers) a document."""
    names = ("key", "kept", "n_words", "n_removed", "spans")

    def finish(keys, texts, spans) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        for key, text, runs in zip(keys, texts, spans):
            words = text.split()
            kept, at = [], 0
            for a, b in runs.tolist():
                kept += words[at:a]
                at = b
            kept += words[at:]
            for column, x in zip(out, (key, b" ".join(kept), len(words), len(words) - len(kept), runs.astype("<i4").tobytes())):
                column.append(x)
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=list(names))

    found = repeats(docs, Units("words", length, min(gram, length)), False, lambda c: repeated_runs(c, length), finish, "key long, kept binary, n_words long, n_removed long, spans binary")
    return found.select(from_key(F.col("key")).alias("doc_id"), *names[1:])


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return few_files(found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")))


QUERIES = {"op3_substring_dedup": op3_substring_dedup}
ORACLES = {
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
m AS (SELECT doc_id, list_transform(range(0, greatest(len(ws) - {LENGTH - 1}, 0)), lambda i: md5_number(array_to_string(ws[i + 1:i + {LENGTH}], ' '))) AS ms FROM d),
w AS (SELECT doc_id, unnest(ms) AS m, generate_subscripts(ms, 1) - 1 AS i FROM m),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY m) AS n FROM w),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM f, range({LENGTH}) AS o(k) WHERE n > 1),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM d),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) FILTER (c.i IS NULL) AS kept, count(c.i) AS removed FROM p LEFT JOIN c ON c.doc_id = p.doc_id AND c.i = p.i GROUP BY p.doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
}
