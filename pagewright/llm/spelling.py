"""Spelling variants of words, grouped by a symmetric-delete join.

Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of the whole texts, with A-Z in lower case. Where 97 divides the unsigned CRC-32 h of
``<doc_id>:<run>``, one code point of the run goes, that at h % length. The vocabulary is made of the results that have at least five code points and occur
at least three times.

Two words are near if they differ by one inserted, deleted or replaced code point. Every word emits itself and its distinct
single deletions, each as a hash with the run of equal code points that the deleted one stands in. Deletions of two words meet
at the same place exactly if one code point is replaced, and a deletion meets a whole word if one is inserted, so the join compares these runs
too: every near pair comes out of it once, and no pair that shares a key at different places. What the join gives is then
verified on the words themselves (``levenshtein``).

The near words of a word are aggregated: their number and the most frequent one (ties: the smallest in code-point order), which is its form if it
occurs at least twice as often. Forms lead to forms; roots are found by pointer jumping, each round a join and a table in the
shared folder. Frequencies double at every step, so a way has at most 63 of them and six rounds are enough.

A null text has no words. A null doc_id is written as nothing before the colon. Repeated rows count each. A text or a word may be as long as it likes: a word
emits as many hashes as it has runs of equal code points, not as many copies of itself. An empty table, or one without words that
are frequent enough, gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import remove, scratch, tidy, written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ONE_IN = 97
MIN_LENGTH = 5
MIN_COUNT = 3
#: A form occurs so many times as often at least.
RATIO = 2
#: The whole word's place among its keys: it meets every deletion.
ANYWHERE = (0, 2**31 - 1)
#: Odd base of the polynomial hashes, modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def thinned(word: Column, doc_id: Column, one_in: int) -> Column:
    """``word``, without its code point h % length where ``one_in`` divides h."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    less = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(h % one_in == 0, less).otherwise(word)


def vocabulary(docs: DataFrame, one_in: int = ONE_IN, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: every word of ``docs`` that is long and frequent enough."""
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("word"))
    words = runs.select(thinned(F.col("word"), F.col("doc_id"), one_in).alias("word")).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def keys_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word's index, hash, first, last place) of each distinct single deletion of each word, then of each whole word.

    A deletion's hash is the sum of what stands before it and of what stands behind, a place further to the front, so all
    of a word come from running sums.
    """
    n, lengths = len(words), np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lengths)
    starts, own, here = ends - lengths, np.repeat(np.arange(n), lengths), np.arange(len(points))
    at = here - starts[own]
    powers = np.cumprod(np.full(max(1, int(lengths.max(initial=0))), BASE, np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((points + np.uint64(1)) * powers[at])])  # modulo 2**64
    hashes = sums[here] - sums[starts[own]] + (sums[ends[own]] - sums[here + 1]) * np.uint64(INVERSE)
    first = np.ones(len(points), bool)
    first[1:] = (points[1:] != points[:-1]) | (own[1:] != own[:-1])
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(points))[: len(heads)] - 1
    of = np.concatenate([own[heads], np.arange(n)])
    return of, np.concatenate([hashes[heads], sums[ends] - sums[starts]]), np.concatenate([at[heads], np.full(n, ANYWHERE[0])]), np.concatenate([at[tails], np.full(n, ANYWHERE[1])])


@tidy
def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, words = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        at = 0
        while at < len(words):
            to, points = at, 0
            while to < len(words) and points < 1 << 18:  # so many code points at once, or one word
                points += len(words[to])
                to += 1
            of, hashes, first, last = keys_of(words[at:to])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (hashes.view(np.int64), ids[at:to][of], first.astype(np.int32), last.astype(np.int32))], names=["key", "id", "first", "last"])
            at = to


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a < b: ids of every two of ``words`` (id, word) at a distance of exactly one."""
    keys = words.select("id", "word").mapInArrow(_emit, "key long, id long, first int, last int")
    x, y = keys.alias("x"), keys.alias("y")
    met = x.join(y, F.expr("x.key = y.key and x.id < y.id and x.first <= y.last and y.first <= x.last"))
    pairs = met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    named = pairs.join(words.select(F.col("id").alias("a"), F.col("word").alias("u")), "a").join(words.select(F.col("id").alias("b"), F.col("word").alias("v")), "b")
    return named.where(F.levenshtein("u", "v", 1) == 1).select("a", "b")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``written``, never to be broadcast through the driver: a vocabulary is many times as large in memory as its files."""
    return written(df, name).hint("merge")


def variants(docs: DataFrame, one_in: int = ONE_IN, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row for each word of the vocabulary."""
    spark = docs.sparkSession
    words = kept(vocabulary(docs, one_in, min_length, min_count).withColumn("id", F.monotonically_increasing_id()), "words")
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    links = near_pairs(words).select(both.alias("e")).select(F.col("e.a").alias("id"), F.col("e.b").alias("near"))
    others = words.select(F.col("id").alias("near"), F.struct((-F.col("n")).alias("less"), "word", F.col("id").alias("to")).alias("best"))
    found = links.join(others, "near").groupBy("id").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    often = -F.col("best.less") >= RATIO * F.col("n")  # null without near words
    formed = words.join(found, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best.word")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"), F.when(often, F.col("best.to")).alias("up"),
    )
    formed = kept(formed, "formed")
    roots = roots_of(formed.where("up is not null").select("id", "up"))
    named = roots.join(words.select(F.col("id").alias("root_id"), F.col("word").alias("root")), F.col("up") == F.col("root_id")).select("id", "root")
    return formed.join(named, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots_of(steps: DataFrame) -> DataFrame:
    """(id, up) with up the end of the way on from id; ``steps`` (id, up) has a row for each id that leads on. Ways double each round."""
    spark = steps.sparkSession
    path = scratch(spark, "roots")
    steps.write.parquet(path)
    while True:
        now = spark.read.schema("id long, up long").parquet(path).hint("merge")
        on = now.select(F.col("id").alias("up"), F.col("up").alias("further"))
        if now.join(on, "up", "left_semi").isEmpty():
            return now
        before, path = path, scratch(spark, "roots")
        now.join(on, "up", "left").select("id", F.coalesce("further", "up").alias("up")).write.parquet(path)
        remove(spark, before)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op13_spelling": op13_spelling}
ORACLES = {
    "op13_spelling": f"""
WITH RECURSIVE crc(byte, bit, v) AS (
  SELECT b, 0, b::UBIGINT FROM range(256) AS r(b)
  UNION ALL SELECT byte, bit + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM crc WHERE bit < 8
),
tab AS (SELECT list(v ORDER BY byte) AS t FROM crc WHERE bit = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents),
held AS (SELECT doc_id, w, count(*) AS c FROM runs WHERE length(w) >= {MIN_LENGTH} GROUP BY ALL),
bytes AS (SELECT doc_id, w, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM held),
hashed AS (
  SELECT w, c, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: ((instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)::UBIGINT),
    lambda h, b: xor(h >> 8, t[(xor(h, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) AS h FROM bytes, tab
),
words AS (
  SELECT CASE WHEN h % {ONE_IN} = 0 THEN left(w, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {MIN_LENGTH} AND sum(c) >= {MIN_COUNT}
),
gone AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS m FROM gone a JOIN gone b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gone a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM gone a JOIN words b ON a.less = b.word
),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, near)) AS near, max(m) AS m FROM near GROUP BY word),
forms AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {RATIO} * n THEN near END AS form, CASE WHEN m >= {RATIO} * n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
ways(word, reached, form) AS (
  SELECT word, word, form FROM forms
  UNION ALL SELECT w.word, f.word, f.form FROM ways w JOIN forms f ON w.form = f.word
)
SELECT f.word, f.form, w.reached AS root, n, n_near, form_n FROM forms f JOIN ways w ON w.word = f.word AND w.form IS NULL
"""
}
