"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Examples are at most SAMPLE labelled documents of the learning folds (those with the smallest hashes of
doc_id; the bound is a parameter). Terms are words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z in lower case)
and the first PREFIX bytes of longer ones. The leaning terms are those of whose examples more than half are toxic, and which chance
can't explain: binomial tests of their toxic share against that of all examples, with a share of LEVEL of false discoveries over all terms tested
(Benjamini and Hochberg, 1995), whatever the number of examples. Documents without such a term are searched among the
same examples by the wide vocabulary: terms of MIN_DOCS examples or more whose chi-squared with the label passes WIDE (one in a hundred
by chance). A document's weights are (1 + ln tf) * idf, scaled to
length 1, with document frequencies counted over the whole corpus.

The index holds, for every term, postings in blocks of BLOCK examples and the block's greatest weight. A
query sums the greatest weights of its terms to a bound for each block, visits the FIRST_BLOCKS blocks of greatest bound, and then
those whose bound can pass the K-th best cosine: the neighbours are the exact K nearest.

Each neighbour votes with weight 1 / (DISTANCE + 1 - cosine). The share of toxic votes is turned into a
probability by isotonic regression on the examples, each judged by the others (for the second search, on examples
that need it); a document without any term of either gets the rate of examples without any. Neighbours are evidence: their ids and cosines come with a score.

Null and empty texts have no term. Without examples of both labels every score is the rate of toxic ones (0
without any). Null labels and null ids don't teach; of several labels of a document the greatest counts. A
null doc_id counts as held out when its text form, the empty string, has that remainder; it doesn't. Repeated
rows are scored alike. Label, lang, source and doc_id are no input of a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import annotate, fresh, lower_alnum_words, text_bytes, tidy, written

SAMPLE = 4096
PREFIX = 5
#: Share of the leaning terms that may lean by accident.
LEVEL = 0.05
#: Chi-squared of the wide vocabulary (one degree of freedom, one in a hundred), and the fewest examples for which it holds.
WIDE = 6.635
MIN_DOCS = 5
BLOCK = 64
#: Blocks of a query's first visit.
FIRST_BLOCKS = 8
K = 15
DISTANCE = 0.1
THRESHOLD = 0.7
#: Folds of crc32(doc_id as text); one of them isn't learnt from.
FOLDS, HELD_OUT = 3, 1


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def terms(words: list[bytes]) -> Iterator[bytes]:
    """Words, and prefixes marked by a caret, which no word has."""
    return chain(words, [b"^" + w[:PREFIX] for w in words if len(w) > PREFIX])


def log_tail(both: int, n: int, rate: float) -> float:
    """Logarithm of the chance that ``both`` or more of ``n`` draws hit at ``rate``."""
    ln = [math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) + x * math.log(rate) + (n - x) * math.log1p(-rate) for x in range(both, n + 1)]
    most = max(ln)
    return most + math.log(sum(math.exp(v - most) for v in ln))


def discoveries(tails: list[tuple[float, bytes]], tested: int) -> list[bytes]:
    """The terms whose (log tail, term) pass: the smallest tails up to the last that is within its rank's part of LEVEL."""
    tails = sorted(tails)
    passed = [k for k, (tail, _) in enumerate(tails, 1) if tail <= math.log(LEVEL * k / tested)]
    return sorted(term for _, term in tails[: max(passed, default=0)])


class BlockMaxIndex:
    """Unit vectors of few terms, found by exact cosine."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int):
        self.n = len(vectors)
        self.blocks = -(-self.n // BLOCK)
        postings = sorted((t, d, w) for d, v in enumerate(vectors) for t, w in v.items())
        terms_ = np.array([p[0] for p in postings], np.int64)
        self.docs = np.array([p[1] for p in postings], np.int64)
        self.weights = np.array([p[2] for p in postings])
        run = terms_ * self.blocks + self.docs // BLOCK  # of one term and block
        self.starts = np.searchsorted(run, np.arange(n_terms * self.blocks + 1)).astype(np.int32)
        most = np.zeros(n_terms * self.blocks)
        np.maximum.at(most, run, self.weights)
        self.most = most.reshape(n_terms, self.blocks)

    def _scores(self, terms_: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Examples of some blocks, and their cosines with the query: exact sums over their postings."""
        runs = terms_[:, None] * self.blocks + blocks[None, :]
        starts = self.starts[runs]
        sizes = self.starts[runs + 1] - starts
        n = sizes.ravel()
        at = np.repeat(starts.ravel() - (np.cumsum(n) - n), n) + np.arange(n.sum())
        products = self.weights[at] * np.repeat(weights, sizes.sum(1))
        docs = self.docs[at]
        scores = np.bincount(docs, products, self.n)
        found = np.flatnonzero(scores)
        return found, scores[found]

    def nearest(self, query: dict[int, float], k: int, but: int = -1) -> list[tuple[float, int]]:
        """The k (cosine, example) of greatest cosine above zero, ties by example; ``but`` is left out."""
        if not query or not self.n:
            return []
        terms_, weights = np.fromiter(query.keys(), np.int64, len(query)), np.fromiter(query.values(), float, len(query))
        bounds = weights @ self.most[terms_]
        order = np.argsort(-bounds, kind="stable")
        order = order[: np.count_nonzero(bounds)]
        docs, scores = np.zeros(0, np.int64), np.zeros(0)
        for some in (order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]):
            if len(scores) == k:
                some = some[bounds[some] * (1 + 1e-12) >= scores[-1]]
            if not len(some):
                break
            more, cosines = self._scores(terms_, weights, some)
            keep = more != but
            docs, scores = np.concatenate([docs, more[keep]]), np.concatenate([scores, cosines[keep]])
            best = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[best], scores[best]
        return list(zip(scores.tolist(), docs.tolist()))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the non-decreasing function of x nearest to y, by pooling neighbours; equal x pooled first."""
    blocks: list[list[float]] = []  # sum, count, lowest x, highest x
    for value in np.unique(x):
        of = y[x == value]
        blocks.append([float(of.sum()), len(of), float(value), float(value)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, blocks[-1][2], high]
    xs = np.array([v for b in blocks for v in (b[2], b[3])])
    # a block's rate, drawn a little towards one half: small blocks never give 0 or 1
    ys = np.array([(b[0] + 0.5) / (b[1] + 1) for b in blocks for _ in range(2)])
    return xs, np.maximum.accumulate(ys)


class Model:
    """Vocabulary, index and calibration; as large as SAMPLE documents make them. Terms of examples outside the vocabulary don't count.

    ``wide`` is the vocabulary for documents without a term; ``judged``: the examples (by place) that calibrate, all if None.
    """

    def __init__(self, vocabulary: list[bytes], frequencies: dict[bytes, int], n_docs: int, examples: list[tuple[int, dict[bytes, int], int]], wide: list[bytes] | None = None, judged: set[int] | None = None):
        self.number = {t: i for i, t in enumerate(vocabulary)}
        self.prefixes = {t[1:]: i for t, i in self.number.items() if t[:1] == b"^"}
        self.idf = [math.log((n_docs + 1) / (frequencies.get(t, 0) + 1)) + 1 for t in vocabulary]
        vectors = [self.weigh({self.number[t]: c for t, c in e[1].items() if t in self.number}) for e in examples]
        known = [i for i, v in enumerate(vectors) if v]
        self.ids = [examples[i][0] for i in known]
        self.labels = np.array([examples[i][2] for i in known], float)
        self.index = BlockMaxIndex([vectors[i] for i in known], len(vocabulary))
        without = [e[2] for e, v in zip(examples, vectors) if not v]
        rate = sum(e[2] for e in examples) / len(examples) if examples else 0.0
        self.unknown = (sum(without) + rate) / (len(without) + 1)
        votes = np.array([self.vote(self.index.nearest(vectors[i], K, at)) if judged is None or i in judged else math.nan for at, i in enumerate(known)])
        heard = np.isfinite(votes)
        self.single: dict[int, tuple[float, list[int], list[float]]] = {}  # answers to queries of one term
        self.curve = isotonic(votes[heard], self.labels[heard]) if heard.any() else (np.zeros(1), np.full(1, rate))
        self.wide = Model(wide, frequencies, n_docs, examples, judged={i for i, v in enumerate(vectors) if not v}) if wide else None

    def weigh(self, counts: dict[int, int]) -> dict[int, float]:
        w = {t: (1 + math.log(c)) * self.idf[t] for t, c in counts.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    def vector(self, words: list[bytes]) -> dict[int, float]:
        number, prefixes = self.number, self.prefixes
        found = Counter([number[w] for w in words if w in number])
        found.update([prefixes[p] for w in words if len(w) > PREFIX and (p := w[:PREFIX]) in prefixes])
        return self.weigh(found)

    def vote(self, near: list[tuple[float, int]]) -> float:
        if not near:
            return math.nan
        weights = np.array([1 / (DISTANCE + max(0.0, 1 - c)) for c, _ in near])
        return float(weights @ self.labels[[d for _, d in near]] / weights.sum())

    def score(self, text: bytes | None) -> tuple[float, list[int], list[float]]:
        """Probability of label 1, and the neighbours' ids and cosines."""
        return self._answer(lower_alnum_words(text or b""))

    def _answer(self, words: list[bytes]) -> tuple[float, list[int], list[float]]:
        query = self.vector(words)
        if not query and self.wide:
            return self.wide._answer(words)
        if len(query) == 1:  # one term is one direction, whatever its count
            (term,) = query
            if term not in self.single:
                self.single[term] = self._judged(query)
            return self.single[term]
        return self._judged(query)

    def _judged(self, query: dict[int, float]) -> tuple[float, list[int], list[float]]:
        near = self.index.nearest(query, K)
        vote = self.vote(near)
        p = self.unknown if math.isnan(vote) else float(np.interp(vote, *self.curve))
        return min(1.0, max(0.0, p)), [self.ids[d] for _, d in near], [c for c, _ in near]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from at most ``sample`` labelled documents outside the held-out fold; counts document frequencies over all of ``docs``."""
    taught = (
        labels.where("doc_id is not null and toxic is not null").where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    chosen = F.broadcast(taught.withColumnRenamed("doc_id", "_id"))  # ``sample`` rows at most
    # their texts, a row for each that differs: a table of their own, read three times
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text_bytes().alias("_text")).join(chosen, "_id").withColumn("_th", F.xxhash64("_text"))
    rows = written(rows.groupBy("_id", "_th", "_toxic").agg(F.first("_text").alias("_text")), "examples")
    first = rows.select("_id", "_th").orderBy(F.xxhash64("_id"), "_id", "_th").limit(sample)
    rows = rows.join(F.broadcast(first), ["_id", "_th"])  # also where ids repeat with other texts

    @tidy
    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, n, both = batch.slice(at, 512), Counter(), Counter()
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    mine = set(terms(lower_alnum_words(text)))
                    n.update(mine)
                    n[b""] += 1
                    if toxic:
                        both.update(mine)
                        both[b""] += 1
                yield pa.RecordBatch.from_pydict({"term": pa.array(list(n), pa.binary()), "n": list(n.values()), "both": [both[t] for t in n]})

    counts = rows.select("_text", "_toxic").mapInArrow(present, "term binary, n long, both long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("both").alias("both"))
    counts = written(counts, "terms")
    total = counts.where(F.col("term") == b"").first() or {"n": 0, "both": 0}
    n, toxic, tested = total["n"], total["both"], counts.count() - 1
    vocabulary: list[bytes] = []
    if 0 < toxic < n:
        # what all hits could reach
        leaning = counts.where((F.col("term") != b"") & (F.col("both") * 2 > F.col("n")) & (F.col("both") * math.log(toxic / n) <= math.log(LEVEL)))
        vocabulary = discoveries([(log_tail(r["both"], r["n"], toxic / n), bytes(r["term"])) for r in leaning.collect()], tested)
    score = F.lit(float(n)) * F.pow(F.col("both") * float(n - toxic) - (F.col("n") - F.col("both")) * float(toxic), 2) / F.greatest(F.col("n") * (float(n) - F.col("n")) * float(toxic) * float(n - toxic), F.lit(1.0))
    wide = sorted(bytes(r["term"]) for r in counts.where((F.col("term") != b"") & (F.col("n") >= MIN_DOCS) & (score >= WIDE)).select("term").collect())
    wanted = frozenset(vocabulary + wide)

    @tidy
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        words_, prefixes = frozenset(t for t in wanted if t[:1] != b"^"), {t[1:]: t for t in wanted if t[:1] == b"^"}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(0).to_pylist():
                    words = lower_alnum_words(text)
                    held.update(words_.intersection(words))
                    held.update({prefixes[p] for w in words if len(w) > PREFIX and (p := w[:PREFIX]) in prefixes})
                    held[b""] += 1
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(held), pa.binary()), "n": pa.array(list(held.values()), pa.int64())})

    df = docs.select(text_bytes()).mapInArrow(frequencies, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {bytes(r["term"]): r["n"] for r in df.collect()}  # a row a term of the examples

    @tidy
    def example(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, toxics = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            held = []
            for at in range(0, batch.num_rows, 256):
                held += [[(t, c) for t, c in Counter(terms(lower_alnum_words(x))).items() if t in wanted] for x in batch.slice(at, 256).column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "toxic": pa.array(toxics, pa.int32()), "terms": pa.array([[t for t, _ in h] for h in held], pa.list_(pa.binary())), "counts": pa.array([[c for _, c in h] for h in held], pa.list_(pa.int64()))})

    taught_rows = rows.select("_id", "_text", "_toxic").mapInArrow(example, "id long, toxic int, terms array<binary>, counts array<long>").collect()
    examples = sorted({(r["id"], tuple(zip(map(bytes, r["terms"]), r["counts"])), r["toxic"]) for r in taught_rows})
    return Model(vocabulary, found, found.get(b"", 0), [(i, dict(t), y) for i, t, y in examples], wide)


def flag(docs: DataFrame, labels: DataFrame, keep: list[str], name: str = "_pw") -> DataFrame:
    """``keep`` columns and a struct ``name``: score, predicted, neighbours (their ids) and cosines."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def make():
        def work(texts: list[bytes | None]) -> list[tuple]:
            return [(s, int(s >= THRESHOLD), ids, cosines) for s, ids, cosines in map(model.value.score, texts)]

        return work

    return annotate(docs, keep, "score double, predicted int, neighbours array<long>, cosines array<double>", make, name)


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted toxic, with the columns they had."""
    name = fresh(docs.columns)
    return flag(docs, labels, docs.columns, name).where(F.col(name)["predicted"] == 0).drop(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = flag(docs, labels, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "_pw.score", "_pw.predicted")


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict[str, str] = {}
