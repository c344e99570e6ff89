"""Best-fit packing by linear grouping.

Documents become token ids and an end id. One longer than a sequence is cut: its first piece takes
the remainder, the others are full. Pieces are packed into as few sequences as the scheme finds:

1. lengths above ``large`` of the capacity are sorted downwards and cut into groups of equal
   cardinality; each is rounded up to the longest of its group;
2. few sizes are left, so the best mix of configurations (multisets of sizes that fit) comes from
   the configuration linear programme by column generation; what rounding down leaves over is
   packed by best fit;
3. actual pieces take the places of their group's size, the longest first, and the last place of a sequence goes to the
   longest that fits what is left of it;
4. the small lengths, and what steps 2 and 3 leave, go, the longest first, each to the sequence with the least room that
   holds it.

Steps 1 to 4 work on the histogram of lengths, at most ``capacity`` rows, and give a plan of runs of
equal sequences; a piece's rank among those of its length finds its run. So the driver holds a
bounded amount whatever the number of pieces. Column generation ends after 40 rounds a size at the latest; the mix it has by
then is a valid one, and step 4 places what it leaves. Ids are shuffled once if they are asked for, with their pieces, and stay where they
are written if not.

A null text is an empty one (its end id alone), an empty table gives no rows, repeated rows are
documents of their own, other columns are ignored. Ties are broken by the order of the input.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import doc_key, few_files, flush, from_key, rows, text_bytes, tidy, written
from ._tokens import encoder, in_groups, vocabulary

_PIECE = "part int, rank long, key long, piece int, start long, length int, ids binary"


def _best_mix(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used in the linear programme's optimum (column generation)."""
    m = len(sizes)
    patterns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(patterns))
    amount = inverse @ demand
    for _ in range(40 * m):
        duals = inverse.sum(0)
        worth, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(int(sizes.min()), capacity + 1):  # unbounded knapsack
            fits = np.flatnonzero(sizes <= room)
            gains = worth[room - sizes[fits]] + duals[fits]
            best = int(gains.argmax())
            worth[room], choice[room] = (gains[best], fits[best]) if gains[best] > worth[room - 1] else (worth[room - 1], -1)
        if worth[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(m), capacity
        while room > 0:
            if choice[room] < 0:
                room -= 1
            else:
                column[choice[room]] += 1
                room -= sizes[choice[room]]
        step = inverse @ column
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        patterns[:, out] = column
    return [(patterns[:, j].round().astype(int), float(amount[j])) for j in range(m)]


def plan_packing(histogram: dict[int, int], capacity: int, large: float = 0.25, groups: int = 96) -> list[tuple[tuple[int, ...], int]]:
    """Runs of equal sequences: the lengths in each, and how many there are. Every piece of the histogram is placed."""
    runs: list[tuple[tuple[int, ...], int]] = []
    left = {n: histogram[n] for n in sorted(histogram, reverse=True) if histogram[n] > 0}
    big = [(n, c) for n, c in left.items() if n > large * capacity]
    total = sum(c for _, c in big)
    if total:
        # groups of equal cardinality, the longest first, each named by its longest
        each = -(-total // groups)
        demand: dict[int, int] = {}
        name, held = big[0][0], 0
        for n, count in big:
            while count:
                name = n if held == 0 else name
                take = min(count, each - held)
                demand[name] = demand.get(name, 0) + take
                held, count = (held + take) % each, count - take
        sizes = np.array(sorted(demand))
        mix = _best_mix(sizes, np.array([demand[n] for n in sizes], float), capacity)
        mix = [(sorted((int(sizes[u]) for u, k in enumerate(config) for _ in range(k)), reverse=True), int(times + 1e-9)) for config, times in mix]
        for slots, times in sorted(mix, reverse=True):
            while times > 0 and slots:
                # actual pieces in the places: the longest that its group's size allows, in the last place the longest that fits
                chosen: list[int] = []
                for i, size in enumerate(slots):
                    room = capacity - sum(chosen) if i == len(slots) - 1 else size
                    n = next((n for n, c in left.items() if n <= room and c > chosen.count(n)), None)
                    if n is not None:
                        chosen.append(n)
                if not chosen:
                    break
                step = min([times, *(left[n] // chosen.count(n) for n in chosen)])
                for n in chosen:
                    left[n] -= step
                    if not left[n]:
                        del left[n]
                runs.append((tuple(chosen), step))
                times -= step
    return best_fit(runs, left, capacity)


def best_fit(runs: list[tuple[tuple[int, ...], int]], histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Adds the histogram's pieces, the longest first, each to the fullest sequence that holds it; runs at a time."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for pattern, count in runs:
        room.setdefault(capacity - sum(pattern), []).append((pattern, count))
    for n in sorted(histogram, reverse=True):
        left = histogram[n]
        while left:
            fit = min((r for r, held in room.items() if r >= n and held), default=None)
            pattern, count = room[fit].pop() if fit is not None else ((), -(-left // (capacity // n)))
            free = capacity if fit is None else fit
            many = free // n  # the same sequence stays the fullest until it is full
            whole = min(count, left // many)
            if whole:
                room.setdefault(free - many * n, []).append((pattern + (n,) * many, whole))
                left, count = left - whole * many, count - whole
            if count and left and left < many:
                room.setdefault(free - left * n, []).append((pattern + (n,) * left, 1))
                left, count = 0, count - 1
            if count and pattern:
                room.setdefault(free, []).append((pattern, count))
    return [(p, c) for r in sorted(room) for p, c in sorted(room[r]) if c]


class Plan:
    """Where the piece of a length and a rank among that length's pieces goes."""

    def __init__(self, runs: list[tuple[tuple[int, ...], int]]):
        places: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for pattern, count in runs:
            offset = 0
            for n in pattern:
                places.setdefault(n, []).append((count, first, offset))
                offset += n
            first += count
        self.sequences = first
        self.by_length = {}
        for n, found in places.items():
            counts, firsts, offsets = (np.array(x, np.int64) for x in zip(*found))
            self.by_length[n] = (np.cumsum(counts) - counts, firsts, offsets)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n in np.unique(lengths):
            of = lengths == n
            starts, firsts, offsets = self.by_length[int(n)]
            at = np.searchsorted(starts, ranks[of], "right") - 1
            sequence[of] = firsts[at] + ranks[of] - starts[at]
            offset[of] = offsets[at]
        return sequence, offset


@tidy
def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    schema = pa.schema([("part", pa.int32()), ("rank", pa.int64()), ("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary())])
    encode, end = encoder(path, "byte").encode_all, struct.pack("<I", end_id)
    part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
    out: list[list] = [[] for _ in schema]
    for group in in_groups(rows(batches), 1):
        for (key, _), ids in zip(group, encode([t for _, t in group])):
            ids += end
            n = len(ids) // 4
            bounds = [0, *range(n % capacity or capacity, n + 1, capacity)]
            for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                for column, x in zip(out, (part, seen[b - a], key, piece, a, b - a, ids[4 * a : 4 * b])):
                    column.append(x)
                seen[b - a] += 1
        yield flush(out, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024, large: float = 0.25, groups: int = 96, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids
    (binary, little-endian unsigned 32-bit) unless ``with_ids`` is false, when they stay where they are written.
    """
    keyed = docs.select(doc_key().alias("key"), text_bytes().alias("text"))
    pieces = written(keyed.mapInArrow(lambda b: _pieces(b, tokenizer_path, end_id, capacity), _PIECE), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per length
    plan = Plan(plan_packing(histogram, capacity, large, groups))

    carried = ["key", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kinds = {"key": "long", "piece": "int", "start": "long", "length": "int", "ids_crc32": "long", "ids": "binary"}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(n) for n in b.schema.names}
            ranks = cols.pop("rank").to_numpy() + cols.pop("base").to_numpy()
            sequence, offset = plan.find(cols["length"].to_numpy(), ranks)
            yield pa.RecordBatch.from_pydict(cols | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return (
        pieces.withColumn("ids_crc32", F.crc32("ids"))
        .select("part", "rank", *carried)
        .join(bases.hint("shuffle_hash"), ["part", "length"])  # the smaller side; nothing is sorted
        .select(*carried, "rank", "base")
        .mapInArrow(place, ", ".join(f"{c} {kinds[c]}" for c in carried) + ", sequence_id long, offset long")
        .select(from_key(F.col("key")).alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), *carried[4:], "sequence_id", "offset")
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few_files(pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary("byte_bpe_50k.json"), with_ids=False))


QUERIES = {"op10_packing": op10_packing}
ORACLES: dict[str, str] = {}
