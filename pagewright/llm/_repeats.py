"""Where windows of documents repeat elsewhere: the distributed part of op 2 (bytes) and op 3 (words).

A window is ``window`` consecutive units (bytes or words) of one document. Windows that are equal have
equal minimizers: of the grams of ``gram`` units in a window, the one with the least hash (the leftmost of
equals) is its anchor. So two equal windows share an anchor at the same relative place, and only
anchors travel: about two of every ``window - gram`` units.

1. ``anchors``: every task finds the anchors of its documents, each with a 64-bit hash of its context
   (all units that a window around the anchor can have). Anchors with equal contexts are a class; one
   member of a class goes on from each batch of a task, the others are settled there. So a passage
   that a third of all documents share sends one row a batch.
2. ``resolve``: anchors meet by gram. Members of a class with several places repeat in full. Classes that
   share the gram and one half of the context may share some windows; their contexts are requested. A gram that a
   sample of documents shows to have more than MEET contexts doesn't meet in one task: its anchors meet by gram and half,
   once for each half, and by context where a half is as frequent; contexts of such a half are requested unseen.
   The sample decides only where anchors meet, not what is found.
3. ``contexts``: the requested contexts are cut from the documents and meet by gram again, where the
   operator's own index (a suffix array, a suffix automaton) decides every window. A gram with more
   than HOT contexts sends its windows one by one, dealt by their own hash, to the same index. Equal windows are settled
   within each task first and one place goes on from each HELD, so a window that a third of all documents
   share sends a few rows a task, not one a document.

Hashes of 64 bits and more choose what meets and what is equal in step 2; step 3 compares units.

A document is a doc_id (null first) and the hash of its text: rows that repeat both are one
document, rows that repeat a doc_id with another text come in order of that hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ._common import doc_key, flush, partitions, rows, text_bytes, tidy, written

#: Units hashed at once, and anchors a task settles at once.
PIECE = 1 << 18
BATCH = 1 << 18
#: Contexts of a gram that one task compares; beyond that they are dealt by window. An automaton takes more memory than an array.
HOT = {"bytes": 30_000, "words": 4_000}
#: Contexts of a gram whose anchors (about 50 bytes each) meet in one task.
MEET = 1 << 17
#: Single windows a task settles at once.
HELD = 1 << 16
#: Documents that are looked at for frequent grams (on average), the fewest contexts among them that count, and the most grams (and halves) listed.
SAMPLED = 8192
HITS = 32
LISTED = 1 << 16

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK64 = (1 << 64) - 1
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)


@dataclass(frozen=True)
class Units:
    """What a window is made of."""

    kind: str  # "bytes" or "words"
    window: int
    gram: int

    @property
    def side(self) -> int:
        return self.window - self.gram

    @property
    def half(self) -> int:
        return -(-self.side // 2)

    def split(self, text: bytes) -> bytes | list[bytes]:
        return text if self.kind == "bytes" else text.split()

    def hashes(self, units: bytes | list[bytes]) -> np.ndarray:
        if self.kind == "bytes":
            return _BYTES[np.frombuffer(units, np.uint8)]
        return np.fromiter(map(xxhash.xxh3_64_intdigest, units), np.uint64, len(units))

    def join(self, units: bytes | list[bytes]) -> bytes:
        return units if self.kind == "bytes" else b" ".join(units)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    out = []
    for x in (_MULTIPLIER, inverse):
        p = np.empty(n, np.uint64)
        p[0], filled, factor = 1, 1, x
        while filled < n:
            more = min(filled, n - filled)
            p[filled : filled + more] = p[:more] * np.uint64(factor)
            filled += more
            factor = factor * factor & _MASK64
        out.append(p)
    return out[0], out[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Anchors:
    """Finds anchors in many documents at once."""

    def __init__(self, units: Units):
        self.u = units
        self.powers, self.inverses = _powers(PIECE * 2)

    def find(self, documents: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Arrays with an entry per anchor: doc (index), pos, left, right (units of context before and after), gram, context, low, high (hashes; of the context and its halves)."""
        u, found = self.u, []
        pieces, held = [], 0
        for doc, h in enumerate(documents):
            starts = len(h) - u.window + 1
            for at in range(0, max(starts, 0), PIECE):
                first, last = max(0, at - u.side), min(len(h), min(at + PIECE, starts) + 2 * u.window)
                pieces.append((doc, first, at - first, min(at + PIECE, starts) - first, h[first:last]))
                held += last - first
                if held >= PIECE:
                    found.append(self._pieces(pieces))
                    pieces, held = [], 0
        if pieces:
            found.append(self._pieces(pieces))
        if not found:
            return {n: np.zeros(0, np.int64 if n in ("doc", "pos", "left", "right") else np.uint64) for n in ("doc", "pos", "left", "right", "gram", "context", "low", "high")}
        every = {n: np.concatenate([f[n] for f in found]) for n in found[0]}
        again = np.zeros(len(every["doc"]), bool)  # two pieces of a long document may find the same
        again[1:] = (every["doc"][1:] == every["doc"][:-1]) & (every["pos"][1:] <= np.maximum.accumulate(every["pos"])[:-1])
        if again.any():
            order = np.lexsort((every["pos"], every["doc"]))
            doc, pos = every["doc"][order], every["pos"][order]
            order = order[np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])])]
            every = {n: v[order] for n, v in every.items()}
        return every

    def _pieces(self, pieces: list[tuple]) -> dict[str, np.ndarray]:
        u = self.u
        sizes = np.array([len(p[4]) for p in pieces])
        base = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        if n > len(self.powers):
            self.powers, self.inverses = _powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(np.concatenate([p[4] for p in pieces]) * self.powers[:n], out=sums[1:])
        of = lambda a, b: (sums[b] - sums[a]) * self.inverses[a]  # noqa: E731  hash of units a to b, the same at every place
        grams = _mix((sums[u.gram :] - sums[: n + 1 - u.gram]) * self.inverses[: n + 1 - u.gram])
        bits = max(1, int(n).bit_length())
        least = (grams & np.uint64(_MASK64 ^ ((1 << bits) - 1))) | np.arange(len(grams), dtype=np.uint64)
        width, covered = u.side + 1, 1
        while covered < width:
            step = min(covered, width - covered)
            least = np.minimum(least[: len(least) - step], least[step:])
            covered += step
        starts = np.zeros(n + 1, np.int8)
        for b, p in zip(base, pieces):
            starts[b + p[2]] += 1
            starts[b + p[3]] -= 1
        valid = np.cumsum(starts[: len(least)]) > 0
        at = (least[valid] & np.uint64((1 << bits) - 1)).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
        piece = np.searchsorted(base, at, "right") - 1
        start, end = base[piece], base[piece] + sizes[piece]
        left, right = np.minimum(at - start, u.side), np.minimum(end - at, u.window)
        place = np.uint64(_MULTIPLIER)
        shape = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        context = _mix(of(at - left, at + right) ^ _mix(shape * place))
        # halves; one that the document's edge cuts off matches nothing
        alone = _mix(context + np.arange(len(at), dtype=np.uint64) * place + np.uint64(1))
        low = np.where(left >= u.half, _mix(of(np.maximum(at - u.half, 0), at)), alone)
        high = np.where(right >= u.gram + u.half, _mix(of(at + u.gram, np.minimum(at + u.gram + u.half, n))), alone)
        first = np.array([p[1] for p in pieces])
        doc = np.array([p[0] for p in pieces])
        return {"doc": doc[piece], "pos": at - start + first[piece], "left": left, "right": right, "gram": grams[at], "context": context, "low": low, "high": high}


def _covers(schema: pa.Schema, key, th, start, end, target) -> list[pa.RecordBatch]:
    """A row per document with its runs of covered units; the input is ordered by document."""
    if not len(key):
        return []
    cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (th[1:] != th[:-1])]))
    ends = np.concatenate([cut[1:], [len(key)]])
    spans = [np.stack(merge(start[a:b], end[a:b]), 1).astype("<i4").tobytes() for a, b in zip(cut, ends)]
    none = pa.nulls(len(cut), pa.int32())
    return [pa.RecordBatch.from_arrays([pa.array(target[cut], pa.int32()), pa.array(key[cut], pa.int64()), pa.array(th[cut], pa.int64()), pa.array(spans, pa.binary()), none, pa.nulls(len(cut), pa.int64()), none], schema=schema)]


def longest_previous_factor(place: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order, with their places and the length each shares with the one before: the longest match with a suffix that begins earlier.

    That is the longer of the matches with the previous and with the next smaller place in suffix order, each the least length
    shared on the way there. All suffixes look for theirs at once: one that finds a place that isn't smaller goes on from where
    that place has got to.
    """
    n = len(place)
    out = np.zeros(n, lcp.dtype)
    for back in (False, True):
        p = place[::-1] if back else place
        at = np.arange(n) - 1  # what lies between an entry's ``at`` and itself isn't smaller
        least = np.concatenate([[0], lcp[1:][::-1] if back else lcp[1:]]).astype(lcp.dtype) if n else lcp
        todo = np.arange(1, n)
        todo = todo[least[todo] > 0]
        at[least == 0] = -1
        while len(todo):
            todo = todo[at[todo] >= 0]
            seen = at[todo]
            todo, seen = (x[p[seen] >= p[todo]] for x in (todo, seen))
            least[todo] = np.minimum(least[todo], least[seen])
            at[todo] = at[seen]
        found = np.where(at >= 0, least, 0)
        out = np.maximum(out, found[::-1] if back else found)
    return out


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs that overlap or touch, as one."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]


#: Rows of step 1 and 2. blob alone: anchors; key and blob: covered runs; pos: a request.
_FLOW = pa.schema([("target", pa.int32()), ("key", pa.int64()), ("th", pa.int64()), ("blob", pa.binary()), ("pos", pa.int32()), ("gram", pa.int64()), ("among", pa.int32())])
_FLOW_DDL = "target int, key long, th long, blob binary, pos int, gram long, among int"
_FIELDS = (("gram", "<u8"), ("context", "<u8"), ("low", "<u4"), ("high", "<u4"), ("doc", "<u4"), ("pos", "<u4"))


def _fields(units: Units) -> tuple[tuple[str, str], ...]:
    """Columns of an anchor; left and right are as long as a window at most."""
    kind = "u1" if units.window < 256 else "<u4"
    return (*_FIELDS, ("left", kind), ("right", kind))


def _pack(a: dict[str, np.ndarray], docs: np.ndarray, units: Units) -> bytes:
    """Columns one after the other, wide integers by byte plane, so that they compress."""
    used, doc = np.unique(a["doc"], return_inverse=True)
    parts = [np.array([len(doc), len(used)], "<u4").tobytes(), np.ascontiguousarray(docs[used]).tobytes()]
    for name, kind in _fields(units):
        v = (doc if name == "doc" else a[name]).astype(kind)
        parts.append(np.ascontiguousarray(v.view(np.uint8).reshape(-1, v.itemsize).T).tobytes())
    return b"".join(parts)


def _unpack(blob: bytes, units: Units) -> dict[str, np.ndarray]:
    n, used = np.frombuffer(blob, "<u4", 2)
    docs = np.frombuffer(blob, "<i8", 2 * used, 8).reshape(-1, 2)
    at, out = 8 + 16 * int(used), {}
    for name, kind in _fields(units):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(blob, np.uint8, int(n) * size, at).reshape(size, int(n))
        out[name] = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
        at += int(n) * size
    out["key"], out["th"] = docs[out["doc"], 0], docs[out["doc"], 1]
    return out


@dataclass(frozen=True)
class Frequent:
    """Hashes of grams, and of grams with a half of their context, that have too many contexts to meet in one task."""

    grams: np.ndarray
    halves: np.ndarray


NONE = Frequent(np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _half(a: dict[str, np.ndarray], side: str) -> np.ndarray:
    """Hashes of the anchors' grams with the half of their context on one side."""
    return _mix(a["gram"] ^ _mix(a[side].astype(np.uint64) + np.uint64(1 << 32 if side == "low" else 1 << 33)))


def _dealt(a: dict[str, np.ndarray], frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    """Anchors (by place in ``a``; those of frequent grams twice) and the hash by which each meets its like."""
    split = np.isin(a["gram"], frequent.grams)
    twice = np.flatnonzero(split)
    some, by = [np.flatnonzero(~split)], [a["gram"][~split]]
    for side in ("low", "high") if len(twice) else ():
        half = _half(a, side)[twice]
        some.append(twice)
        by.append(np.where(np.isin(half, frequent.halves), a["context"][twice], half))
    return np.concatenate(some), np.concatenate(by)


@tidy
def _tally(batches: Iterator[pa.RecordBatch], units: Units, keep_first: bool, grams: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Contexts of each gram, or of each half of ``grams``."""
    for batch in _anchors(batches, units, 1, keep_first):
        for blob in batch.filter(batch.column("key").is_null()).column("blob").to_pylist():
            a = _unpack(blob, units)
            if grams is not None:
                among = np.isin(a["gram"], grams)
                a = {k: v[among] for k, v in a.items()}
            found = a["gram"] if grams is None else np.concatenate([_half(a, "low"), _half(a, "high")])
            hashes, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_pydict({"hash": pa.array(hashes.view(np.int64)), "n": pa.array(n, pa.int64())})


def find_frequent(docs: DataFrame, units: Units, keep_first: bool) -> Frequent:
    """Grams that have more than MEET contexts, as far as about SAMPLED documents show, and such halves of theirs; at most LISTED of each."""
    share = min(1.0, SAMPLED / max(1, docs.count()))
    some = docs.sample(share, 42).select(doc_key().alias("key"), F.xxhash64(text_bytes()).alias("th"), text_bytes().alias("text"))
    least = max(HITS, MEET * share)

    def listed(grams: np.ndarray | None) -> np.ndarray:
        counts = some.mapInArrow(lambda b: _tally(b, units, keep_first, grams), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
        most = counts.where(F.col("n") > least).orderBy(F.desc("n"), "hash").limit(LISTED).collect()
        return np.sort(np.array([r["hash"] for r in most], np.int64).view(np.uint64))

    grams = listed(None)
    return Frequent(grams, listed(grams)) if len(grams) else NONE


@tidy
def _anchors(batches: Iterator[pa.RecordBatch], units: Units, targets: int, keep_first: bool, frequent: Frequent = NONE) -> Iterator[pa.RecordBatch]:
    finder = Anchors(units)
    docs: list[tuple[int, int]] = []
    held: list[dict[str, np.ndarray]] = []
    n = 0

    def settle() -> Iterator[pa.RecordBatch]:
        ids = np.array(docs, "<i8").reshape(-1, 2)
        a = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        a["low"], a["high"] = a["low"].astype("<u4"), a["high"].astype("<u4")
        a["key"], a["th"] = ids[a["doc"], 0], ids[a["doc"], 1]
        first, covered = _classes(a, keep_first)
        rows_ = np.flatnonzero(covered)
        rows_ = rows_[np.lexsort((a["pos"][rows_], a["th"][rows_], a["key"][rows_]))]
        pos = a["pos"][rows_]
        target = (_mix((a["key"][rows_] ^ a["th"][rows_]).view(np.uint64)) % np.uint64(targets)).astype(np.int32)  # any task; copies have one th
        yield from _covers(_FLOW, a["key"][rows_], a["th"][rows_], pos - a["left"][rows_], pos + a["right"][rows_], target)
        go = np.flatnonzero(first)
        some, by = _dealt({k: a[k][go] for k in ("gram", "context", "low", "high")}, frequent)
        go, target = go[some], (by >> np.uint64(20)) % np.uint64(targets)
        order = np.lexsort((a["gram"][go], target))
        go, target = go[order], target[order]
        cut = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(go) else np.zeros(0, int)
        for x, y in zip(cut, [*cut[1:], len(go)]):
            blob = _pack({k: a[k][go[x:y]] for k, _ in _fields(units)}, ids, units)
            yield flush([[int(target[x])], [None], [None], [blob], [None], [None], [None]], _FLOW)

    group: list[np.ndarray] = []

    def search() -> int:
        found = finder.find(group)
        found["doc"] = found["doc"] + (len(docs) - len(group))
        held.append(found)
        group.clear()
        return len(found["doc"])

    size = 0
    for key, th, text in rows(batches):
        docs.append((key, th))
        group.append(units.hashes(units.split(text)))
        size += len(group[-1])
        if size >= PIECE:
            n += search()
            size = 0
            if n >= BATCH:
                yield from settle()
                docs, held, n = [], [], 0
    if group:
        n += search()
    if n:
        yield from settle()


def _classes(a: dict[str, np.ndarray], keep_first: bool) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each class, and the places that repeat in full. Equal places count once.

    A class is a run in the order of contexts, so with ``keep_first`` its places repeat where their longest previous factor is the whole context.
    """
    n = len(a["pos"])
    first, covered = np.ones(n, bool), np.zeros(n, bool)
    order = np.argsort(a["gram"], kind="stable")
    g = a["gram"][order]
    twin = np.zeros(n, bool)
    twin[1:] = g[1:] == g[:-1]
    twin[:-1] |= twin[1:]
    some = order[twin]  # the others are alone with their gram
    if not len(some):
        return first, covered
    fields = ("gram", "context", "low", "high", "key", "th", "pos")
    b = {f: a[f][some] for f in fields}
    order = np.lexsort([b[f] for f in reversed(fields)])
    as_before = {f: np.concatenate([[False], b[f][order[1:]] == b[f][order[:-1]]]) for f in fields}
    same = np.logical_and.reduce([as_before[f] for f in fields[:4]])  # class
    new_place = ~(same & as_before["key"] & as_before["th"] & as_before["pos"])
    number = np.cumsum(~same) - 1
    total, rank = np.bincount(number, new_place), np.cumsum(new_place)
    again = longest_previous_factor(rank, same.astype(np.int8)) > 0 if keep_first else total[number] > 1
    first[some[order[same]]] = False
    covered[some[order[again]]] = True
    return first, covered


@tidy
def _resolve(batches: Iterator[pa.RecordBatch], units: Units, keep_first: bool, frequent: Frequent = NONE) -> Iterator[pa.RecordBatch]:
    held = []
    for batch in batches:
        mine = batch.column("key").is_null().to_numpy(zero_copy_only=False)
        if not mine.all():
            yield batch.filter(pa.array(~mine))
        held += [_unpack(b, units) for b in batch.filter(pa.array(mine)).column("blob").to_pylist()]
    if not held:
        return
    a = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
    del held
    first, covered = _classes(a, keep_first)
    whole = covered & ((a["left"].astype(int) + a["right"]) >= units.window)
    at = np.flatnonzero(whole)
    at = at[np.lexsort((a["pos"][at], a["th"][at], a["key"][at]))]
    pos = a["pos"][at].astype(np.int64)
    yield from _covers(_FLOW, a["key"][at], a["th"][at], pos - a["left"][at], pos + a["right"][at], np.zeros(len(at), np.int32))
    reps = np.flatnonzero(first)
    asked = np.zeros(len(reps), bool)
    for side in ("low", "high"):
        order = np.lexsort((a[side][reps], a["gram"][reps]))
        g, s = a["gram"][reps][order], a[side][reps][order]
        equal = (g[1:] == g[:-1]) & (s[1:] == s[:-1])
        asked[order[1:][equal]] = True
        asked[order[:-1][equal]] = True
    split = np.flatnonzero(np.isin(a["gram"][reps], frequent.grams))
    if len(split):
        mine = {k: a[k][reps[split]] for k in ("gram", "low", "high")}
        asked[split] |= np.isin(_half(mine, "low"), frequent.halves) | np.isin(_half(mine, "high"), frequent.halves)
    go = reps[asked]
    if not len(go):
        return
    _, inverse, counts = np.unique(a["gram"][go], return_inverse=True, return_counts=True)
    among = np.where(np.isin(a["gram"][go], frequent.grams), HOT[units.kind] + 1, counts[inverse])  # no task has all of a frequent gram
    for x in range(0, len(go), 65536):
        some, m = go[x : x + 65536], len(go[x : x + 65536])
        yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int32()), pa.array(a["key"][some]), pa.array(a["th"][some]), pa.nulls(m, pa.binary()), pa.array(a["pos"][some].astype(np.int32)), pa.array(a["gram"][some].view(np.int64)), pa.array(among[x : x + 65536].astype(np.int32))], schema=_FLOW)


@tidy
def _contexts(batches: Iterator[pa.RecordBatch], units: Units, targets: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int32()), ("gram", pa.int64()), ("key", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("units", pa.binary())])
    out: list[list] = [[] for _ in schema]

    def put(*row) -> None:
        for column, x in zip(out, row):
            column.append(x)

    for key, th, text, asked, _ in rows(batches):
        whole = units.split(text)
        for want in asked:
            pos, gram, among = want["pos"], want["gram"], want["among"]
            a, b = max(0, pos - units.side), min(len(whole), pos + units.window)
            if among <= HOT[units.kind]:
                put((gram & _MASK64) % targets, gram, key, th, a, units.join(whole[a:b]))
                continue
            for s in range(a, b - units.window + 1):
                one = units.join(whole[s : s + units.window])
                h = xxhash.xxh3_64_intdigest(one)
                put(h % targets, h - (1 << 64) if h >> 63 else h, key, th, s, one)
        if len(out[0]) >= 4096:
            yield flush(out, schema)
    yield flush(out, schema)


@tidy
def _settled(batches: Iterator[pa.RecordBatch], units: Units, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ``_contexts``; of equal rows of just one window the first place goes on, and places known to repeat leave as runs (start -1, units the run)."""
    held: dict[tuple[int, int, bytes], set[tuple[int, int, int]]] = {}
    n, schema = 0, None

    def settle() -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in schema]
        covered: dict[tuple[int, int], list[int]] = {}
        for (bucket, gram, one), places in held.items():
            first = min(places)
            for column, x in zip(out, (bucket, gram, *first, one)):
                column.append(x)
            if len(places) > 1:
                for place in places:
                    if not keep_first or place != first:
                        covered.setdefault(place[:2], []).append(place[2])
        held.clear()
        for (key, th), starts in covered.items():
            start = np.array(starts, np.int64)
            runs = np.stack(merge(start, start + units.window), 1).astype("<i4").tobytes()
            for column, x in zip(out, ((key ^ th) & 0x7FFFFFFF, 0, key, th, -1, runs)):
                column.append(x)
        yield flush(out, schema)

    for batch in batches:
        schema, cut = batch.schema, batch.column("units")
        size = pc.binary_length(cut) if units.kind == "bytes" else pc.add(pc.count_substring(cut, b" "), 1)
        single = pc.equal(size, units.window)
        yield batch.filter(pc.invert(single))
        for bucket, gram, key, th, start, one in rows(iter([batch.filter(single)])):
            places = held.setdefault((bucket, gram, one), set())
            n += (key, th, start) not in places
            places.add((key, th, start))
            if n >= HELD:
                yield from settle()
                n = 0
    if held:
        yield from settle()


def repeats(docs: DataFrame, units: Units, keep_first: bool, decide: Callable, finish: Callable, finish_ddl: str, carry: list[Column] | None = None) -> DataFrame:
    """``finish`` applied to every document and the runs of units that repeat; ``carry`` comes along as a struct column ``carried``.

    ``keep_first``: the first place of a window doesn't count as a repeat.
    ``decide``: from a list of (gram, key, th, start, units as bytes) with equal windows together to a list of (key, th, start, end).
    ``finish``: from lists of key, text and runs to a batch with the columns of ``finish_ddl``.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    targets = 4 * n
    carried = F.struct(*carry) if carry else F.lit(None).cast("int")
    whole = docs.select(doc_key().alias("key"), text_bytes().alias("text"), carried.alias("carried")).withColumn("th", F.xxhash64("text"))
    keyed = whole.select("key", "th", "text")
    many = find_frequent(docs, units, keep_first)
    flow = keyed.mapInArrow(lambda b: _anchors(b, units, targets, keep_first, many), _FLOW_DDL)
    flow = written(flow.repartition(n, "target").mapInArrow(lambda b: _resolve(b, units, keep_first, many), _FLOW_DDL).drop("target"), "repeats")
    asked = flow.where("pos is not null").groupBy("key", "th").agg(F.collect_set(F.struct("pos", "gram", "among")).alias("asked"))  # as long as the document at most
    dealt = whole.select("key", "th", "text", "carried").repartition(n, "key", "th")  # shuffled once, for both joins: they take the same columns
    found = (
        dealt.join(asked.hint("shuffle_hash"), ["key", "th"])
        .select("key", "th", "text", "asked", "carried")
        .mapInArrow(lambda b: _settled(_contexts(b, units, targets), units, keep_first), "bucket int, gram long, key long, th long, start int, units binary")
        .repartition(n, "bucket")
        .select("gram", "key", "th", "start", "units")
        .mapInArrow(lambda b: _decided(b, decide), "key long, th long, blob binary")
    )
    runs = flow.where("blob is not null").select("key", "th", "blob").union(found).groupBy("key", "th").agg(F.collect_list("blob").alias("runs"))

    @tidy
    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                spans = []
                for blobs in part.column(2).to_pylist():
                    x = np.frombuffer(b"".join(blobs or ()), "<i4").reshape(-1, 2)
                    spans.append(np.stack(merge(x[:, 0], x[:, 1]), 1) if len(x) else x)
                out = finish(part.column(0).to_pylist(), part.column(1).to_pylist(), spans)
                yield pa.RecordBatch.from_arrays([*out.columns, part.column(3)], names=[*out.schema.names, "carried"])

    schema = StructType([*_parse_datatype_string(finish_ddl), whole.schema["carried"]])
    return dealt.join(runs.hint("shuffle_hash"), ["key", "th"], "left").select("key", "text", "runs", "carried").mapInArrow(done, schema)


@tidy
def _decided(batches: Iterator[pa.RecordBatch], decide: Callable) -> Iterator[pa.RecordBatch]:
    """Contexts by gram, whole grams together up to about a million units at a time."""
    held = []
    for batch in batches:
        run = pc.less(batch.column("start"), 0)  # settled before
        if pc.any(run).as_py():
            known = batch.filter(run)
            yield pa.RecordBatch.from_arrays([known.column("key"), known.column("th"), known.column("units")], names=["key", "th", "blob"])
        held += rows(iter([batch.filter(pc.invert(run))]))
    held.sort()
    at = 0
    while at < len(held):
        end, size = at, 0
        while end < len(held) and (size < 1 << 20 or held[end][0] == held[end - 1][0]):
            size += len(held[end][4])
            end += 1
        found = decide(held[at:end])
        if found:
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([f[0] for f in found], pa.int64()), "th": pa.array([f[1] for f in found], pa.int64()),
                "blob": pa.array([np.array(f[2:], "<i4").tobytes() for f in found], pa.binary()),
            })
        at = end
