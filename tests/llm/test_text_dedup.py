"""Suffix-array and suffix-automaton dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagewright.llm import _repeats, substring_dedup, suffix_dedup


def documents(rows):
    """Distinct (doc_id, text) as bytes; the order of ids, null first."""
    return sorted({(r[0] if r[0] is not None else -(2**63), (r[1] or "").encode()) for r in rows})


def brute(units, window, keep_first):
    """Covered places of each document; documents with one id come in any order among themselves, so only ids without ties are judged."""
    places = defaultdict(list)
    for d, us in enumerate(units):
        for i in range(len(us) - window + 1):
            places[tuple(us[i : i + window]) if isinstance(us, list) else us[i : i + window]].append((d, i))
    covered = [bytearray(len(us)) for us in units]
    for found in places.values():
        if len(found) > 1:
            for d, i in found[1:] if keep_first else found:
                covered[d][i : i + window] = b"\1" * window
    return covered


def test_suffix_dedup(spark, docs, rows):
    found = {(r["doc_id"], r["kept_sha256"]): r for r in suffix_dedup.dedup(docs).withColumn("kept_sha256", F.sha2("kept", 256)).collect()}
    every = documents(rows)
    counted = defaultdict(int)
    for key, _ in every:
        counted[key] += 1
    for (key, text), mask in zip(every, brute([t for _, t in every], 100, True)):
        if counted[key] > 1:
            continue
        kept = bytes(b for b, m in zip(text, mask) if not m)
        row = found[None if key == -(2**63) else key, hashlib.sha256(kept).hexdigest()]
        runs = sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(text), sum(mask), runs)


def test_substring_dedup(spark, docs, rows):
    found = {(r["doc_id"], r["kept_sha256"]): r for r in substring_dedup.dedup(docs).withColumn("kept_sha256", F.sha2("kept", 256)).collect()}
    every = documents(rows)
    units = [t.split() for _, t in every]
    for (key, _), words, mask in zip(every, units, brute(units, 35, False)):
        kept = b" ".join(w for w, m in zip(words, mask) if not m)
        row = found[None if key == -(2**63) else key, hashlib.sha256(kept).hexdigest()]
        assert (row["n_words"], row["n_removed"]) == (len(words), sum(mask))


def test_a_row_comes_out_for_every_row(docs, rows, nothing):
    assert suffix_dedup.dedup(docs).count() == len(rows) == substring_dedup.dedup(docs).count()
    assert suffix_dedup.dedup(nothing).count() == 0 == substring_dedup.dedup(nothing).count()


def test_cleaned_documents_keep_their_columns(docs, rows, nothing):
    out = suffix_dedup.clean(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    lost = out.where("doc_id = 1000").first()
    assert lost["text"] is None and lost["lang"] is None
    assert out.where("n_chars != char_length(text)").count() == 0
    assert suffix_dedup.clean(nothing).count() == 0


@pytest.mark.parametrize("hot", [30_000, 2])
def test_contexts_dealt_by_window_decide_the_same(hot, monkeypatch):
    """Grams with too many contexts are dealt by window; the result can't differ."""
    monkeypatch.setattr(_repeats, "HOT", {"bytes": hot, "words": hot})
    rnd = random.Random(1)
    same = bytes(rnd.randrange(97, 123) for _ in range(40))
    texts = [bytes(rnd.randrange(97, 100) for _ in range(30)) + same + bytes(rnd.randrange(97, 99) for _ in range(30)) for _ in range(20)]
    units = _repeats.Units("bytes", 45, 20)


    batch = pa.RecordBatch.from_pydict({"key": list(range(20)), "th": [0] * 20, "text": texts})
    flow = list(_repeats._resolve(iter([b for b in _repeats._anchors(iter([batch]), units, 1, True)]), units, True))
    spans = defaultdict(list)
    asked = defaultdict(list)
    for b in flow:
        for r in b.to_pylist():
            if r["blob"] is None:
                asked[r["key"]].append(r)
            else:
                spans[r["key"]].append(r["blob"])
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64()), ("among", pa.int32())]))
    want = pa.RecordBatch.from_arrays([pa.array(list(asked), pa.int64()), pa.array([0] * len(asked)), pa.array([texts[k] for k in asked]), pa.array([[{n: r[n] for n in ("pos", "gram", "among")} for r in v] for v in asked.values()], kind), pa.nulls(len(asked))], names=["key", "th", "text", "asked", "carried"])
    contexts = [tuple(r[n] for n in ("gram", "key", "th", "start", "units")) for b in _repeats._contexts(iter([want]), units, 1) for r in b.to_pylist()]
    for key, _, start, end in suffix_dedup.earlier_matches(sorted(contexts), 45):
        spans[key].append(np.array([start, end], "<i4").tobytes())
    for k, mask in enumerate(brute(texts, 45, True)):


        got = np.zeros(len(texts[k]), bool)
        for a, b in np.frombuffer(b"".join(spans[k]), "<i4").reshape(-1, 2):
            got[a:b] = True
        assert got.tolist() == [bool(m) for m in mask]


@pytest.mark.parametrize(("kind", "keep_first"), [("bytes", True), ("words", False)])
def test_hot_windows_send_a_row_a_task(kind, keep_first, monkeypatch):
    """A passage that many documents share in different surroundings leaves a task once, and the result can't differ."""
    monkeypatch.setattr(_repeats, "HOT", {"bytes": 2, "words": 2})
    monkeypatch.setattr(_repeats, "HELD", 4096)
    rnd = random.Random(3)
    word = lambda: bytes(rnd.randrange(97, 123) for _ in range(1 if kind == "bytes" else 4))
    glue = b"" if kind == "bytes" else b" "
    same = [word() for _ in range(50)]
    texts = [glue.join([*[word() for _ in range(30)], *same, *[word() for _ in range(30)]]) for _ in range(60)]
    units = _repeats.Units(kind, 45, 20)
    flow = [r for b in _repeats._resolve(_repeats._anchors(iter([pa.RecordBatch.from_pydict({"key": list(range(60)), "th": [0] * 60, "text": texts})]), units, 1, keep_first), units, keep_first) for r in b.to_pylist()]
    asked = defaultdict(list)
    for r in flow:
        if r["blob"] is None:
            asked[r["key"]].append({n: r[n] for n in ("pos", "gram", "among")})
    sent = []
    list_of = pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64()), ("among", pa.int32())]))
    for keys in (range(0, 30), range(30, 60)):  # two tasks
        want = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([0] * 30), pa.array([texts[k] for k in keys]), pa.array([asked[k] for k in keys], list_of), pa.nulls(30)], names=["key", "th", "text", "asked", "carried"])
        sent += _repeats._settled(_repeats._contexts(iter([want]), units, 1), units, keep_first)
    window = glue.join(same[:45])
    assert sum(r["units"] == window for b in sent for r in b.to_pylist()) == 2
    decide = suffix_dedup.earlier_matches if kind == "bytes" else substring_dedup.repeated_runs
    decided = _repeats._decided((b.select(["gram", "key", "th", "start", "units"]) for b in sent), lambda c: decide(c, 45))
    spans = defaultdict(bytes)
    for r in [*(r for b in decided for r in b.to_pylist()), *(r for r in flow if r["blob"] is not None)]:
        spans[r["key"]] += r["blob"]
    split = [units.split(t) for t in texts]
    for k, mask in enumerate(brute(split, 45, keep_first)):
        got = np.zeros(len(split[k]), bool)
        for a, b in np.frombuffer(spans[k], "<i4").reshape(-1, 2):
            got[a:b] = True
        assert got.tolist() == [bool(m) for m in mask]


@pytest.mark.parametrize("least", [2, 8, 10**6])
def test_frequent_grams_meet_by_half(spark, least, monkeypatch):
    """Grams (and halves) of too many contexts for one task meet elsewhere; the result can't differ."""
    monkeypatch.setattr(_repeats, "MEET", least)
    monkeypatch.setattr(_repeats, "HITS", 1)
    rnd = random.Random(11)
    word = lambda: "".join(chr(rnd.randrange(97, 123)) for _ in range(rnd.randrange(2, 7)))
    same, left, right = ([word() for _ in range(n)] for n in (20, 18, 18))
    middles = [[*left[18 - i % 19 :], *same, *right[: i * 7 % 19]] for i in range(48)]
    texts = [" ".join([*[word() for _ in range(25)], *m, *[word() for _ in range(25)]]) for m in middles]
    texts += texts[:6] + [" ".join(m) for m in middles[:4]] + [texts[0] + " " + texts[0], "", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for kind in ("bytes", "words"):
        units = _repeats.Units(kind, 35, substring_dedup.GRAM) if kind == "words" else _repeats.Units(kind, 100, suffix_dedup.GRAM)
        many = _repeats.find_frequent(df, units, kind == "bytes")
        assert (len(many.grams) > 0, len(many.halves) > 0) == ((True, True) if least < 10**6 else (False, False))
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.dedup(df).collect()}
    whole = [t.encode() for t in texts]
    for i, (text, mask) in enumerate(zip(whole, brute(whole, 100, True))):
        assert kept[i] == bytes(b for b, m in zip(text, mask) if not m), i
    kept = {r["doc_id"]: bytes(r["kept"]) for r in substring_dedup.dedup(df).collect()}
    split = [t.split() for t in whole]
    for i, (units, mask) in enumerate(zip(split, brute(split, 35, False))):
        assert kept[i] == b" ".join(w for w, m in zip(units, mask) if not m), i


def test_lengths_over_a_byte(spark):
    """Copies of a passage in several partitions are found whatever the length of a window."""
    rnd = random.Random(7)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(6000)]
    passage = [f"p{rnd.randrange(10**6)}" for _ in range(400)]
    rows = [(i, " ".join([*rnd.sample(words, 40 + i), *passage[i % 3 : 400 - i % 5], *rnd.sample(words, 30)])) for i in range(12)]
    rows += [(20 + i, rows[i][1]) for i in range(3)] + [(40, " ".join(passage[:299])), (41, " ".join(passage[100:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.dedup(df, length=300).collect()}
    texts = [t.encode() for _, t in rows]
    for (i, _), text, mask in zip(rows, texts, brute(texts, 300, True)):
        assert kept[i] == bytes(b for b, m in zip(text, mask) if not m), i
    kept = {r["doc_id"]: bytes(r["kept"]) for r in substring_dedup.dedup(df, length=300).collect()}
    for (i, _), units, mask in zip(rows, [t.split() for t in texts], brute([t.split() for t in texts], 300, False)):
        assert kept[i] == b" ".join(w for w, m in zip(units, mask) if not m), i


@pytest.mark.parametrize("seed", range(6))
def test_longest_previous_factor(seed):
    rnd = random.Random(seed)
    length = rnd.choice([5, 8, 13, 20])
    text = bytes(rnd.choice([b"ab", b"abc", b"\xff\x00a"][seed % 3]) for _ in range(rnd.randrange(40, 160))) * (1 + seed % 2)
    starts = np.arange(len(text) - length + 1)
    order, lcp = suffix_dedup.suffix_array(np.frombuffer(text, np.uint8), starts, length)
    assert [text[i : i + length] for i in order] == sorted(text[i : i + length] for i in starts)
    shared = lambda i, j: next((k for k in range(length) if text[i + k] != text[j + k]), length)
    assert lcp.tolist() == [0, *(shared(a, b) for a, b in zip(order, order[1:]))]
    factors = _repeats.longest_previous_factor(order, lcp)
    assert factors.tolist() == [max((shared(i, j) for j in range(i)), default=0) for i in order]


def test_suffix_automaton_counts_places():
    automaton = substring_dedup.SuffixAutomaton()
    a, b = [1, 2, 3, 1, 2, 3, 4], [5, 2, 3, 4, 4]
    automaton.add(a)
    automaton.add(b)
    automaton.count()
    assert automaton.repeated_ends(a, 3) == [3, 6, 7]
    assert automaton.repeated_ends(b, 3) == [4]
    assert automaton.repeated_ends(b, 4) == []
