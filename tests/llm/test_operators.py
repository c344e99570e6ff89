"""The other operators against brute force, on a small corpus with every odd case."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagewright.llm import _components, _tokens, decontamination, embeddings, licenses, packing, sharding, simhash, token_files, toxicity

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text: bytes) -> bytes:
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), text)


def reachable(n, linked):
    seen = [-1] * n
    for i in range(n):
        if seen[i] < 0:
            seen[i], todo = i, [i]
            while todo:
                u = todo.pop()
                for w in linked(u):
                    if seen[w] < 0:
                        seen[w] = i
                        todo.append(w)
    return seen


# SimHash -----------------------------------------------------------------------------------------


def fingerprint(text: bytes) -> int:
    words = SPLIT.findall(lower(text))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(docs, rows, nothing):
    found = simhash.components(docs).collect()
    assert len(found) == len(rows)
    keys = [r[0] if r[0] is not None else -(2**63) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: keys[i])
    prints = [fingerprint((rows[i][1] or "").encode()) for i in order]
    roots = reachable(len(order), lambda u: [w for w in range(len(order)) if (prints[u] ^ prints[w]).bit_count() <= 2])
    want = sorted((keys[i], p - (1 << 64) if p >> 63 else p, keys[order[r]]) for i, p, r in zip(order, prints, roots))
    assert sorted((r["key"], r["fp"], r["component"]) for r in found) == want
    assert simhash.components(nothing).count() == 0


def test_links_find_every_pair_within_the_radius(spark):
    """Fingerprints around a few centres, many to a bucket: the links' components are those of all pairs."""
    rnd = random.Random(2)
    prints = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(40):
            x = centre
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    roots = {r["node"]: r["root"] for r in _components.connected_components(edges).collect()}
    want = reachable(len(prints), lambda u: [w for w in range(len(prints)) if ((prints[u] ^ prints[w]) & (2**64 - 1)).bit_count() <= 2])
    assert [roots.get(p, p) for p in prints] == [prints[r] for r in want]


def test_every_pair_of_positions_agrees_in_some_table():
    masks = simhash.covering_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_one_document_of_a_group_stays(docs, rows):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == simhash.components(docs).select("component", "component_th").distinct().count()
    assert kept.where("doc_id = 7").count() == 2  # two texts of one id, unlike each other
    assert kept.where("doc_id < 60 and _pw != doc_id and doc_id != 7").count() == 0  # a column with an inner name keeps its values


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1002), (1002, 1001), (5, 5)]
    random.Random(1).shuffle(edges)
    found = {r["node"]: r["root"] for r in _components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert all(found[i] == 0 for i in range(301)) and {found[i] for i in (1000, 1001, 1002)} == {1000}


# Sharding ----------------------------------------------------------------------------------------


def hilbert(cell, bits):
    """Place of a cell by walking the curve (Skilling's transform, step by step)."""
    x, n = list(cell), len(cell)
    q = 1 << bits - 1
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << bits - 1
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_hilbert_index_walks_through_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        side = 1 << bits
        cells = [[(c // side**i) % side for i in range(n)] for c in range(side**n)]
        df = spark.createDataFrame([(c,) for c in cells], "c array<int>").select("c", sharding.hilbert_index([F.col("c")[i] for i in range(n)], bits).alias("h"))
        place = {tuple(r["c"]): r["h"] for r in df.collect()}
        assert all(place[tuple(c)] == hilbert(c, bits) for c in cells)
        walk = sorted(place, key=place.get)
        assert [place[c] for c in walk] == list(range(side**n))
        assert all(sum(abs(a - b) for a, b in zip(u, v)) == 1 for u, v in zip(walk, walk[1:]))


def test_shards(docs, rows, nothing):
    found = sharding.assign(docs, ["doc_id", "key"]).select("doc_id", "key", "_pw.*").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in found) == sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(24)) and max(map(len, slots.values())) - min(map(len, slots.values()), default=0) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(nothing, ["doc_id"]).count() == 0


def test_written_shards_hold_every_row(spark, docs, rows, tmp_path):
    sharding.write_shards(docs, f"file://{tmp_path}/shards", shards=3)
    assert spark.read.parquet(f"file://{tmp_path}/shards").drop("shard").count() == len(rows)


# Licences ----------------------------------------------------------------------------------------


def test_licenses(spark, nothing):
    notice = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
    texts = ["", None, "Apache License, Version 2.0 and the apache-license", "gnu general public", "MIT MIT LICENSE mit license", notice, "CC BY", "cc by" * 3, notice.replace("free ", ""), "word " * 5000 + "mit license"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(2, texts[2])], "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(df, ["doc_id"]).select("doc_id", "_pw.*").collect()}
    for i, t in enumerate(texts):
        words = WORD.findall(lower((t or "").encode()))
        places = sorted((at, label) for phrase, label in licenses.BASE.items() for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.encode().split())
        r = found[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert found[5]["score"] == 1.0 and found[3]["score"] == 0.0 and found[8]["n_base"] == 1
    assert licenses.scan(nothing, ["doc_id"]).count() == 0


def brute_labels(index, words):
    """Labels and best share, with every template tried at every place."""
    labels, best = set(), 0.0
    for k, t in enumerate(licenses.TEMPLATES):
        for begin in range(-len(t.words), len(words)):
            if t.phrase:
                share = float(begin >= 0 and words[begin : begin + len(t.words)] == t.words)
            else:
                near = range(max(0, begin + t.key_at - licenses.WOBBLE), max(0, begin + t.key_at + licenses.WOBBLE + 1))
                share = index.share(k, begin, words) if any(words[p : p + len(t.key)] == t.key for p in near) else 0.0
            best = max(best, share)
            if share >= (1 if t.phrase else licenses.NOTICE_SHARE):
                labels.add(t.label)
    return labels, best


def test_license_labels_against_every_place():
    rnd = random.Random(11)
    index = licenses.RareTokenIndex(1000, {w: rnd.choice([0, 3, 40, 400, 990]) for w in licenses.VOCABULARY})
    common = [f"w{i}".encode() for i in range(50)] + sorted(licenses.VOCABULARY)[:40]
    right = wanted = 0
    for _ in range(150):
        words = [rnd.choice(common) for _ in range(rnd.randrange(0, 30))]
        for t in rnd.sample(licenses.TEMPLATES, rnd.randrange(0, 3)):
            text = [w for w in t.words if rnd.random() > 0.06]
            text = [rnd.choice(common) if rnd.random() < 0.05 else w for w in text]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = text
        want, best = brute_labels(index, words)
        got = index.scan(words)
        labels = set(got[5].split(",")) - {""}
        assert labels <= want and got[6] <= best + 1e-9
        phrases = {t.label for t in licenses.TEMPLATES if t.phrase and any(words[i : i + len(t.words)] == t.words for i in range(len(words)))}
        assert phrases <= labels
        right, wanted = right + len(labels), wanted + len(want)
    assert right >= 0.97 * wanted and wanted > 80


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: MIT", {"mit"}), ("SPDX-License-Identifier: Apache-2.0", {"apache"}), ("the BSD 3-Clause text", {"bsd"}),
        ("Creative Commons Attribution-ShareAlike 4.0", {"cc-by", "cc-by-sa"}), ("GNU Affero General Public License", {"agpl"}),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", {"mit"}),
        ("This is free and unencumbered software, released into the public domain.", {"unlicense"}), ("free software", set()),
    ],
)
def test_license_names_and_identifiers(text, labels):
    found = licenses.RareTokenIndex(10, {}).scan(WORD.findall(lower(text.encode())))
    assert set(found[5].split(",")) - {""} == labels and found[6] == (1.0 if labels else 0.0)


def test_license_columns_may_clash(spark):
    df = spark.createDataFrame([(1, "mit license", 5, "x")], "doc_id long, text string, _pw int, labels string")
    out = licenses.scan(df, df.columns)
    assert out.columns == ["doc_id", "text", "labels", "_pw"] and out.first()["_pw"]["labels"] == "mit"


# Embeddings --------------------------------------------------------------------------------------


def test_embeddings(spark):
    rnd = np.random.default_rng(4)
    rows, at = [], 0
    for label in (1, 2, None):
        centres = rnd.normal(size=(6, 16))
        for _ in range(90):
            rows.append((at, (centres[rnd.integers(6)] + rnd.normal(size=16) * 0.28).astype(np.float32).tolist(), label, "x"))
            at += 1
    rows += [(at, rows[3][1], 1, "copy"), (at + 1, rows[3][1], 1, "copy"), (at + 2, None, 1, ""), (at + 3, [0.0] * 16, 1, ""), (at + 4, [float("nan")] * 16, 1, ""), (at + 5, [None] * 16, 1, ""), (at + 6, [], 1, ""), (at + 7, [1.0, 2.0], 1, ""), (at + 8, [2.0, 4.0], 1, ""), (at + 9, [1e-30] + [0.0] * 15, 2, ""), (at + 10, [3e30] + [0.0] * 15, 2, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key string")

    def cosine(a, b):
        u, v = np.array(a, float), np.array(b, float)
        u, v = u / np.abs(u).max(), v / np.abs(v).max()
        return u @ v / math.sqrt((u @ u) * (v @ v))

    ok = [r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    linked = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= 0.93] for i in range(len(rows))]
    roots = reachable(len(rows), lambda u: linked[u])
    for tile in (1024, 16):
        found = {r["key"]: r for r in embeddings.near_duplicates(df, tile=tile).collect()}
        assert len(found) == len(rows)
        for i, r in enumerate(rows):
            assert (found[r[0]]["n_links"], found[r[0]]["component"]) == (len(linked[i]), rows[roots[i]][0]), r[0]
    assert sum(map(len, linked)) > 50
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_with_null_and_repeated_ids(spark):
    """An id names no row: unusable rows stay beside usable ones of their id, different vectors of an id keep their own links."""
    x, near, y, z = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [
        (None, x, 1), (None, y, 1), (None, z, 2), (None, None, 1), (None, [0.0] * 3, 1), (None, x, None),
        (5, x, 2), (5, y, 2), (5, None, 2), (5, [float("nan")] * 3, 2), (5, y, 1),
        (7, near, 2), (8, z, 1), (8, z, 1), (8, None, 1), (9, y, 1), (9, y, None), (4, [0.0, 1.0, 0.1], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    cosine = lambda a, b: np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b))
    ok = [r[2] is not None and bool(r[1]) and all(map(math.isfinite, r[1])) and any(r[1]) for r in rows]
    linked = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and cosine(rows[i][1], rows[j][1]) >= 0.93] for i in range(len(rows))]
    keys = [r[0] if r[0] is not None else -(2**63) for r in rows]
    roots = reachable(len(rows), lambda u: linked[u])
    want = sorted((keys[i], len(linked[i]), min(k for k, r in zip(keys, roots) if r == roots[i])) for i in range(len(rows)))
    for tile in (1024, 2):
        assert sorted((r["key"], r["n_links"], r["component"]) for r in embeddings.near_duplicates(df.repartition(3), tile=tile).collect()) == want


# Decontamination ---------------------------------------------------------------------------------


def test_embeddings_of_many_sizes(spark, monkeypatch):
    """Sizes that few vectors have aren't turned, and common vectors are joined by broadcast: the result can't differ."""
    rnd = np.random.default_rng(9)
    rows = []
    for size in range(1, 41):
        base = rnd.normal(size=(3, size))
        rows += [(len(rows) + i, (base[i % 3] + rnd.normal(scale=0.1, size=size)).tolist(), size % 3) for i in range(6)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    vectors = [np.array(v) for _, v, _ in rows]
    linked = lambda i, j: i != j and rows[i][2] == rows[j][2] and len(vectors[i]) == len(vectors[j]) and float(vectors[i] @ vectors[j] / np.linalg.norm(vectors[i]) / np.linalg.norm(vectors[j])) >= 0.93
    near = [[j for j in range(len(rows)) if linked(i, j)] for i in range(len(rows))]
    roots = reachable(len(rows), lambda u: near[u])
    want = sorted((rows[i][0], len(near[i]), rows[roots[i]][0]) for i in range(len(rows)))
    for share, tile in ((1000, 1024), (10**9, 3)):
        monkeypatch.setattr(embeddings, "HOT_SHARE", share)
        assert sorted(tuple(r) for r in embeddings.near_duplicates(df, tile=tile).select("key", "n_links", "component").collect()) == want


def test_decontamination(spark, docs, rows, nothing):
    rnd = random.Random(9)
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 30]
    items = [(i, " ".join(rnd.choice(texts).split()[3:25])) for i in range(12)] + [(50, "lo re"), (51, ""), (52, None), (53, texts[0].split()[0]), (None, " ".join(texts[1].split()[:14])), (3, "Repeated item text"), (3, "Repeated item text")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(lower((text or "").encode()))
        for at in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[at : at + 13])] |= {str(item)} if item is not None else set()
    found = decontamination.flag(docs, bench, ["doc_id"]).select("doc_id", "_pw.*").collect()
    want = []
    for r in rows:
        words = WORD.findall(lower((r[1] or "").encode()))
        hit, owners = bytearray(len(words)), set()
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                if (w := tuple(words[at : at + n])) in windows:
                    hit[at : at + n] = b"\1" * n
                    owners |= windows[w]
        want.append((r[0], len(words), sum(hit), len(owners), sum(hit) > 0 and 20 * sum(hit) >= len(words)))
    order = lambda t: (t[0] is None, t[0] or 0, *t[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in found), key=order) == sorted(want, key=order)
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    assert kept.where("doc_id < 60 and _pw != doc_id and doc_id != 7").count() == 0
    assert decontamination.flag(docs, bench.limit(0), ["doc_id"]).where("_pw.contaminated").count() == 0
    assert decontamination.clean(nothing, bench).count() == 0


def test_items_in_shards_find_the_same(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(i, " ".join(r["text"].split()[:20])) for i, r in enumerate(docs.where("length(text) > 200").limit(9).collect())], "item_id long, text string")
    once = decontamination.flag(docs, bench, ["doc_id"]).select("doc_id", "_pw.*").collect()
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 200)
    assert sorted(map(str, once)) == sorted(map(str, decontamination.flag(docs, bench, ["doc_id"]).select("doc_id", "_pw.*").collect()))


# Tokens ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_chunks_encode_as_the_whole_text(name, kind):
    encoder = _tokens.encoder(_tokens.vocabulary(name), kind)
    rnd = random.Random(1)
    letters = [*"ab\n\n AB'sé ß\t\xa0 \x1c\x85Σςİ1٣ |<>", "<|endoftext|>", "<|startoftext|>", "é", " ́", "'ll", " \n  ", "　", "ﬁ", "😀"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode_all([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_segments_give_any_id():
    rnd = np.random.default_rng(0)
    for ids in ([], [0], [255, 256], rnd.integers(0, 70_000, 3000), rnd.integers(0, 2**32, 1500)):
        reader = token_files.DacReader(token_files.dac_encode(np.array(ids, np.uint32)))
        assert reader.all().tolist() == [int(x) for x in ids]
        assert all(reader[i] == ids[i] for i in range(len(ids)))
        with pytest.raises(IndexError):
            reader[len(ids)]


def test_token_files_round_trip(spark, docs, rows, nothing, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/tokens"
    token_files.write_token_files(docs, path, _tokens.vocabulary("word_bpe_49k.json"), segment_ids=500)
    assert spark.read.parquet(path).count() > 10
    found = sorted(((r["start"], r["doc_id"], bytes(r["ids"])) for r in token_files.read_token_files(spark, path).collect()))
    encode = _tokens.encoder(_tokens.vocabulary("word_bpe_49k.json"), "word").tokenizer.encode
    keys = [r[1] for r in found]
    assert [k if k is not None else -1 for k in keys] == sorted(r[0] if r[0] is not None else -1 for r in rows)
    want = sorted((r[0] if r[0] is not None else -1, np.array([*encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in rows)
    assert sorted((k if k is not None else -1, ids) for _, k, ids in found) == want
    at = 0
    for start, _, ids in found:
        assert start == at
        at += len(ids) // 4
    ids = {k: np.frombuffer(x, "<u4") for _, k, x in found if [f[1] for f in found].count(k) == 1}
    wanted = [(k, p) for k, x in ids.items() for p in {0, len(x) // 2, len(x) - 1, len(x)}] + [(99_999, 0), (2000, -1)]
    for named in (1000, 1):
        monkeypatch.setattr(token_files, "NAMED", named)
        got = token_files.tokens_at(spark, path, spark.createDataFrame(wanted, "doc_id long, place long")).collect()
        assert sorted((r["doc_id"] or -1, r["place"], r["token"]) for r in got) == sorted((k or -1, p, int(ids[k][p])) for k, p in wanted if k in ids and 0 <= p < len(ids[k]))
    token_files.write_token_files(nothing, f"{path}-none", _tokens.vocabulary("word_bpe_49k.json"))
    assert token_files.read_token_files(spark, f"{path}-none").count() == 0
    wide = np.array([0, 65_535, 65_536, 2**32 - 1], "<u4")
    assert all(token_files._unpacked(token_files._packed(x.tobytes())).tolist() == x.tolist() for x in (wide, wide[:2], wide[:0]))


# Packing -----------------------------------------------------------------------------------------


def test_packing(docs, rows, nothing):
    path = _tokens.vocabulary("byte_bpe_50k.json")
    found = packing.pack(docs, path, capacity=128).collect()
    encode = _tokens.encoder(path, "byte").tokenizer.encode
    pieces = defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
    lengths = sorted(len(encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(r["length"] for r in found) == sum(lengths)
    for r in rows:
        mine = sorted(pieces[r[0]], key=lambda p: p["piece"])
        if sum(x[0] == r[0] for x in rows) == 1:
            ids = [*encode(r[1] or "", add_special_tokens=False).ids, 2]
            assert b"".join(bytes(p["ids"]) for p in mine) == np.array(ids, "<u4").tobytes()
            assert [p["piece"] for p in mine] == list(range(len(mine))) and all(p["length"] == 128 for p in mine[1:])
            assert len(mine) == 1 or len(ids) > 128
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 128
    assert packing.pack(nothing, path).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plans_place_every_piece(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([16, 100, 1024])
    lengths = [rnd.randint(1, capacity) if seed % 2 else min(capacity, 1 + int(rnd.expovariate(4 / capacity))) for _ in range(rnd.choice([0, 1, 50, 3000]))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan_packing(histogram, capacity)
    placed = defaultdict(int)
    for pattern, count in runs:
        assert sum(pattern) <= capacity and count > 0
        for n in pattern:
            placed[n] += count
    assert dict(placed) == histogram
    bound = -(-sum(lengths) // capacity)
    first_fit: list[int] = []
    for n in sorted(lengths, reverse=True):
        at = next((i for i, used in enumerate(first_fit) if used + n <= capacity), None)
        if at is None:
            first_fit.append(n)
        else:
            first_fit[at] += n
    assert bound <= sum(c for _, c in runs) <= len(first_fit) * 1.06 + 3


# Toxicity ----------------------------------------------------------------------------------------


def toxic_corpus(n=900):
    rnd = random.Random(6)
    plain = [f"w{rnd.randrange(400)}x" for _ in range(400)]
    bad = ["vile", "rotten", "filth", "scummy"]
    rows = []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(5, 80))]
        toxic = int(i % 6 == 0)
        for _ in range(3 * toxic):
            words.insert(rnd.randint(0, len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity_held_out(spark, nothing):
    rows = toxic_corpus()
    docs = spark.createDataFrame([(i, t, "k") for i, t, _ in rows] + [(None, None, "k"), (5000, "", "k"), (5001, "vile", "k"), (3, rows[3][1], "k")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (4, 1, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.flag(docs, labels, ["doc_id"]).select("doc_id", "_pw.*").collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum(found[i]["predicted"] == rows[i][2] for i in held)
    assert right / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    assert found[None]["predicted"] == 0 and found[5000]["score"] == found[None]["score"]
    assert len(found[rows[0][0]]["neighbours"]) == toxicity.K and found[rows[0][0]]["cosines"] == sorted(found[rows[0][0]]["cosines"], reverse=True)
    kept = toxicity.clean(docs, labels)
    assert kept.columns == docs.columns
    assert toxicity.flag(nothing, labels, ["doc_id"]).count() == 0
    none = toxicity.flag(docs, labels.limit(0), ["doc_id"]).select("_pw.*").distinct().collect()
    assert [r["score"] for r in none] == [0.0]


def test_documents_without_a_leaning_term_are_searched_by_the_wide_vocabulary(spark):
    """With few examples no term leans beyond chance; the wide vocabulary still finds the nearest examples."""
    rows = toxic_corpus(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, sample=120)
    assert model.wide.number and len(model.wide.ids) <= 120 and len(model.ids) <= 120
    taught = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    for i, text, _ in [*rows, (5000, "", 0)]:
        words = WORD.findall(lower(text.encode()))
        query = model.vector(words) or model.wide.vector(words)
        score, near, cosines = model.score(text.encode())
        assert (len(near) > 0) == bool(query) and set(near) <= taught
        assert cosines == sorted(cosines, reverse=True) and 0 <= score <= 1


def test_scores_against_brute_force(spark):
    """The whole score of every document from the definition: weights, all cosines, votes and the curve."""
    rows = toxic_corpus(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    words = {i: list(toxicity.terms(WORD.findall(lower(t.encode())))) for i, t, _ in rows}
    taught = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = {i: y for i, _, y in rows}
    n, rate = len(taught), sum(toxic[i] for i in taught) / len(taught)
    have = defaultdict(set)
    for i in taught:
        for t in words[i]:
            have[t].add(i)
    tail = lambda b, m: sum(math.comb(m, x) * rate**x * (1 - rate) ** (m - x) for x in range(b, m + 1))
    lean = {t: sum(toxic[i] for i in d) for t, d in have.items()}
    tails = sorted((tail(lean[t], len(d)), t) for t, d in have.items() if 2 * lean[t] > len(d))
    within = [k for k, (p, _) in enumerate(tails, 1) if p <= toxicity.LEVEL * k / len(have)]
    vocabulary = {t for _, t in tails[: max(within, default=0)]}
    wide = {t for t, d in have.items() if len(d) >= 5 and n * (lean[t] * (n - rate * n) - (len(d) - lean[t]) * rate * n) ** 2 / (len(d) * (n - len(d)) * rate * n * (n - rate * n)) >= toxicity.WIDE}
    df = {t: sum(t in set(words[i]) for i, _, _ in rows) for t in vocabulary | wide}

    def vector(i, terms_):
        v = {t: (1 + math.log(words[i].count(t))) * (math.log((len(rows) + 1) / (df[t] + 1)) + 1) for t in set(words[i]) & terms_}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    def judge(terms_, calibrate):
        known = [(i, v) for i in taught if (v := vector(i, terms_))]

        def vote(v, but=None):
            near = sorted(((c, i) for i, w in known if i != but and (c := sum(x * w.get(t, 0) for t, x in v.items())) > 0), key=lambda x: (-round(x[0], 12), x[1]))[: toxicity.K]
            weights = [1 / (toxicity.DISTANCE + max(0, 1 - c)) for c, _ in near]
            return sum(w * toxic[i] for w, (_, i) in zip(weights, near)) / sum(weights) if near else None

        votes = [(x, toxic[i]) for i, v in known if calibrate(i) and (x := vote(v, i)) is not None]
        curve = toxicity.isotonic(np.array([x for x, _ in votes]), np.array([float(y) for _, y in votes]))
        without = [toxic[i] for i in taught if i not in {k for k, _ in known}]
        return vote, curve, (sum(without) + rate) / (len(without) + 1)

    first = judge(vocabulary, lambda i: True)
    second = judge(wide, lambda i: not vector(i, vocabulary))
    found = {r["doc_id"]: r["score"] for r in toxicity.flag(docs, labels, ["doc_id"]).select("doc_id", "_pw.score").collect()}
    for i, _, _ in rows:
        v = vector(i, vocabulary)
        (vote, curve, unknown), v = (first, v) if v else (second, vector(i, wide))
        x = vote(v) if v else None
        assert abs(found[i] - (unknown if x is None else float(np.interp(x, *curve)))) < 1e-6, i


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rows = toxic_corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    out = []
    for flip in (False, True):
        labels = [(i, 1 - y if flip and zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows]
        out.append(sorted((r["doc_id"], r["score"]) for r in toxicity.flag(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), ["doc_id"]).select("doc_id", "_pw.score").collect()))
    assert out[0] == out[1]


def test_block_max_index_gives_the_exact_nearest():
    rnd = random.Random(8)
    vectors = []
    for _ in range(500):
        v = {rnd.randrange(40): rnd.random() + 0.01 for _ in range(rnd.randint(1, 6))}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / norm for t, x in v.items()})
    index = toxicity.BlockMaxIndex(vectors, 40)
    for q in vectors[:60]:
        want = sorted(((sum(w * v.get(t, 0) for t, w in q.items()), d) for d, v in enumerate(vectors)), key=lambda x: (-x[0], x[1]))[:9]
        got = index.nearest(q, 9)
        assert [round(s, 9) for s, _ in got] == [round(s, 9) for s, _ in want]
        assert all(abs(sum(w * vectors[d].get(t, 0) for t, w in q.items()) - s) < 1e-9 for s, d in got)
