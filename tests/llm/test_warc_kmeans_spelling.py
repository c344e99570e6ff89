"""WARC archives, k-means and spelling variants against brute force, with every odd case."""

import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pagewright.llm import kmeans, spelling, warc

# WARC --------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, key string, payload string, n int"


def page_rows():
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abc é\r\n\r\n<p>") for _ in range(n))
    big, other = "b" + text(1500), "é" * 500  # the second has 1000 bytes
    out = [(i, f"http://x/{i}", text(rnd.randint(0, 3000)), "k", "p", i) for i in range(40)]
    out += [(100 + i, f"http://copy/{i}", big, "k", "p", i) for i in range(30)]
    out += [(3, "http://again", big, None, None, None), (129, None, big, None, None, None), (129, "http://copy/29", big, None, None, None)]  # the largest id three times
    out += [(200, "http://a b\r\nEvil: x/é", other, None, None, None), (201, "", other, None, None, None), (202, "u", other[:-1], None, None, None), (203, "u", other[:-1], None, None, None)]
    out += [(None, "n", big, None, None, None), (None, "n", None, None, None, None), (None, None, "only nulls" * 200, None, None, None), (None, None, "only nulls" * 200, None, None, None)]
    out += [(300, "e", "", None, None, None), (301, "e", None, None, None, None), (400, "long", text(400_000), None, None, None)]
    return out


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "a")
    rows = page_rows()
    index = warc.write(spark.createDataFrame(rows, PAGES).repartition(5), folder, file_bytes=60_000)
    return folder, rows, index.collect()


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2] or "", []).append(r)
    out = []
    for text, same in by.items():
        data = text.encode()
        key = lambda r: -math.inf if r[0] is None else r[0]
        last = max(same, key=key)[0]
        spared = False
        for r in same:
            first = r[0] == last and not spared
            spared |= first
            response = len(data) < 1000 or first
            out.append((r[0], len(data), hashlib.sha1(data).hexdigest(), "response" if response else "revisit", None if response else last))
    return sorted(out, key=repr)


def test_warc_round_trip(spark, archive):
    folder, rows, _ = archive
    found = warc.read(spark, folder).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=repr) == expected(rows)
    assert {bytes(r["payload"]) for r in found if r["record_type"] == "response"} == {(r[2] or "").encode() for r in rows}
    assert all(r["payload"] is None for r in found if r["record_type"] == "revisit")
    assert {r["target_uri"] for r in found} >= {"http://a%20b%0D%0AEvil:%20x/%C3%A9", "urn:page:201", "urn:page:129", "urn:page:"}


def test_warc_files_are_members_that_the_index_gives(archive):
    folder, rows, index = archive
    assert len(index) == len(rows) and {r["file"] for r in index} == set(os.listdir(f"{folder}/archive"))
    by_file = {}
    for r in index:
        by_file.setdefault(r["file"], []).append(r)
    ids, named = [], []
    for name, of in by_file.items():
        data = open(f"{folder}/archive/{name}", "rb").read()
        at = None
        for r in sorted(of, key=lambda r: r["offset"]):
            at = at if at is not None else r["offset"]
            assert r["offset"] == at  # no gaps behind the first record, warcinfo
            text = gzip.decompress(data[r["offset"] : r["offset"] + r["length"]])
            head = text.split(b"\r\n\r\n")[0].decode()
            assert head.startswith("WARC/1.1\r\n") and f"WARC-Type: {r['record_type']}\r\n" in head and "\r\nEvil" not in head
            ids += re.findall("WARC-Record-ID: (.*)\r", head)
            named += re.findall("WARC-Refers-To: (.*)\r", head)
            at += r["length"]
        assert at == len(data) and b"warcinfo" in gzip.decompress(data)
    assert len(set(ids)) == len(ids) and set(named) <= set(ids)
    assert len(by_file) > 5  # files end after so many bytes


def test_warc_selected_records_in_few_ranges(spark, archive):
    folder, rows, index = archive
    chosen = warc.index(spark, folder).where("page_id % 3 = 0")
    want = Counter(r["page_id"] for r in index if r["page_id"] is not None and r["page_id"] % 3 == 0)
    assert Counter(r["page_id"] for r in warc.read(spark, folder, chosen, gap=0, chunk=5000).collect()) == want
    ranges = warc.ranges(warc.index(spark, folder)).collect()
    assert len(ranges) == len({r["file"] for r in index})  # neighbours are read as one
    apart = warc.ranges(chosen, gap=0).collect()
    assert sum(r["end"] - r["start"] for r in apart) == sum(r["length"] for r in index if r["page_id"] is not None and r["page_id"] % 3 == 0)
    assert warc.read(spark, folder, warc.index(spark, folder).where("page_id = 400")).first()["payload_bytes"] == len(next(r[2] for r in rows if r[0] == 400).encode())


def test_warc_files_outside_the_index_go_and_damage_is_told(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text"), (2, "u", "other")], "page_id long, url string, html string")
    os.makedirs(tmp_path / "a/archive")
    (tmp_path / "a/archive/left.warc.gz").write_bytes(b"of an attempt that failed")
    index = warc.write(pages.coalesce(1), str(tmp_path / "a")).collect()
    assert os.listdir(tmp_path / "a/archive") == [index[0]["file"]]
    path = tmp_path / "a/archive" / index[0]["file"]
    record = gzip.decompress(path.read_bytes()[index[0]["offset"] :][: index[0]["length"]])
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(gzip.compress(record.replace(b"text\r\n\r\n", b"tex7\r\n\r\n").replace(b"other\r\n\r\n", b"oth3r\r\n\r\n")))


def test_warc_of_no_pages(spark, tmp_path):
    assert warc.write(spark.createDataFrame([], PAGES), str(tmp_path / "a")).count() == 0
    assert warc.read(spark, str(tmp_path / "a")).count() == 0


# k-means -----------------------------------------------------------------------------------------


def brute_kmeans(rows, k, rounds, dims):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) if abs(x) < 2**50 else 256 * int(x) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        near = nearest()
        for j in range(len(centroids)):
            of = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if of:
                centroids[j] = [sum(col) // len(of) for col in zip(*of)]
    near, big = nearest(), 2**63 - 1
    total = sum(d for d, _ in near)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, min(d, big), min(big, sum(x for x, y in near if y == c)), min(total, big), sha[c]) for (i, _), (d, c) in zip(kept, near)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


VECTORS = "vec_id long, embedding array<{}>, label int, x int, cluster string, delta int"


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("large", [1.0, 3e5, 1e30])
def test_kmeans_against_brute_force(spark, kind, large):
    rnd = random.Random(kind + str(large))
    f = (lambda x: float(np.float32(x))) if kind == "float" else float
    centres = [[rnd.uniform(-1, 1) for _ in range(6)] for _ in range(9)]
    rows = [(i, [f(x + rnd.gauss(0, 0.15)) for x in rnd.choice(centres)]) for i in range(400)]
    rows += [(500 + i, [f(0.25 * rnd.randint(-1, 1)) for _ in range(6)]) for i in range(60)]  # ties
    rows += [(700 + i, rows[0][1]) for i in range(150)]  # a third are copies
    rows += [(None, rows[3][1]), (None, rows[4][1]), (7, rows[5][1]), (7, rows[5][1])]
    rows += [(900, None), (901, []), (902, rows[0][1][:5]), (903, rows[0][1] + [0.0]), (904, [None] + rows[0][1][1:]), (905, [math.nan] + rows[0][1][1:]), (906, [-math.inf] + rows[0][1][1:])]
    rows += [(950 + i, [f(large * rnd.uniform(-1, 1)) for _ in range(6)]) for i in range(4)]
    df = spark.createDataFrame([(i, v, 1, 1, "c", 1) for i, v in rows], VECTORS.format(kind)).repartition(6)
    assert got(kmeans.cluster(df, k=12, rounds=4, dims=6)) == brute_kmeans(rows, 12, 4, 6)


def test_kmeans_of_few_or_no_vectors(spark):
    none = spark.createDataFrame([], VECTORS.format("float"))
    assert kmeans.cluster(none).count() == 0
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-7.5, 0.001])]
    few = spark.createDataFrame([(i, v, 1, 1, "c", 1) for i, v in rows], VECTORS.format("float"))
    assert [got(kmeans.cluster(few, k=k, rounds=2, dims=2)) for k in (1, 40)] == [brute_kmeans([(i, [float(np.float32(x)) for x in v]) for i, v in rows], k, 2, 2) for k in (1, 40)]


def test_bounds_spare_scans_and_lose_nothing():
    """Over some rounds fewer and fewer vectors are scanned, and every assignment is that of a whole scan."""
    rnd = np.random.default_rng(5)
    centres = rnd.normal(0, 300, (10, 64))
    x = np.floor(centres[rnd.integers(0, 10, 3000)] + rnd.normal(0, 20, (3000, 64)))
    centroids = [[int(v) for v in row] for row in x[:10]]
    cluster, upper, lower, before, scans = np.full(3000, -1), np.zeros(3000), np.zeros(3000), None, []
    for _ in range(6):
        cluster, upper, lower, scanned = kmeans.Bounds(centroids, before).assign(x, cluster, upper, lower)
        far = kmeans.squared(x, np.array(centroids, float))
        assert (cluster == far.argmin(1)).all()
        assert (upper >= np.sqrt(far.min(1))).all() and (lower <= np.sqrt(np.sort(far, 1)[:, 1])).all()
        scans.append(scanned)
        before, centroids = centroids, [[int(v) for v in x[cluster == c].sum(0) // max(1, (cluster == c).sum())] if (cluster == c).any() else centroids[c] for c in range(10)]
    assert scans[0] == 3000 and scans[-1] < 1500


# Spelling ----------------------------------------------------------------------------------------


def brute_words(rows, one_in=97, min_length=5, min_count=3):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, **named):
    n = brute_words(rows, **named)
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_apart(w, x)] for w in n}
    best = {w: min(x, key=lambda y: (-n[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n), key=repr)


def variants(df, **named):
    return sorted((tuple(r) for r in spelling.variants(df, **named).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def spelled():
    rnd = random.Random(6)
    out = []
    stems = ["".join(rnd.choice("abçÿÀ") for _ in range(rnd.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "abababab", "babababa"]
    for i in range(250):
        words = []
        for _ in range(30):
            w = stems[int(rnd.random() ** 2 * len(stems))]
            if rnd.random() < 0.5:
                at = rnd.randrange(len(w))
                w = w[:at] + rnd.choice(["", w[at] + w[at], "b", "É"]) + w[at + 1 :]
            words.append(rnd.choice([w, w, w.upper(), w.capitalize()]))
        out.append((i, rnd.choice([" ", "-", "1", "Ā", "\n"]).join(words)))
    out += [(None, "ababa ababa ababa"), (900, None), (901, ""), (902, " \n"), (903, "×÷×÷× ×÷×÷× ×÷×÷×")]
    out += [out[0], out[0], (1, "another text under an id that is there")]
    long = "".join(rnd.choice("xyz") for _ in range(30_000))
    out += [(910 + i, f"{long} {long[:99]}q{long[99:]} {long[:-1]}") for i in range(3)]
    return out


@pytest.mark.parametrize("one_in", [97, 3])
def test_spelling_against_brute_force(spark, one_in):
    rows = spelled()
    df = spark.createDataFrame([(i, t, "w", "f", 1) for i, t in rows], "doc_id long, text string, word string, form string, n int").repartition(5)
    found = variants(df, one_in=one_in)
    assert found == brute_variants(rows, one_in=one_in)
    assert any(r[2] not in (r[0], r[1]) for r in found)  # ways of more than one step


def test_spelling_of_the_corpus_and_of_nothing(docs, rows, nothing):
    assert variants(docs) == brute_variants([(r[0], r[1]) for r in rows])
    assert variants(nothing) == []


def test_roots_of_long_ways(spark):
    steps = [(i, i + 1) for i in range(60)] + [(100 + i, 60) for i in range(500)]
    found = {r["id"]: r["up"] for r in spelling.roots_of(spark.createDataFrame(steps, "id long, up long")).collect()}
    assert found == {i: 60 for i, _ in steps}


def test_keys_compare_places(spark):
    """Words that share a deletion at different places aren't near; a long word has a key a run."""
    own, hashes, first, last = spelling.keys_of(["abcd", "bacd", "aab", "aa"])
    deletions = {w: {int(h) for o, h in zip(own[: -4], hashes[:-4]) if o == k} for k, w in enumerate(["abcd", "bacd", "aab", "aa"])}
    assert deletions["abcd"] & deletions["bacd"] and int(hashes[-1]) in deletions["aab"]
    words = spark.createDataFrame([(0, "abcd"), (1, "bacd"), (2, "aab"), (3, "aa"), (4, "abb"), (5, "xaa")], "id long, word string")
    assert sorted(map(tuple, spelling.near_pairs(words).collect())) == [(2, 3), (2, 4), (3, 5)]
    assert len(spelling.keys_of(["a" * 100_000])[0]) == 2


def test_no_vocabulary_goes_through_the_driver(spark):
    """Tables that are read back are joined by merges, however small their files are."""
    words = spelling.kept(spark.createDataFrame([(0, "aab"), (1, "aa")], "id long, word string"), "words")
    assert list(map(tuple, spelling.near_pairs(words).collect())) == [(0, 1)]
    assert "Broadcast" not in spelling.near_pairs(words)._jdf.queryExecution().sparkPlan().toString()
    plan = spelling.variants(spark.createDataFrame([(0, "abcde abcde abcde")], "doc_id long, text string"))._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
