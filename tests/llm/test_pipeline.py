"""Each stage of the pipeline against a brute-force version over what the stage before kept."""

import hashlib
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pagewright.llm import _tokens, registry, toxicity
from pagewright.llm._common import written

from .test_operators import WORD, fingerprint, lower, reachable
from .test_text_dedup import brute


@pytest.fixture(scope="module")
def stages(spark, tiny):
    """The documents, then what each stage gives."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], tiny), f"test-{name}"))
    return out


def texts(df):
    return dict(sorted((r["doc_id"], r["text"].encode()) for r in df.collect()))


def test_columns(stages):
    assert [s.columns for s in stages[:-1]] == [stages[0].columns] * 5


def test_toxic_documents_go(spark, tiny, stages):
    found = toxicity.flag(stages[0], spark.read.parquet(f"{tiny}/labels.parquet"), ["doc_id"]).where("_pw.predicted = 0")
    assert set(texts(stages[1])) == {r["doc_id"] for r in found.collect()}


def test_one_document_of_a_group_stays(stages):
    before = texts(stages[1])
    ids = list(before)
    prints = [fingerprint(before[i]) for i in ids]
    roots = reachable(len(ids), lambda u: [w for w in range(len(ids)) if (prints[u] ^ prints[w]).bit_count() <= 2])
    assert set(texts(stages[2])) == {ids[r] for r in roots}


def test_later_copies_go(stages):
    before = texts(stages[2])
    after = texts(stages[3])
    assert set(before) == set(after)
    for (i, text), mask in zip(before.items(), brute(list(before.values()), 100, True)):
        assert after[i] == bytes(b for b, m in zip(text, mask) if not m).decode("utf-8", "ignore").encode()


def test_contaminated_documents_go(spark, tiny, stages):
    windows = set()
    for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect():
        words = WORD.findall(lower(r["text"].encode()))
        windows |= {tuple(words[at : at + 13]) for at in range(max(1, len(words) - 12) if words else 0)}
    kept = set()
    for i, text in texts(stages[3]).items():
        words = WORD.findall(lower(text))
        hit = bytearray(len(words))
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in windows:
                    hit[at : at + n] = b"\1" * n
        if not (sum(hit) and 20 * sum(hit) >= len(words)):
            kept.add(i)
    assert set(texts(stages[4])) == kept


def test_every_token_is_packed(stages):
    encode = _tokens.encoder(_tokens.vocabulary("byte_bpe_50k.json"), "byte").tokenizer.encode
    lengths = defaultdict(int)
    room = defaultdict(int)
    for r in stages[5].collect():
        lengths[r["doc_id"]] += r["length"]
        room[r["sequence_id"]] += r["length"]
    assert lengths == {i: len(encode(t.decode(), add_special_tokens=False).ids) + 1 for i, t in texts(stages[4]).items()}
    assert max(room.values()) <= 1024


def test_run_gives_the_last_stage(spark, tiny, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, tiny).collect())) == sorted(map(tuple, stages[5].collect()))


def test_stages_with_odd_inputs(spark, tiny, docs, nothing, tmp_path):
    """Nulls, empty and long texts, repeated rows, ids shared by texts, clashing columns; and no rows at all."""
    folder = f"file://{tmp_path}/in"
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (None, "some words of an item"), (3, docs.where("doc_id = 2000").first()["text"][:400])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for start in (docs, nothing):
        held = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = written(stage(spark, held, folder), f"odd-{name}")
            assert after.columns == start.columns and after.count() <= held.count()
            held = after
        assert (held.count() == 0) == (start is nothing)
        packed = corpus_pipeline.STAGES[-1][1](spark, held, folder).collect()
        assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in held.collect()}
        assert all(len(r["ids"]) == 4 * r["length"] for r in packed)


def test_registered():
    names = list(entry.queries())
    assert "pipeline" in names and sorted((n.split("_")[0] for n in names if n.startswith("op")), key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, tiny, name):
    c = duckdb.connect(config={"temp_directory": ""})
    for t in ("documents", "benchmark", "embeddings", "labels", "pages"):
        c.execute(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    result = c.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    df = registry.queries()[name](spark, tiny)
    assert sorted(df.columns) == sorted(columns)
    digest = lambda rows: hashlib.sha256(repr(sorted(rows, key=repr)).encode()).hexdigest()
    assert digest(tuple(r[c] for c in sorted(columns)) for r in df.collect()) == digest(tuple(r[columns.index(c)] for c in sorted(columns)) for r in result.fetchall())
