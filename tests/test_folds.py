"""The folds over lines, words and nodes against line by line versions, on random input."""

import random

import pandas as pd
import pytest

from pagewright.operators import blocks as K
from pagewright.operators import lines as L
from pagewright.operators import tree as N

from . import brute

LINES = "doc_id long, block_id long, page int, top double, x0 double, text string, fontname string, size double, bold boolean, marker_type string, in_table boolean"
TEXTS = ["", " ", "word", "two  words", "1. one", "A) two", "iv. three", "Note: four", "Note : x", "2) five", "®", "™ ", "• own", "•", "•®", "o", "\uf0b7", "goes on.", "i. x"]


def random_lines(rnd, block):
    top, page = 100.0, 1
    for _ in range(rnd.randint(0, 14)):
        top += rnd.choice([3.0, 6.0, 8.0, 12.0, 20.0])
        if rnd.random() < 0.1:
            page, top = page + 1, 80.0
        marker = rnd.choice([None] * 5 + ["", "bullet", "sub_bullet", "sub_sub_bullet"])
        yield {"doc_id": block % 3, "block_id": block, "page": page, "top": top, "x0": rnd.choice([50.0, 60.0, 70.0, 75.0, 90.0, 98.0, 120.0]), "text": rnd.choice(TEXTS), "fontname": rnd.choice(["A"] * 8 + ["SymbolMT", "CourierNew", "Wingdings"]), "size": rnd.choice([10.0, 10.0, 10.0, 12.0]), "bold": rnd.random() < 0.1, "marker_type": marker, "in_table": rnd.random() < 0.1}


@pytest.mark.parametrize("compat", [False, True])
def test_list_items(spark, compat):
    rnd = random.Random(7)
    blocks = {b: list(random_lines(rnd, b)) for b in range(600)}
    names = [c.split()[0] for c in LINES.split(", ")]
    df = spark.createDataFrame([tuple(x[c] for c in names) for xs in blocks.values() for x in xs], LINES).repartition(6)
    want = {b: [(i, *x) for i, x in enumerate(brute.hierarchy(brute.resolve_markers(xs), compat))] for b, xs in blocks.items()}
    got = {b: [] for b in blocks}
    for r in K.list_items(df, compat).collect():
        got[r["block_id"]].append((r["item"], r["parent"], r["kind"], r["text"]))
    for b, xs in blocks.items():
        assert sorted(got[b]) == want[b], xs


def test_greedy_buckets(spark):
    rnd = random.Random(8)
    rows = []
    for page in range(300):
        for i in range(rnd.randint(0, 25)):
            text = rnd.choice(["O", "A", " B ", "ab", "x", "É", "1", "O"])
            rows.append((page % 7, page, i, text, float(rnd.randint(0, 40)), rnd.choice([5.0, 6.0, 9.0]), rnd.choice(["A", "A", "SymbolMT"])))
    schema = "doc_id long, page int, word_idx long, text string, top double, size double, fontname string"
    names = [c.split()[0] for c in schema.split(", ")]
    got = sorted((r["page"], r["word_idx"], r["line_key"]) for r in L.greedy_buckets(spark.createDataFrame(rows, schema).repartition(6)).collect())
    frame = pd.DataFrame(rows, columns=names)
    want = sorted((page, r.word_idx, r.line_key) for page, pdf in frame.groupby("page") for r in brute.greedy_page(pdf).itertuples())
    assert got == want


NODES = "doc_id long, section_id long, segment string, parent string, ord int, kind string, heading string, text string, table_type string, page int, top double, sub long"
TABLES = "doc_id long, section_id long, position int, table_type string, title string, page int, top double"


def test_inject_tables(spark):
    rnd = random.Random(9)
    nodes, tables, want = [], [], {}
    texts = [None, "text", "* note", "Table 1. Forms and more", "Employer Plans", "For Individual and Family plans, a longer text than that", "© 2020", "the publisher companies", ""]
    for section in range(400):
        rows, sub, at = [], 0, 0.0
        for i in range(rnd.randint(1, 12)):
            at += rnd.choice([5.0, 20.0])
            kind = rnd.choice(["paragraph", "paragraph", "footnote", "subsection", "subsubsection"])
            sub += kind == "subsection"
            parent = "section" if kind == "subsection" or not sub else f"sub{sub}"
            heading = rnd.choice(["Availability", "Drug Quantity Limits", "Employer Plans", "Other", None]) if kind == "subsection" else None
            segment = ["Revision Details", "Coding Information", "Coverage Policy", "Overview", None][section % 5]
            rows.append((section % 9, section, segment, parent, i + 1, kind, heading, rnd.choice(texts), None, 1 + i // 6, at, sub))
        own = [(section % 9, section, p, rnd.choice([*N.TABLE_ORDER, "other"]), rnd.choice([None, "", " Table 1. Forms", "Table 1. Forms and more and a title beyond thirty"]), rnd.randint(1, 2), rnd.uniform(0, 200)) for p in range(rnd.choice([0, 1, 2, 5]))]
        nodes += rows
        tables += own
        names = [c.split()[0] for c in NODES.split(", ")]
        found = brute.inject([dict(zip(names, r)) for r in rows], [dict(zip([c.split()[0] for c in TABLES.split(", ")], t)) for t in own])
        want[section] = [(x["parent"], x["kind"], x["heading"], x["text"], x["table_type"], x["page"], x["top"]) for x in found]
    got = {section: [] for section in want}
    for r in N.inject_tables(spark.createDataFrame(nodes, NODES).repartition(5), spark.createDataFrame(tables, TABLES).repartition(5)).orderBy("section_id", "ord").collect():
        assert r["ord"] == len(got[r["section_id"]]) + 1
        got[r["section_id"]].append((r["parent"], r["kind"], r["heading"], r["text"], r["table_type"], r["page"], r["top"]))
    assert got == want


def test_nodes_of_a_section_are_numbered_once(spark):
    """They aren't numbered anew for every subsection whose nodes are looked up."""
    nodes = spark.createDataFrame([(1, 1, "x", "section", 1, "paragraph", None, "a", None, 1, 1.0, None)], "doc_id long, section_id long, segment string, parent string, ord int, kind string, heading string, text string, table_type string, page int, top double, sub long")
    tables = spark.createDataFrame([(1, 1, 1, "generic", "t", 1, 1.0)], "doc_id long, section_id long, position int, table_type string, title string, page int, top double")
    plan = N.inject_tables(nodes, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(transform(_nodes" not in plan and "transform(array(transform(_nodes" in plan
