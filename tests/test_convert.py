"""Documents as files through a reader, the whole conversion, and HTML files. The reader's package is a stand-in that reads JSON."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pagewright.operators import convert as D
from pagewright.operators import segments as S
from pagewright.operators import tree as N
from pagewright.sources import files, pdf
from pagewright.sources.stages import Stages, batches

READER = '''
import io, json
class _Row(dict):
    __getattr__ = dict.__getitem__
class _Table:
    def __init__(self, t):
        self.bbox, self._cells, self.rows = t["bbox"], t["cells"], [_Row(bbox=(t["bbox"][0], y, t["bbox"][2], y + 10)) for y in t.get("tops", [])]
    def extract(self):
        return self._cells
class _Page:
    def __init__(self, p):
        self.p, self.rects, self.chars, self.annots = p, p.get("rects", []), p.get("chars", []), p.get("annots", [])
    def extract_words(self, **named):
        return self.p["words"]
    def find_tables(self):
        if self.p.get("tables") == "never":
            raise RuntimeError("tables were opened")
        return [_Table(t) for t in self.p.get("tables", [])]
class _Document:
    def __init__(self, pages):
        self.pages = [_Page(p) for p in pages]
    def __enter__(self):
        return self
    def __exit__(self, *e):
        pass
def open(stream):
    return _Document(json.loads(stream.read()))
'''


def word(text, x0, top, size=10.0, font="Arial"):
    return {"text": text, "x0": float(x0), "x1": x0 + 6.0 * len(text), "top": float(top), "bottom": top + size, "fontname": font, "size": size}


def line(text, top, size=10.0, font="Arial", x0=54):
    out = []
    for w in text.split():
        out.append(word(w, x0, top, size, font))
        x0 += 6 * len(w) + 4
    return out


BOLD = "Arial-Bold"
PAGES = [
    {
        "words": [
            *line("Drug Coverage Policy", 40, 12, BOLD), *line("Effective Date ... 1/15/2024", 60), *line("Coverage Policy Number .... IP0001", 76), *line("Sample Therapy", 92, 20, BOLD),
            *line("Table of Contents", 104, 12, BOLD), *line("Overview .... 2", 112), *line("References ... 7", 118), *line("Other policy", 115, x0=300),
            *line("INSTRUCTIONS FOR USE", 124, 12, BOLD), *line("Terms of benefit plans control & apply.", 140),
            *line("Overview", 168, 14, BOLD), *line("A drug of the class is described here.", 188), *line("It goes on", 200), *line("Availability", 228, 10.5, BOLD), *line("Available forms are listed.", 248),
            *line("Table 1. Products", 276, 10, BOLD), *line("Brand Dose", 292, 10, BOLD), *line("Alpha 5", 308), *line("Beta 7", 324), *line("* a note below", 350, 8),
            *line("References", 600, 14, BOLD), *line("1. A citation.", 620),
        ],
        "tables": [{"bbox": [50, 288, 500, 340], "cells": [["Brand", "Dose"], ["Alpha", "5"], ["Beta", "7"]], "tops": [288, 304, 320]}],
        "rects": [{"x0": 50, "x1": 500, "top": 288, "bottom": 304, "fill": True, "non_stroking_color": 0.8}],
        "chars": [{"text": "A", "x0": 54.0, "x1": 60.0, "top": 308.0, "bottom": 318.0}],
        "annots": [{"uri": "http://a", "x0": 300.0, "top": 113.0, "bottom": 118.0}, {"uri": None}],
    },
    {
        "words": [*line("Coding Information", 60, 14, BOLD), *line("FDA Approved Dosing", 100, 10, BOLD), *line("Alpha 5 mg", 124), *line("2. Another line.", 200), *line("All products are those of companies.", 660)],
        "tables": [{"bbox": [54, 112, 527, 142], "cells": [[None, "Indication", "Doses"], ["Alpha", "5 mg", None], [None, "6 mg", None]], "tops": [112, 122, 132]}],
        "rects": [{"x0": 54, "x1": 527, "top": 112, "bottom": 122, "fill": True, "non_stroking_color": 0.8}, {"x0": 140, "x1": 145, "top": 130, "bottom": 130.5}, {"x0": 50, "x1": 520, "top": 640, "bottom": 642, "fill": True, "non_stroking_color": [0, 0.4, 0.7]}],
        "chars": [{"text": c, "x0": x + 5.0 * i, "x1": x + 5.0 * i + 5, "top": y, "bottom": y + 8} for text, x, y in (("Alpha", 58, 122.0), ("5 mg", 140, 122.0), ("•6&7", 140, 132.0)) for i, c in enumerate(text)],
    },
]


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("reader")
    (folder / "pdfplumber.py").write_text(READER)
    spark.sparkContext.addPyFile(str(folder / "pdfplumber.py"))
    (folder / "ip_0001.pdf").write_text(json.dumps(PAGES))
    (folder / "ip_0002.pdf").write_text("not a document")
    return pdf.read_pages(spark, f"file://{folder}")


def test_pages_of_files(read):
    rows = {r["path"].rsplit("/", 1)[1]: r for r in read.where("page < 2").collect()}
    assert rows["ip_0002.pdf"]["error"] and rows["ip_0002.pdf"]["page"] == 0
    page = rows["ip_0001.pdf"]
    assert page["error"] is None and len(page["words"]) == len(PAGES[0]["words"]) == len(page["tiny_words"])
    assert page["rects"][0]["color"] == [0.8] and page["rects"][0]["color_kind"] == "scalar"
    assert [a["uri"] for a in page["annots"]] == ["http://a"] and page["chars"][0]["text"] == "A"
    assert page["tables"][0]["cells"][1] == ["Alpha", "5"] and page["tables"][0]["row_tops"] == [288.0, 304.0, 320.0]


def test_only_what_is_asked_for_is_read_by_shares_of_pages(spark, read, tmp_path):
    pages = [{"words": line(f"page {i}", 40), "tables": "never"} for i in range(23)]
    (tmp_path / "a.pdf").write_text(json.dumps(pages))
    (tmp_path / "b.pdf").write_text(json.dumps(pages[:1]))
    (tmp_path / "other.txt").write_text("[]")
    found = pdf.read_pages(spark, f"file://{tmp_path}", columns=["words"], bytes_per_task=(tmp_path / "a.pdf").stat().st_size // 5 + 1)
    assert found.columns == ["path", "page", "error", "words"] and found.rdd.getNumPartitions() == 6
    rows = found.collect()
    assert all(r["error"] is None for r in rows)
    assert sorted((r["path"].rsplit("/", 1)[1], r["page"], r["words"][1]["text"]) for r in rows) == sorted([("a.pdf", i + 1, str(i)) for i in range(23)] + [("b.pdf", 1, "0")])
    assert {r["error"] for r in pdf.read_pages(spark, f"file://{tmp_path}", columns=["tables"]).collect()} == {"tables were opened"}
    assert pdf.read_pages(spark, f"file://{tmp_path}", pattern="*.none").count() == 0


def test_a_task_that_fails_leaves_no_files(spark, tmp_path):
    good = spark.range(20).selectExpr("concat('f', id) as stem", "repeat('x', 10) as html").repartition(4)
    assert files.write_html(good, f"file://{tmp_path}/out") == 20
    bad = spark.range(20).selectExpr("concat('g', id) as stem", "if(id = 13, raise_error('no'), 'y') as html").repartition(4)
    with pytest.raises(Exception):  # noqa: B017
        files.write_html(bad, f"file://{tmp_path}/out")
    assert sorted(os.listdir(tmp_path / "out")) == sorted(f"f{i}.htm" for i in range(20))
    assert files.write_html(good.withColumn("html", F.lit("new")), f"file://{tmp_path}/out") == 20
    assert {p.read_text() for p in (tmp_path / "out").iterdir()} == {"new"}


@pytest.fixture(scope="module")
def nodes(spark, read):
    return D.document_nodes(pdf.pages(read))


def test_a_document_from_file_to_html(spark, nodes, tmp_path):
    html = D.written(nodes)
    out = html.first()["html"]
    want = [
        "<title>IP0001 Sample Therapy</title>", "<strong>Effective Date:</strong> 1/15/2024", "<strong>Table of Contents</strong>", "<li>Overview <span style=\"float:right\">2</span></li>", '<a href="http://a">Other policy</a>',
        "<strong>Instructions for Use</strong>", "Terms of benefit plans control &amp; apply.", "<strong>Overview</strong>", "  <p>A drug of the class is described here. It goes on</p>", "  <p><em>Availability</em></p>", "Available forms are listed.",
        "     <th>Brand</th>", '     <td style="vertical-align:top">Beta</td>', "  <p><small><em>* a note below</em></small></p>", "<strong>References</strong>", "1. A citation.", "<strong>Coding Information</strong>",
        '     <td style="vertical-align:top"><u>5</u> mg<br>•6&amp;7</td>', "2. Another line.", "  <hr>", "  <p><small><em>All products are those of companies.</em></small></p>", " </body>\n</html>",
    ]
    places = [out.find(w) for w in want]
    assert -1 not in places, [w for w, p in zip(want, places) if p < 0]
    order = [p for w, p in zip(want, places) if "Beta" not in w and "Brand" not in w and "note" not in w and "mg" not in w and "Another" not in w and "<hr>" not in w]
    assert order == sorted(order) and out.count("<table border") == 6  # four sections and two tables
    assert "Alpha 5" not in out  # lines within the tables aren't text
    assert files.write_html(html.selectExpr("concat('ip_', doc_id) as stem", "html"), f"file://{tmp_path}/out") == 1
    assert [p.read_text() for p in (tmp_path / "out").glob("*.htm")] == [out]
    assert files.write_html(html.selectExpr("'x' as stem", "html"), f"file://{tmp_path}/dry", dry_run=True) == 1 and not (tmp_path / "dry").exists()


def test_nested_documents_give_their_nodes_back(spark, nodes):
    columns = ["doc_id", "section_id", "ord", "parent", "kind", "heading", "text", "table_type", "page", "top", "attributes"]
    trees = N.nested(nodes)
    document = json.loads(trees.selectExpr("to_json(document)").first()[0])
    front = document["children"][0]["nodes"]
    assert [x["kind"] for x in front] == ["header", "toc", "related_links"] and front[0]["attributes"]["policy_number"] == "IP0001"
    assert [x["text"] for x in front[1]["children"]] == ["Overview", "References"] and front[2]["children"][0]["attributes"] == {"url": "http://a"}
    sections = [x["nodes"][0] for x in document["children"][1:]]
    assert [x["kind"] for x in sections] == ["ifu", "section", "section", "section", "footer"]
    assert [x["kind"] for x in sections[1]["children"]] == ["paragraph", "subsection"]
    assert {x["kind"] for x in sections[1]["children"][1]["children"]} == {"paragraph", "table", "footnote"}
    key = lambda df: sorted(map(repr, (r.asDict() for r in df.select(columns).collect())))
    assert key(N.flattened(trees)) == key(nodes)


def test_stages_leave_the_session_alone_and_go(spark, tmp_path):
    before = dict(spark.conf.getAll)
    stages = Stages(spark, "job")
    first = stages(spark.range(3).selectExpr("id", "array(id) as a"), "one")
    second = stages(first.where("id > 0"), "two")
    stages.close(but=("two",))
    assert second.count() == 2 and dict(spark.conf.getAll) == before
    root = stages.root.removeprefix("file:").replace("//", "/", 1)
    assert os.listdir(root) == ["two"]


def test_marks_on_lines_equal_the_asof_join(spark, tiny):
    from pagewright.operators import lines as L
    from pagewright.sources import layout

    lines = L.raw_lines(layout.words(spark.read.parquet(f"{tiny}/documents.parquet").where("doc_id < 40")))
    feet = lines.where("doc_id % 2 = 0").groupBy("doc_id").agg({"page": "max"}).selectExpr("doc_id", "`max(page)` as page", "300.0d as top")
    key = lambda df: sorted(map(tuple, df.select("doc_id", "page", "top", "segment").collect()))
    assert key(S.segmented(lines)) == key(S.assign_segments(lines, S.boundaries(lines)))
    assert key(S.segmented(lines, footers=feet)) == key(S.assign_segments(lines, S.boundaries(lines, feet)))
    assert set(S.with_family(lines).select("family").distinct().toPandas()["family"]) <= {"mm", "drug"}


def test_tables_of_stages_are_not_broadcast(spark):
    """Small files may be large tables: joins of what a stage gives are merges, not broadcasts through the driver."""
    stages = Stages(spark, "job")
    left, right = (stages(spark.range(5).selectExpr("id", f"id as {n}"), n) for n in ("a", "b"))
    plan = left.join(right.groupBy("id").agg({"b": "max"}), "id", "left")
    assert "Broadcast" not in plan._jdf.queryExecution().sparkPlan().toString() and plan.count() == 5
    stages.close()


def test_shuffle_files_of_a_stage_go_once_its_table_is_written(spark):
    """A job of many stages takes the disk of its largest, not of all."""
    import time

    jvm, held = spark._jvm, spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    jvm.System.gc()
    time.sleep(2)
    before = held.size()
    stages = Stages(spark, "job")
    for name in ("a", "b", "c"):
        assert stages(spark.range(1000).groupBy(F.expr("id % 7")).count(), name).count() == 7
    jvm.Thread.sleep(2000)
    # what counted the rows of the last table may still be there
    assert held.size() <= before + 1
    stages.close()


def test_batches_hold_every_row_once(spark):
    docs = spark.range(-50, 50).selectExpr("id as doc_id", "repeat('é', 5) as text")
    parts = lambda least, most, of=docs: batches(of, "doc_id", F.octet_length("text"), least, most)
    for least, most, n in ((1000, 16, 1), (999, 16, 2), (100, 16, 10), (1, 16, 16)):
        held = [[r["doc_id"] for r in part.collect()] for part in parts(least, most)]
        assert len(held) == n and sorted(x for h in held for x in h) == list(range(-50, 50))
    assert [part.count() for part in parts(1, 16, docs.where("false"))] == [0]


def test_documents_are_converted_batch_by_batch(spark, tiny, monkeypatch):
    """Tables of a batch go before the next one's, so that the disk is that of a batch; the documents are those of the SQL."""
    import duckdb

    from pagewright.plans import conversion

    first, left = Stages.__call__, []

    def watched(self, df, name, *more, **named):
        if name == "pages":
            held = os.path.dirname(self.root.removeprefix("file:").replace("//", "/", 1))
            left.append([t for job in os.listdir(held) if job.startswith("converted-") for t in os.listdir(f"{held}/{job}") if t != "counts"])
        return first(self, df, name, *more, **named)

    monkeypatch.setattr(Stages, "__call__", watched)
    monkeypatch.setattr(conversion, "BATCH", 1)
    monkeypatch.setattr(conversion, "BATCHES", 2)
    out = conversion.converted_documents(spark, tiny)
    with duckdb.connect() as c:
        c.execute(f"create view documents as select * from '{tiny}/documents.parquet'")
        want = c.execute(conversion.ORACLES["converted_documents"])
        columns = [x[0] for x in want.description]
        assert sorted(map(tuple, out.select(columns).collect())) == sorted(want.fetchall())
    assert left == [[], []]
