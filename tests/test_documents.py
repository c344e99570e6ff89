"""Lists, trees, pages, corpus statistics and sources."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagewright.operators import blocks as K
from pagewright.operators import corpus as C
from pagewright.operators import render as R
from pagewright.operators import tree as N
from pagewright.sources import files, layout
from pagewright.streaming import lines as streaming


LINES = "doc_id long, block_id long, page int, top double, x0 double, text string, fontname string, size double, bold boolean, marker_type string, in_table boolean"


def items_of(lines, compat=False):
    """Items of one block of lines (dictionaries)."""
    names = [c.split()[0] for c in LINES.split(", ")]
    df = SparkSession.getActiveSession().createDataFrame([tuple({"doc_id": 1, "block_id": 1, **x}[c] for c in names) for x in lines], LINES)
    return [(r["parent"], r["kind"], r["text"]) for r in K.list_items(df, compat).orderBy("item").collect()]


def block(*rows, compat=False):
    """(text, x0, marker_type, more) twenty points apart on page 1, or at the place given."""
    lines = [{"page": 1, "top": 100.0 + 20 * i, "text": text, "x0": float(x0), "marker_type": marker, "fontname": "A", "size": 10.0, "bold": False, "in_table": False, **(more[0] if more else {})} for i, (text, x0, marker, *more) in enumerate(rows)]
    return items_of(lines, compat)


def test_numbers_letters_romans_and_notes(spark):
    out = block(("1. one", 60, None), ("A) two", 70, None), ("i. three", 90, None), ("Note: four", 60, None), ("2. five", 60, None), ("goes on", 60, None))
    assert out == [(-1, "num", "1. one"), (0, "letter", "A) two"), (1, "roman", "i. three"), (2, "note", "Note: four"), (-1, "num", "2. five goes on")]


def test_bullets_and_orphans(spark):
    out = block(("a", 60, "bullet"), ("b", 70, "sub_bullet"), ("c", 80, "sub_sub_bullet"), ("d", 80, None), ("left", 50, None))
    assert out == [(-1, "bullet", "a"), (0, "sub_bullet", "b d left"), (1, "sub_sub", "c")]
    assert block(("b", 70, "sub_bullet"), ("a", 60, "bullet"), ("c", 70, "sub_sub_bullet")) == [(-1, "plain", "b"), (-1, "bullet", "a"), (1, "sub_bullet", "c")]
    assert block(("a", 60, "bullet"), ("left", 50, None)) == [(-1, "bullet", "a"), (-1, "plain", "left")]


def test_a_bullet_goes_on_over_the_page_only_further_right(spark):
    over = lambda x0: block(("a", 60, "bullet"), ("next", x0, None, {"page": 2}))
    assert over(60) == [(-1, "bullet", "a"), (-1, "plain", "next")]
    assert over(70) == [(-1, "bullet", "a next")]


def test_markers_claim_the_text_beside_them(spark):
    out = block(("", 60, "bullet"), ("text", 70, None, {"top": 104.0}), ("•", 60, None, {"top": 140.0}), ("own", 70, None, {"top": 150.0}), ("®", 60, "bullet", {"top": 200.0}), ("mark", 70, None, {"top": 212.0}))
    assert out == [(-1, "bullet", "text"), (-1, "bullet", "own"), (-1, "bullet", "®mark")]


def test_notes_take_in_the_lines_after_them(spark):
    out = block(("Note: a", 60, None), ("1) b", 90, None), ("c", 90, None), ("Bold", 90, None, {"bold": True}))
    assert out == [(-1, "text", "Note: a<br>1) b c Bold")]
    assert block(("Note: a", 60, None), ("Bold", 90, None, {"bold": True}), ("1. n", 60, None), compat=True) == [(-1, "plain", "Note: a"), (-1, "num", "1. n")]


def test_plain_blocks_are_one_text(spark):
    assert block(("a", 60, None), ("b", 60, None)) == [(-1, "text", "a b")]
    assert block(("", 60, None)) == []


def test_list_items_of_blocks(spark):
    rows = [(1, b, 1, 100.0 + i, 60.0, t, "A", 10.0, False, m, False) for b, i, t, m in ((0, 0, "x", "bullet"), (0, 20, "y", None), (1, 0, "z", None))]
    df = spark.createDataFrame(rows, "doc_id long, block_id long, page int, top double, x0 double, text string, fontname string, size double, bold boolean, marker_type string, in_table boolean")
    assert sorted((r["block_id"], r["kind"], r["text"]) for r in K.list_items(df).collect()) == [(0, "bullet", "x y"), (1, "text", "z")]


def test_footnotes(spark):
    rows = [(1, 1, "S", 1, top, text, False, 8.0, False) for top, text in ((100.0, "* a"), (132.0, "* b"), (165.0, "* c"), (500.0, "plain"), (680.0, "low"))]
    lines = spark.createDataFrame(rows, "doc_id long, section_id long, segment string, page int, top double, text string, bold boolean, size double, in_table boolean")
    boxes = spark.createDataFrame([(1, 1, 300.0, 471.0)], "doc_id long, page int, box_top double, box_bottom double")
    flagged = N.footnote_flag(lines, boxes)
    assert [r["footnote"] for r in flagged.orderBy("top").collect()] == [True, True, True, True, True]
    assert [r["text"] for r in N.merge_footnotes(flagged).orderBy("note").collect()] == ["* a * b", "* c", "plain", "low"]


def test_paragraphs_break_at_gaps_not_at_pages(spark):
    rows = [(1, 1, p, float(t), x, b, False) for p, t, x, b in ((1, 100, "a", False), (1, 120, "b", False), (1, 141, "c", False), (2, 40, "d", False), (2, 55, "Table 1. x", True), (2, 70, "e", False))]
    df = spark.createDataFrame(rows, "doc_id long, section_id long, page int, top double, text string, bold boolean, breaks boolean")
    assert [r["block"] for r in N.paragraph_islands(df).orderBy("page", "top").collect()] == [1, 1, 2, 2, 3, 3]


def _nodes(spark, segment, *rows):
    """(parent, kind, text, top, sub)."""
    return spark.createDataFrame([(1, 1, segment, p, i + 1, k, t if k == "subsection" else None, t, None, 1, float(top), s) for i, (p, k, t, top, s) in enumerate(rows)], "doc_id long, section_id long, segment string, parent string, ord int, kind string, heading string, text string, table_type string, page int, top double, sub long")


def _put(spark, nodes, *tables):
    df = spark.createDataFrame([(1, 1, i, k, title, 1, float(top)) for i, (k, title, top) in enumerate(tables)], "doc_id long, section_id long, position int, table_type string, title string, page int, top double")
    return [(r["parent"], r["kind"], r["table_type"] or r["text"]) for r in N.inject_tables(nodes, df).orderBy("ord").collect()]


@pytest.mark.parametrize(
    ("segment", "kind", "want"),
    [
        ("Revision Details", "revision", 0), ("Overview", "revision", 3), ("Coding Information", "hcpcs", 2), ("Overview", "hcpcs", 3),
        ("Appendix", "moa", 2), ("Overview", "criteria", 3), ("Overview", "generic", 3), ("Overview", "dql", 3),
    ],
)
def test_tables_in_a_section_without_subsections(spark, segment, kind, want):
    nodes = _nodes(spark, segment, ("section", "paragraph", "one", 10, 0), ("section", "paragraph", "two", 20, 0), ("section", "footnote", "* three", 30, 0), ("section", "footnote", "Publisher Companies", 40, 0))
    assert [x[2] for x in _put(spark, nodes, (kind, "T", 50))].index(kind) == want


def test_tables_in_subsections(spark):
    nodes = _nodes(spark, "Coverage Policy", ("section", "subsection", "Drug Quantity Limits", 10, 1), ("sub1", "paragraph", "text", 20, 1), ("section", "subsection", "Availability", 30, 2), ("sub2", "paragraph", "Table 1. Forms and more", 40, 2), ("sub2", "paragraph", "end", 50, 2))
    out = _put(spark, nodes, ("dql", "", 15), ("dql", "", 16), ("availability", "Table 1. Forms", 45), ("generic", "Table 1. Forms", 46), ("generic", "Table 1. Forms", 47))
    assert [x[2] for x in out] == ["Drug Quantity Limits", "dql", "dql", "text", "Availability", "Table 1. Forms and more", "availability", "generic", "generic", "end"]


def test_table_order(spark):
    df = spark.createDataFrame([(1, 2, "revision", 0), (1, 1, "generic", 1), (1, 1, "dql", 2), (1, 1, "unknown", 3), (1, 1, "generic", 0)], "doc_id long, page int, table_type string, seq int")
    assert [(r["table_type"], r["seq"]) for r in N.ordered_tables(df).orderBy("position").collect()] == [("dql", 2), ("generic", 0), ("generic", 1), ("revision", 0)]


def test_notes_keep_their_breaks(spark):
    html = spark.createDataFrame([("note", "Note: a <b<br>1) c")], "k string, t string").select(R.item_html(F.col("k"), F.col("t"))).first()[0]
    assert html == '  <p style="margin-left:20px"><em><strong>Note:</strong> a &lt;b<br>1) c</em></p>'


def test_sentences_go_on(spark):
    items = spark.createDataFrame([(1, 1, i, k, t) for i, (k, t) in enumerate((("plain", "a stop"), ("plain", "goes on."), ("plain", "New"), ("bullet", "x"), ("plain", "A) y"), ("plain", "z")))], "doc_id long, block_id long, item int, kind string, text string")
    assert [r["html"] for r in R.merge_sentences(items).orderBy("item").collect()] == ["  <p>a stop goes on.</p>", "  <p>New</p>", '  <p style="margin-left:20px">• x</p>', '  <p style="margin-left:40px">A) y</p>', "  <p>z</p>"]


def test_pages_get_a_rule_before_the_first_footer(spark):
    parts = spark.createDataFrame([(1, 1, "a"), (1, 2, "  <p><small><em>© 2024</em></small></p>"), (1, 3, "b"), (2, 1, "c")], "doc_id long, path int, html string")
    assert [r["html"].split("\n")[:2] for r in R.documents_html(parts).orderBy("doc_id").collect()] == [["a", "  <hr>"], ["c", "  <hr>"]]


def test_patterns(spark):
    docs = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "doc_id long, prefix string")
    heads = spark.createDataFrame([(1, 1, i, s) for i, s in enumerate("AABA")] + [(2, 1, i, s) for i, s in enumerate("ABA")], "doc_id long, page int, line_top int, section string")
    patterns = C.section_patterns(docs, heads)
    assert [r["pattern"] for r in patterns.orderBy("doc_id").collect()] == ["A → B → A", "A → B → A", "(none)"]
    assert [tuple(r) for r in C.top_patterns(patterns, 1).collect()] == [("A → B → A", 2, 1)]
    assert sorted(tuple(r) for r in C.pattern_prefixes(patterns).collect()) == [("(none)", "q", 1), ("A → B → A", "p", 2)]


def test_batches(spark):
    manifest = spark.createDataFrame([(1, "zz", 3), (2, "ph", 11), (3, "ip", 10), (4, "aa", 1), (5, "ph", 12)], "doc_id long, prefix string, n_pages int")
    batch = C.split_batch(manifest, 10)
    assert [r["prefix"] for r in C.ordered_prefixes(batch).orderBy("position").collect()] == ["ip", "aa", "zz"]
    assert [r["doc_id"] for r in C.largest_skipped(batch).collect()] == [5, 2]
    assert C.split_batch(manifest, 10, "ip").where("status = 'skipped'").count() == 2 and C.split_batch(manifest, 10, "ip").where("status = 'selected'").count() == 1
    results = spark.createDataFrame([("a", True, 1.0), ("a", False, 2.0), ("b", True, 4.0)], "prefix string, ok boolean, elapsed double")
    assert sorted((r["prefix"] or "", r["total"], r["ok"], r["err"], r["elapsed"]) for r in C.batch_summary(results).collect()) == [("", 3, 2, 1, None), ("a", 2, 1, 1, 3.0), ("b", 1, 1, 0, 4.0)]


def test_one_failure_leaves_the_others(spark):
    df = spark.createDataFrame([(1, 2), (2, 0)], "doc_id long, n int")
    out = C.isolate(df, lambda row: {"share": 1 / row["n"]}, "share double", ["doc_id"]).orderBy("doc_id").collect()
    assert [(r["ok"], r["share"]) for r in out] == [(True, 0.5), (False, None)] and "zero" in out[1]["error"]


def test_flags_keep_documents_without_tables(spark):
    cells = [["Type of Revision", "x"], ["a", "b"]]
    t = spark.createDataFrame([(1, 1, 0, cells, "")], "doc_id long, page int, table_idx int, cells array<array<string>>, title string")
    flags = C.document_flags(spark.createDataFrame([(1,), (2,)], "doc_id long"), t)
    assert [(r["has_revision"], r["has_dql"]) for r in flags.orderBy("doc_id").collect()] == [(True, False), (False, False)]
    assert [tuple(r) for r in C.flag_distribution(flags).collect()] == [("has_revision", 1, 50.0)]


def test_manifests(spark, tmp_path):
    flags = spark.createDataFrame([("ph_1_x.pdf", "ph", 3, "A → B", *[i % 2 == 0 for i in range(16)]), ("mm_2.pdf", "mm", 12, "(none)", *[False] * 16)], "filename string, prefix string, n_pages int, sections string, " + ", ".join(f"{f} boolean" for f in C.FLAGS))
    path = f"file://{tmp_path}/manifest"
    files.write_manifest(flags, path)
    assert sorted(map(tuple, files.read_manifest(spark, path).collect())) == sorted(map(tuple, flags.collect()))
    (tmp_path / "manifest" / "bad.csv").write_text("filename,prefix,n_pages,sections," + ",".join(C.FLAGS) + "\nst_3.pdf,st,many,x" + ",True" * 16 + "\n")
    assert files.read_manifest_tolerantly(spark, path).count() == 2
    assert files.read_manifest_tolerantly(spark, path, "ph_").count() == 1
    assert files.read_manifest_tolerantly(spark, path, files=spark.createDataFrame([("mm_2.pdf",)], "filename string")).count() == 1
    with pytest.raises(Exception):  # noqa: B017
        files.read_manifest(spark, path).collect()


def test_directories(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name in ("ph_2.pdf", "mm_1.pdf", "x.txt", "deep/ph_2_b.pdf"):
        (tmp_path / "in" / name).write_bytes(b"%PDF")
    assert sorted((r["filename"], r["prefix"]) for r in files.scan_directory(spark, f"file://{tmp_path}/in").collect()) == [("mm_1.pdf", "mm"), ("ph_2.pdf", "ph")]
    assert files.find_document(spark, f"file://{tmp_path}/in", "ph_2_").first()["filename"] == "ph_2_b.pdf"
    with pytest.raises(FileNotFoundError):
        files.find_document(spark, f"file://{tmp_path}/in", "none")


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("ph_1", "<html>")], "stem string, html string")
    assert files.write_html(docs, f"file://{tmp_path}/html", dry_run=True) == 1 and not (tmp_path / "html").exists()
    files.write_html(docs, f"file://{tmp_path}/html")
    assert [(p.name, p.read_text()) for p in (tmp_path / "html").glob("*.htm")] == [("ph_1.htm", "<html>")]
    lines = spark.createDataFrame([("b", 2, "x"), ("a", 1, "y")], "prefix string, n int, line string")
    files.write_report(lines, f"file://{tmp_path}/report", ["n"])
    files.write_logs(lines, f"file://{tmp_path}/logs")
    assert [p.read_text() for p in (tmp_path / "report").glob("part-*")] == ["y\nx\n"]
    assert sorted(p.name for p in (tmp_path / "logs").glob("prefix=*")) == ["prefix=a", "prefix=b"]


def test_documents_as_a_stream(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(20)
    docs.repartition(2).write.parquet(f"file://{tmp_path}/in")
    stream = streaming.read_documents(spark, f"file://{tmp_path}/in", 1)
    streaming.section_patterns(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/state").awaitTermination(120)
    out = spark.read.parquet(f"file://{tmp_path}/out")
    assert out.count() == 20 and out.select("batch").distinct().count() == 2


def test_counts_of_patterns_over_batches_and_a_restart(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    paths = [f"file://{tmp_path}/{x}" for x in ("in", "patterns", "counts", "state1", "state2")]
    for part in range(4):  # the last part comes after a restart of both streams
        docs.where(f"doc_id % 4 = {part}").coalesce(1).write.mode("append").parquet(paths[0])
        if part >= 2:
            streaming.section_patterns(streaming.read_documents(spark, paths[0], 1), paths[1], paths[3]).awaitTermination(120)
            streaming.pattern_counts(spark, paths[1], paths[2], paths[4], 1).awaitTermination(120)
    assert spark.read.parquet(paths[2]).select("batch").distinct().count() > 3
    whole = C.section_patterns(docs.select("doc_id"), C.heading_sequence(layout.words(docs)))
    key = lambda df: sorted(map(tuple, df.select("pattern", "n_docs", "first_doc").collect()))
    assert key(streaming.current_counts(spark, paths[2])) == key(C.top_patterns(whole, 10_000))


def test_a_table_of_a_database_takes_rows_by_key_and_again(spark, tmp_path):
    url, properties = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "createTableColumnTypes": "part VARCHAR(64)"}
    first = spark.createDataFrame([(i, "s", f"old {i}") for i in range(10)], "doc_id long, part string, text string")
    again = spark.createDataFrame([(i, "s", f"new {i}") for i in range(5, 15)], "doc_id long, part string, text string")
    for df in (first, again, again):
        files.write_table(df, url, "nodes", ["doc_id", "part"], properties)
    found = lambda: sorted(map(tuple, spark.read.jdbc(url, "nodes", properties=properties).collect()))
    want = sorted([(i, "s", f"old {i}") for i in range(5)] + [(i, "s", f"new {i}") for i in range(5, 15)])
    assert found() == want
    bad = again.withColumn("text", F.expr("if(doc_id = 9, raise_error('no'), 'bad')"))
    with pytest.raises(Exception):  # noqa: B017
        files.write_table(bad, url, "nodes", ["doc_id", "part"], properties)
    assert found() == want
    names = spark.read.jdbc(url, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') t", properties={"driver": properties["driver"]}).collect()
    assert [r[0] for r in names] == ["NODES"]  # no table of a job is left
