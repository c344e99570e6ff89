"""Ruled tables and grids: one small table for each case."""

import pytest
from pyspark.sql import functions as F

from pagewright.operators import grids as G
from pagewright.operators import qa as Q
from pagewright.operators import tables as B

TABLES = "doc_id long, page int, table_idx int, bbox struct<x0:double,top:double,x1:double,bottom:double>, cells array<array<string>>"
RECTS = "doc_id long, page int, rect_idx int, x0 double, x1 double, top double, bottom double, fill boolean, color array<double>"
WORDS = "doc_id long, page int, word_idx int, text string, x0 double, x1 double, top double, fontname string, size double"


def tables(spark, *rows):
    """(page, box, cells) of document 1."""
    seen: dict = {}
    out = []
    for page, box, cells in rows:
        seen[page] = seen.get(page, -1) + 1
        out.append((1, page, seen[page], tuple(float(x) for x in box), cells))
    return spark.createDataFrame(out, TABLES)


def rects(spark, *rows):
    return spark.createDataFrame([(1, p, i, *map(float, box), fill, color) for i, (p, box, fill, color) in enumerate(rows)], RECTS)


BOX = (50, 100, 500, 300)
LONG = "This is a sentence of the body text that goes on for far more than sixty characters."


@pytest.mark.parametrize(
    ("box", "cells", "want"),
    [
        (BOX, [], True),
        ((50, 100, 500, 120), [["a", "b"]], True),
        ((50, 100, 500, 120), [["a", "b", "c"]], False),
        (BOX, [[""], [None]], True),
        (BOX, [[LONG], [LONG]], True),
        (BOX, [["Drug names of interest"], ["abc"]], False),
        (BOX, [["Drug list of " + LONG], [LONG]], False),
        (BOX, [["a"], [""], [""], [None]], True),
        (BOX, [[None, "* a footnote in a box that is longer than forty characters"]], True),
        (BOX, [["a", "b"], ["c", "d"]], False),
    ],
)
def test_spurious(spark, box, cells, want):
    assert B.spurious(tables(spark, (1, box, cells))).first()["spurious"] is want


def test_boxes_within_boxes(spark):
    t = tables(spark, (1, (50, 100, 500, 300), [["a", "b"], ["c", "d"]]), (1, (60, 120, 200, 200), [["x", "y"], ["z", "w"]]), (1, (60, 120, 400, 200), [["x", "y"], ["z", "w"]]))
    assert [r["spurious"] for r in B.spurious(t).orderBy("table_idx").collect()] == [False, True, False]


def test_green_stripes(spark):
    t = tables(spark, (1, BOX, [["a", "b"], ["c", "d"]]))
    stripe = rects(spark, (1, (50, 500, 110, 130), True, [0.0, 0.65, 0.3]))
    assert B.spurious(t, stripe).first()["spurious"] is True
    assert B.spurious(t, rects(spark, (1, (50, 500, 310, 330), True, [0.0, 0.65, 0.3]))).first()["spurious"] is False


def test_an_open_table_continues(spark):
    """Its box begins at 213.4, its borders reach the head of the page."""
    cells = [["a", "b"], ["c", "d"]]
    t = tables(spark, (2, (50, 500, 500, 700), cells), (3, (50, 213.4, 500, 400), cells))
    r = rects(spark, (3, (50.5, 51.5, 80, 220), False, [0.0]))
    out = B.continuations(B.visual_top(B.spurious(t), r)).orderBy("page").collect()
    assert [(x["true_top"], x["is_continuation"]) for x in out] == [(500.0, False), (80.0, True)]
    gap = tables(spark, (1, (50, 500, 500, 700), cells), (3, (50, 100, 500, 400), cells))
    assert not any(x["is_continuation"] for x in B.continuations(B.visual_top(B.spurious(gap), r)).collect())


def test_rotated_headers(spark):
    rows = [(1, 1, i, "ab", 60.0 + 16 * (i % 5), 66.0, 10.0 + i, "A", 6.0) for i in range(20)] + [(1, 2, i, "ab", 60.0, 66.0, 10.0 + i, "A", 6.0) for i in range(20)]
    assert {r["page"]: r["tiny_cols"] for r in B.rotated_headers(spark.createDataFrame(rows, WORDS)).collect()} == {1: 5, 2: 1}


@pytest.mark.parametrize(
    ("row0", "title", "detected", "handler"),
    [
        (["Type of Revision", "Summary of Changes"], "", "revision", "revision"),
        (["Product", "Strength"], "", "dql", "dql"),
        (["Product", "Criteria for Use"], "", "generic", "nonpref"),
        (["Indication", "Cri teria:"], "", "criteria", "catch_all"),
        (["HCPCS", "x"], "", "hcpcs", "hcpcs"),
        (["", "Mechanism of Action"], "", "moa", "moa"),
        (["ICD-10 x", ""], "", "hcpcs", "hcpcs"),
        (["Date", "EUA"], "", "generic", "eua"),
        (["a", "Summary of Changes"], "", "revision", "rev_flex"),
        (["a", "b"], "Table 2. Doses", "generic", "titled_generic"),
        (["a", "b"], "F ORMS by indication", "generic", "titled_generic"),
        (["Non-Covered Brand", "b"], "", "generic", "drug_equiv"),
        (["Ingredient", "b"], "", "generic", "known_kw"),
        (["a", "b"], "FDA Dosing", "generic", "catch_all"),
    ],
)
def test_cascades(spark, row0, title, detected, handler):
    t = tables(spark, (1, BOX, [row0, ["1", "2"]])).withColumns({"spurious": F.lit(False), "title": F.lit(title), "left_text": F.lit(""), "tiny_cols": F.lit(0), "is_continuation": F.lit(False)})
    out = t.select(B.detected_type().alias("d"), B.handler().alias("h")).first()
    assert (out["d"], out["h"]) == (detected, handler)


def test_later_kinds(spark):
    base = {"spurious": F.lit(False), "title": F.lit(""), "left_text": F.lit(""), "tiny_cols": F.lit(0)}
    kind = lambda cells, **more: tables(spark, (1, BOX, cells)).withColumns({**base, "is_continuation": F.lit(False), **more}).select(B.detected_type()).first()[0]
    assert kind([["a", "b"]], is_continuation=F.lit(True)) == "continuation"
    assert kind([["a", None]]) == "unknown" and kind([["a", "b"]]) == "generic"
    assert kind([["a"]] * 4) == "unknown" and kind([["a"]] * 5) == "generic"
    assert kind([["a", "b"]], tiny_cols=F.lit(4)) == "availability"
    assert kind([["a", "b"]], left_text=F.lit("see CPT")) == "hcpcs"


def _stitched(spark, rows, word_rows=(), segments=None):
    t = tables(spark, *[(p, box, cells) for p, box, cells, *_ in rows])
    handlers = {p: h for p, _, _, h in rows}
    segment = F.lit("S")
    for p, s in (segments or {}).items():
        segment = F.when(F.col("page") == p, s).otherwise(segment)
    handler = F.lit("catch_all")
    for p, h in handlers.items():
        handler = F.when(F.col("page") == p, h).otherwise(handler)
    words = spark.createDataFrame([(1, p, 0, "w", 50.0, 60.0, float(top), "A", 9.0) for p, top in word_rows] or [(9, 1, 0, "w", 1.0, 2.0, 3.0, "A", 9.0)], WORDS)
    return B.stitch(t.withColumn("handler", handler).withColumn("segment", segment).withColumn("bold_header", F.lit(True)), words)


CELLS = [["a", "b", "c"], ["1", "2", "3"]]


@pytest.mark.parametrize(
    ("handler", "change", "want"),
    [
        ("criteria", {}, [2, 3]), ("criteria", {"x0": 61}, []), ("criteria", {"top": 140}, []), ("criteria", {"segment": "T"}, []), ("criteria", {"word": 20}, [2, 3]),
        ("titled_generic", {}, [2, 3]), ("titled_generic", {"word": 20}, []), ("known_kw", {"segment": "T"}, []),
        ("moa", {"top": 120}, []), ("moa", {"cells": [["a", "b"]]}, []), ("moa", {}, [2, 3]),
        ("dql", {}, [2]), ("dql", {"word": 20}, []), ("dql", {"x0": 300, "top": 600, "word": 598}, [2]), ("revision", {}, [2, 3]), ("revision", {"cells": [["HCPCS", "b"]]}, []), ("revision", {"cells": [["a", "b", "c", "d"]]}, []),
        ("fda_dosing", {"segment": "T"}, [2]), ("rev_flex", {"word": 20, "segment": "T", "x0": 400}, [2]), ("catch_all", {}, []),
    ],
)
def test_stitching_rules(spark, handler, change, want):
    second = (change.get("x0", 52), change.get("top", 80), 500, 700)
    rows = [(1, BOX, CELLS, handler), (2, second, change.get("cells", CELLS), "catch_all"), (3, (52, 80, 500, 300), CELLS, "catch_all"), (5, (52, 80, 500, 300), CELLS, "catch_all")]
    words = [(2, change.get("word", 90)), (3, 90)]
    out = _stitched(spark, rows, words, {2: change["segment"]} if "segment" in change else None)
    assert out.where("page = 1").first()["consumed"] == want


def test_what_is_consumed_builds_nothing(spark):
    rows = [(1, BOX, CELLS, "criteria"), (2, (52, 80, 500, 700), CELLS, "criteria"), (3, (52, 200, 500, 300), CELLS, "criteria")]
    assert [r["page"] for r in B.unconsumed(_stitched(spark, rows)).orderBy("page").collect()] == [1, 3]


def test_titles(spark):
    t = tables(spark, (1, BOX, CELLS), (2, (50, 100, 500, 300), CELLS))
    lines = spark.createDataFrame(
        [(1, 1, 60.0, 50.0, "Dosing", 11.0, True), (1, 1, 78.0, 50.0, "Table 1. A title that goes on", 9.0, True), (1, 1, 92.0, 50.0, "over two lines", 9.0, True), (1, 1, 91.0, 300.0, "a", 6.0, True), (1, 1, 660.0, 50.0, "Bold foot", 9.0, True), (1, 2, 95.0, 50.0, "plain", 9.0, False)],
        "doc_id long, page int, top double, x0 double, text string, size double, bold boolean",
    )
    assert [r["title"] for r in B.walked_titles(t, lines).orderBy("page").collect()] == ["Table 1. A title that goes on over two lines a", "Bold foot"]


def test_left_compaction_and_groups(spark):
    """Values move left over empty cells, under the wrong header where a middle cell is blank."""
    out = G.generic_rows(tables(spark, (1, BOX, [["A", "B", "C"], ["1", "", "3"], ["", "group", None], ["", "", ""], ["x", "y", "z"], ["only", None, ""]]))).orderBy("r").collect()
    assert [(r["r"], r["kind"], r["values"]) for r in out] == [(0, "header", ["A", "B", "C"]), (1, "data", ["1", "3", ""]), (2, "group", ["group"]), (4, "data", ["x", "y", "z"]), (5, "data", ["only", "", ""])]


def test_a_header_over_an_empty_column_moves_left(spark):
    out = G.generic_rows(tables(spark, (1, BOX, [["", "Brand", "Dose"], ["a", "", "1"]]))).orderBy("r").collect()
    assert [r["values"] for r in out] == [["Brand", "Dose"], ["a", "1"]]
    bare = G.generic_rows(tables(spark, (1, BOX, [["a", "b"], ["c", ""]])), False).orderBy("r").collect()
    assert [(r["kind"], r["values"]) for r in bare] == [("data", ["a", "b"]), ("data", ["c", ""])]


def test_generic_html(spark):
    html = G.render_generic(G.generic_rows(tables(spark, (1, BOX, [["A", "B"], ["1\n2", "<"], ["", "g"]])))).first()["html"]
    assert "<th>A</th>" in html and "1<br>2" in html and "&lt;" in html and '<td colspan="2" style="font-weight:bold">g</td>' in html
    assert html.count("<tr") == 3 and html.endswith("   </tbody>\n  </table>")


def test_spans_and_fills(spark):
    t = tables(spark, (1, BOX, [["", "a"], ["P", "b"], [None, "c"], ["", "d"], ["Q", "e"]]))
    assert [r["rowspan"] for r in G.rowspans(G.grid_rows(t)).orderBy("r").collect()] == [0, 3, 0, 0, 1]
    revisions = tables(spark, (1, BOX, [["Type of Revision", "Summary", "Date"], ["Annual", "x\ny", "1"], ["", "z", "2"], ["", "", ""], ["New", None, None]]))
    assert [(r["c0"], r["c1"], r["c2"]) for r in G.revision_rows(G.grid_rows(revisions)).orderBy("r").collect()] == [("Annual", "x y", "1"), ("Annual", "z", "2"), ("New", "", "")]


def test_header_collapse(spark):
    out = G.collapse_header(tables(spark, (1, BOX, [["Product", "Retail"], ["", "Maximum"], ["and Strength", "Quantity"], ["Drugumab", "4"]]))).first()
    assert (out["data_start"], out["header"]) == (3, ["Product and Strength", "Retail Maximum Quantity"])


def test_wrapped_rows(spark):
    rows = spark.createDataFrame([(1, 1, 0, 0, 1, "a", "x", "1"), (1, 1, 0, 1, 0, "", "more", ""), (1, 1, 0, 1, 1, "", "own", ""), (1, 1, 0, 2, 0, "b", "y", "2")], "doc_id long, page int, table_idx int, part int, r int, c0 string, c1 string, c2 string")
    assert [(r["c0"], r["c1"]) for r in G.merge_wrapped(rows).orderBy("part", "r").collect()] == [("a", "x more"), ("", "own"), ("b", "y")]


def test_tick_matrix(spark):
    t = tables(spark, (1, BOX, [[None, None, None, "-amu", "zyx", None, "bam"], [None] * 7, ["SFP", "5 mg", "√", None, None, "√", None], ["", "6\nmg", "", None, None, "√", None], ["laiV", "", "√", None, None, None, None]]))
    out = {(r["r"], r["drug"]): (r["type"], r["dosage"], r["mark"]) for r in G.availability(t).collect()}
    assert out == {(2, "uma-xyz"): ("PFS", "5 mg", "✓"), (2, "mab"): ("PFS", "5 mg", "✓"), (3, "uma-xyz"): ("PFS", "6 mg", ""), (3, "mab"): ("PFS", "6 mg", "✓")}


def test_mechanism_rows(spark):
    t = tables(spark, (1, BOX, [["", "Mechanism of Action", "Examples"], ["", "Group", ""], ["brb", "x", "one"], ["", "", "two"], ["c", "", ""]]))
    assert [(r["kind"], r["values"]) for r in G.moa_rows(t).orderBy("r").collect()] == [("heading", ["Group"]), ("data", ["brb", "x", "one<br>two"]), ("data", ["c", "", ""])]


def test_coverage_and_references(spark):
    t = tables(spark, (1, BOX, CELLS), (2, BOX, CELLS), (3, BOX, CELLS), (4, BOX, CELLS)).withColumn("spurious", F.col("page") == 4)
    regions = spark.createDataFrame([(1, 1, 109.0, 291.0), (1, 2, 95.0, 300.0), (1, 3, 111.0, 300.0)], "doc_id long, page int, box_top double, box_bottom double")
    bounds = spark.createDataFrame([(1, "Overview", 1, 0.0, 1), (1, "References", 2, 50.0, 1), (1, "Appendix", 3, 50.0, 1)], "doc_id long, segment string, page int, top double, seq int")
    assert [r["status"] for r in Q.coverage(t, regions, Q.references_range(bounds)).orderBy("page").collect()] == ["OK", "SPURIOUS", "MISSED", "SPURIOUS"]


def test_row_loss(spark):
    sources = spark.createDataFrame([(1, 1, 0, (50.0, 100.0, 500.0, 300.0), 5)], "doc_id long, page int, table_idx int, bbox struct<x0:double,top:double,x1:double,bottom:double>, expected long")
    html = lambda n: "<tbody>" + "<tr>" * n + "</tbody>"
    nodes = spark.createDataFrame([(1, 1, "generic", 110.0, html(4)), (1, 1, "generic", 120.0, html(3)), (1, 1, "generic", 121.0, html(0)), (1, 1, "moa", 100.0, html(0))], "doc_id long, page int, table_type string, top double, html string")
    losses = Q.row_loss(nodes, sources)
    assert [(r["top"], r["missing"]) for r in losses.collect()] == [(120.0, 2)]
    assert [tuple(r) for r in Q.missing_by_document(losses).collect()] == [(1, 1, 2)]
