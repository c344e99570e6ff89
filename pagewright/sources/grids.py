"""Made-up ruled tables for tests: five parts a table, with headers that exercise every kind of table.

Scaffolding, not an operator. doc_id, page, table_idx, bbox (struct x0, top, x1, bottom), cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADERS = [
    ["Type of Revision", "Summary of Changes", "Date"],
    ["Product", "Strength", "Retail"],
    ["Indication", "Criteria:", "Notes"],
    ["HCPCS", "Description", "Notes"],
    ["", "Mechanism of Action", "Examples of Indications*"],
    ["ICD-10 Codes", "Description", ""],
    ["Date", "EUA Letter", "Notes"],
    ["Drug", "Prescribing Details", "Dose"],
    ["Change", "Summary of Changes", "Date"],
    ["Exception Criteria", "Details", "Notes"],
    ["Non-Covered Brand", "Bioequivalent", "Notes"],
    ["Medication", "Dose", "Mode of Administration"],
    ["Condition", "Detail", "Use"],
    ["Compound Name", "Comments", "Dose"],
    ["Alpha", "Beta", "Gamma"],
    [None, "Beta", ""],
]


def tables(part: DataFrame) -> DataFrame:
    t = F.expr("cast((p_partkey - 1) div 5 as int)")
    row = F.array(F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")), F.col("p_name"), F.when(F.col("p_size") % 4 == 0, F.lit("")).otherwise(F.col("p_size").cast("string")))
    width = F.when(F.col("t") % 17 == 0, 1).when(F.col("t") % 13 == 0, 2).otherwise(3)
    heads = F.array(*[F.array(*[F.lit(c).cast("string") for c in h]) for h in HEADERS])
    grouped = part.withColumn("t", t).withColumn("row", row).groupBy("t").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "row"))).alias("rows"))
    cells = F.concat(F.array(F.get(heads, F.col("t") % len(HEADERS))), F.transform("rows", lambda r: r["row"]))
    x0, top = (50 + 4 * (F.col("t") % 3)).cast("double"), (60 + 40 * (F.col("t") % 9)).cast("double")
    height = F.when(F.col("t") % 11 == 0, 20).otherwise(150)
    bbox = F.struct(x0.alias("x0"), top.alias("top"), (500 - 20.0 * (F.col("t") % 4)).alias("x1"), (top + height).alias("bottom"))
    return grouped.select(
        F.expr("t div 8").alias("doc_id"), F.expr("cast((t % 8) div 2 as int) + 1").alias("page"), (F.col("t") % 2).alias("table_idx"), bbox.alias("bbox"),
        F.transform(cells, lambda r: F.slice(r, 1, width)).alias("cells"),
    ).where("page != 3 or doc_id % 5 != 0")  # some pages have none


def pages(part: DataFrame) -> DataFrame:
    """The tables as whole pages, as a reader gives them: doc_id, page, tables, words, rects (arrays)."""
    held = tables(part).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("table_idx", "bbox", "cells"))).alias("tables"))
    some = lambda a: F.array_sort(F.filter(F.flatten(a), lambda x: x.isNotNull()))
    return held.select("doc_id", "page", "tables", some(F.transform("tables", _words_of)).alias("words"), some(F.transform("tables", _rects_of)).alias("rects"))


def _words_of(t: Column) -> Column:
    """Words around a table: a bold title 12 points above, a code at the left, tiny rotated headers on some pages."""

    def entry(i, text, x0, x1, top, font, size) -> Column:
        return F.struct((t["table_idx"] * 1000 + i).cast("long").alias("word_idx"), text.alias("text"), x0.cast("double").alias("x0"), x1.cast("double").alias("x1"), top.cast("double").alias("top"), F.lit(font).alias("fontname"), F.lit(size).alias("size"))

    b, title = t["bbox"], F.element_at(F.array(*[F.lit(x) for x in ("Table 1. Products", "FDA Approved", "Preferred Products", "Plain Title", "Dosing")]), (F.pmod(F.col("doc_id") + F.col("page"), F.lit(5)) + 1).cast("int"))
    plain = F.array(
        entry(0, title, b["x0"], b["x0"] + 80, b["top"] - 12, "Arial-Bold", 10.0),
        entry(1, F.lit("note"), b["x0"] + 90, b["x0"] + 120, b["top"] - 12, "Arial", 10.0),
        entry(2, F.when(F.col("doc_id") % 7 == 0, F.lit("CPT")).otherwise(F.lit("left")), b["x0"] - 40, b["x0"] - 5, b["top"] + 10, "Arial", 9.0),
        entry(3, F.lit("Head"), b["x0"] + 5, b["x0"] + 30, b["top"] + 5, "Arial-Bold", 9.0),
    )
    tiny = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: entry(k + 5000, F.lit("ab"), 60.0 + 16 * (k % 5), 66.0 + 16 * (k % 5), 200.0 + 8 * F.floor(k / 5), "Arial", 6.0))
    return F.when((F.col("doc_id") % 6 == 1) & (t["table_idx"] == 0) & (F.col("page") % 2 == 0), F.concat(plain, tiny)).otherwise(plain)


def _rects_of(t: Column) -> Column:
    """Rectangles: a gray header band, vertical borders that reach above some tables, a green stripe in others."""

    def entry(i, x0, x1, top, bottom, fill, color) -> Column:
        return F.struct((t["table_idx"] * 100 + i).cast("long").alias("rect_idx"), x0.alias("x0"), x1.alias("x1"), top.alias("top"), bottom.alias("bottom"), F.lit(fill).alias("fill"), F.array(*[F.lit(c) for c in color]).alias("color"))

    b, i = t["bbox"], F.col("doc_id") + t["table_idx"]
    return F.array(
        entry(0, b["x0"], b["x1"], b["top"], b["top"] + 20, True, (0.8, 0.8, 0.8)),
        F.when(i % 3 == 0, entry(1, b["x0"] + 1, b["x0"] + 2, b["top"] - 25, b["top"] + 5, False, (0.0, 0.0, 0.0))),
        F.when(i % 19 == 0, entry(2, b["x0"], b["x1"], b["top"] + 30, b["top"] + 44, True, (0.0, 0.65, 0.3))),
    )


def dosing_pages(part: DataFrame) -> DataFrame:
    """Whole pages with dosing tables and their characters: doc_id (a part a row, six parts a document), page, tables, words, rects, chars.

    The first table has a gray header and four rows, the page after goes on with two. Every third part is a row within the row before it, whose box
    reaches over it; doses are a line of the name, underlined up to its first space where the size is divisible by 4, and a line of the type with a bullet
    where it is odd.
    """
    n = (F.col("p_partkey") % 6).cast("int")
    p = part.select(F.expr("p_partkey div 6").alias("doc_id"), n.alias("n"), F.when(n < 4, 1).otherwise(2).alias("page"), "p_brand", "p_name", "p_type", "p_size")
    row = (F.col("n") + F.when(F.col("page") == 1, 1).otherwise(-4)).alias("r")
    p = p.withColumn("r", row).withColumn("sub", F.col("n") % 3 == 2).withColumn("top", 100.0 + 30 * F.col("r") - F.when(F.col("page") == 2, 40).otherwise(0))
    p = p.withColumn("tall", (F.col("n") % 3 == 1) & (F.col("page") == 1))
    box = F.struct(F.when(F.col("sub"), 135.0).otherwise(54.0).alias("x0"), F.col("top").alias("top"), F.lit(527.0).alias("x1"), (F.col("top") + F.when(F.col("tall"), 60).otherwise(30)).alias("bottom"))
    second = F.concat(F.when(F.col("p_size") % 2 == 1, F.lit("• ")).otherwise(""), F.lit("<"), "p_type")
    name = lambda text, x0, down: F.transform(F.split(text, ""), lambda c, i: F.struct(c.alias("text"), (x0 + 5.0 * i).alias("x0"), (x0 + 5.0 * i + 5).alias("x1"), (F.col("top") + down).alias("top"), (F.col("top") + down + 8).alias("bottom")))
    chars = F.concat(F.when(F.col("sub"), F.array_repeat(F.struct(F.lit("").alias("text"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("x1"), F.lit(0.0).alias("top"), F.lit(0.0).alias("bottom")), 0)).otherwise(name(F.col("p_brand"), 58.0, 4.0)), name(F.col("p_name"), 140.0, 4.0), name(second, 140.0, 16.0))
    rule = F.when(F.col("p_size") % 4 == 0, F.struct(F.lit(140.0).alias("x0"), (140.0 + 5 * (F.instr("p_name", " ") - 1)).alias("x1"), (F.col("top") + 13).alias("top"), (F.col("top") + 13.5).alias("bottom"), F.lit(True).alias("fill"), F.array(F.lit(0.0)).alias("color"), F.lit("scalar").alias("color_kind")))
    cells = F.array(F.when(~F.col("sub"), F.col("p_brand")), F.concat("p_name", F.lit("\n"), second))
    p = p.withColumns({"box": box, "cs": F.filter(chars, lambda c: c["text"] != ""), "rule": rule, "cells": cells})
    held = p.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("r", "cells", "box", "cs", "rule"))).alias("rows"))
    head, one = F.col("page") == 1, F.lit(1.0)
    top = F.when(head, 100.0).otherwise(60.0)
    bbox = F.struct(F.lit(54.0).alias("x0"), top.alias("top"), F.lit(527.0).alias("x1"), (top + 30 * (F.size("rows") + head.cast("int"))).alias("bottom"))
    header = F.array(F.array(F.lit(None).cast("string"), F.lit("Indication & use"), F.lit("Doses")))
    head_box = F.array(F.struct((54.0 * one).alias("x0"), (100.0 * one).alias("top"), (527.0 * one).alias("x1"), (130.0 * one).alias("bottom")))
    of = lambda name: F.transform("rows", lambda x: x[name])
    gray = F.struct(F.lit(54.0).alias("x0"), F.lit(527.0).alias("x1"), F.lit(100.0).alias("top"), F.lit(130.0).alias("bottom"), F.lit(True).alias("fill"), F.array(F.lit(0.8)).alias("color"), F.lit("scalar").alias("color_kind"))
    rects = F.concat(F.when(head, F.array(F.struct(*[gray[c].alias(c) for c in RECT]))).otherwise(F.array().cast(f"array<{RECT_TYPE}>")), F.transform(F.filter(of("rule"), lambda r: r.isNotNull()), lambda r: F.struct(*[r[c].alias(c) for c in RECT])))
    table = F.struct(F.lit(0).alias("table_idx"), bbox.alias("bbox"), F.when(head, F.concat(header, of("cells"))).otherwise(of("cells")).alias("cells"), F.when(head, F.concat(head_box, of("box"))).otherwise(of("box")).alias("row_boxes"))
    word = lambda i, text, x0, y: F.struct(F.lit(i).cast("long").alias("word_idx"), F.lit(text).alias("text"), F.lit(x0).alias("x0"), F.lit(x0 + 80).alias("x1"), y.alias("top"), F.lit("Arial-Bold").alias("fontname"), F.lit(10.0).alias("size"))
    words_ = F.when(head, F.array(word(0, "FDA Approved Dosing", 60.0, F.lit(88.0)), word(1, "Head", 60.0, F.lit(104.0)))).otherwise(F.array(word(0, "Row", 60.0, F.lit(64.0))))
    return held.select("doc_id", "page", F.array(table).alias("tables"), words_.alias("words"), F.transform(rects, lambda r, i: r.withField("rect_idx", i.cast("long"))).alias("rects"), F.flatten(of("cs")).alias("chars"))


# Columns of a rectangle of ``dosing_pages``, and its type.
RECT = ("x0", "x1", "top", "bottom", "fill", "color", "color_kind")
RECT_TYPE = "struct<x0:double,x1:double,top:double,bottom:double,fill:boolean,color:array<double>,color_kind:string>"


def words(pages_: DataFrame) -> DataFrame:
    """The pages' words, a row each."""
    return pages_.select("doc_id", "page", F.explode("words").alias("w")).select("doc_id", "page", "w.*")


def rects(pages_: DataFrame) -> DataFrame:
    """The pages' rectangles, a row each."""
    return pages_.select("doc_id", "page", F.explode("rects").alias("r")).select("doc_id", "page", "r.*")


def _sql_header(h: list) -> str:
    return "[" + ", ".join("NULL" if c is None else "'" + c + "'" for c in h) + "]"


#: DuckDB SQL of the three relations.
GRIDS_SQL = f"""
gparts AS (SELECT *, CAST((p_partkey - 1) // 5 AS INTEGER) AS t, [CASE WHEN p_partkey % 3 <> 0 THEN p_brand END, p_name, CASE WHEN p_size % 4 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END] AS r FROM part),
ggrouped AS (SELECT t, list(r ORDER BY p_partkey) AS rs FROM gparts GROUP BY t),
gwide AS (SELECT t, list_concat([[{", ".join(_sql_header(h) for h in HEADERS)}][(t % {len(HEADERS)}) + 1]], rs) AS cs, CASE WHEN t % 17 = 0 THEN 1 WHEN t % 13 = 0 THEN 2 ELSE 3 END AS w FROM ggrouped),
tables AS (SELECT t // 8 AS doc_id, CAST((t % 8) // 2 AS INTEGER) + 1 AS page, t % 2 AS table_idx, CAST(50 + 4 * (t % 3) AS DOUBLE) AS x0, CAST(60 + 40 * (t % 9) AS DOUBLE) AS top, 500.0 - 20 * (t % 4) AS x1, CAST(60 + 40 * (t % 9) + CASE WHEN t % 11 = 0 THEN 20 ELSE 150 END AS DOUBLE) AS bottom,
  [c[1:w] for c in cs] AS cells FROM gwide WHERE NOT ((t % 8) // 2 = 2 AND (t // 8) % 5 = 0)),
gwords AS (SELECT doc_id, page, table_idx * 1000 AS word_idx, ['Table 1. Products', 'FDA Approved', 'Preferred Products', 'Plain Title', 'Dosing'][(doc_id + page) % 5 + 1] AS text, x0, x0 + 80 AS x1, top - 12 AS top, 'Arial-Bold' AS fontname, 10.0 AS size FROM tables
  UNION ALL SELECT doc_id, page, table_idx * 1000 + 1, 'note', x0 + 90, x0 + 120, top - 12, 'Arial', 10.0 FROM tables
  UNION ALL SELECT doc_id, page, table_idx * 1000 + 2, CASE WHEN doc_id % 7 = 0 THEN 'CPT' ELSE 'left' END, x0 - 40, x0 - 5, top + 10, 'Arial', 9.0 FROM tables
  UNION ALL SELECT doc_id, page, table_idx * 1000 + 3, 'Head', x0 + 5, x0 + 30, top + 5, 'Arial-Bold', 9.0 FROM tables
  UNION ALL SELECT doc_id, page, k + 5000, 'ab', 60.0 + 16 * (k % 5), 66.0 + 16 * (k % 5), 200.0 + 8 * (k // 5), 'Arial', 6.0 FROM tables, range(20) AS g(k) WHERE doc_id % 6 = 1 AND table_idx = 0 AND page % 2 = 0),
grects AS (SELECT doc_id, page, table_idx * 100 AS rect_idx, x0, x1, top, top + 20 AS bottom, true AS fill, 0.8 AS r, 0.8 AS g, 0.8 AS b FROM tables
  UNION ALL SELECT doc_id, page, table_idx * 100 + 1, x0 + 1, x0 + 2, top - 25, top + 5, false, 0.0, 0.0, 0.0 FROM tables WHERE (doc_id + table_idx) % 3 = 0
  UNION ALL SELECT doc_id, page, table_idx * 100 + 2, x0, x1, top + 30, top + 44, true, 0.0, 0.65, 0.3 FROM tables WHERE (doc_id + table_idx) % 19 = 0)
"""
