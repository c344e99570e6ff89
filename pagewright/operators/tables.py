"""Ruled tables: spurious ones, kinds, titles, continuations over pages.

A page holds few tables, words and rectangles, so its rectangles, words or other tables are gathered into
arrays by (doc_id, page) and tested with array functions: joins stay on keys, never on ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions import vocabulary as V

from .relational import first_within, joined

PAGE = ["doc_id", "page"]


def _held(df: DataFrame, columns: list[str], name: str, order: list[str] | None = None) -> DataFrame:
    return df.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct(*(order or []), *columns))).alias(name))


_WORD = ["text", "x0", "x1", "top", "fontname", "size"]
_RECT = ["x0", "x1", "top", "bottom", "fill", "color"]


def on_page(tables: DataFrame, words: DataFrame | None = None, rects: DataFrame | None = None, others: bool = False) -> DataFrame:
    """``tables`` with what their page holds, each gathered once: _words, _rects and _others (its tables).

    All are grouped by (doc_id, page), so operators that take several of them share the shuffles. Where a reader gives whole
    pages, ``page_tables`` has the same columns without any join.
    """
    t = tables
    if others:
        t = t.withColumn("_others", F.array_sort(F.collect_list(F.struct("table_idx", "bbox")).over(Window.partitionBy(*PAGE))))
    if words is not None:
        t = t.join(_held(words, [c for c in _WORD if c in words.columns], "_words", ["word_idx"]), PAGE, "left")
    if rects is not None:
        t = t.join(_held(rects, _RECT, "_rects"), PAGE, "left")
    return t


def page_tables(pages: DataFrame) -> DataFrame:
    """Tables of whole pages (doc_id, page, tables, words, rects: arrays) with _words, _rects and _others of their page: no shuffle, no join.

    ``tables``: structs of table_idx, bbox, cells; ``words`` and ``rects`` in the order of the reader.
    """
    others = F.transform("tables", lambda t: F.struct(t["table_idx"].alias("table_idx"), t["bbox"].alias("bbox")))
    rows = pages.select(*PAGE, F.col("words").alias("_words"), F.col("rects").alias("_rects"), others.alias("_others"), F.explode("tables").alias("t"))
    return rows.select(*PAGE, "t.*", "_words", "_rects", "_others")


def _filled(value: Column) -> Column:
    return T.cell(value) != ""


def _at(row: Column, i: int) -> Column:
    return T.cell(F.get(row, F.lit(i)))


def spurious(tables: DataFrame, rects: DataFrame | None = None) -> DataFrame:
    """``tables`` with a flag: rules, empty boxes, boxes within boxes, stripes and bordered paragraphs are no tables."""
    t = on_page(tables, rects=rects, others=True)
    return t.withColumn("spurious", _spurious(rects is not None)).drop("_others", "_rects")


def _spurious(stripes: bool) -> Column:
    b, cells = F.col("bbox"), F.col("cells")
    n_rows, row0 = F.size("cells"), F.get("cells", F.lit(0))
    cols = F.size(row0)
    flat_cells = F.flatten(cells)
    green = lambda r: F.coalesce(T.is_green_stripe(r["fill"], r["color"]), F.lit(False))
    stripe = F.coalesce(F.exists("_rects", lambda r: green(r) & (r["top"] >= b["top"] - 2) & (r["bottom"] <= b["bottom"] + 2)), F.lit(False)) if stripes else F.lit(False)
    other = lambda o: o["table_idx"] != F.col("table_idx")
    within = F.exists("_others", lambda o: other(o) & (o["bbox"]["x0"] < b["x0"]) & (o["bbox"]["top"] <= b["top"]) & (o["bbox"]["x1"] > b["x1"]) & (o["bbox"]["bottom"] >= b["bottom"]))
    within_wide = F.exists(
        "_others", lambda o: other(o) & (o["bbox"]["x0"] <= b["x0"]) & (o["bbox"]["top"] <= b["top"]) & (o["bbox"]["x1"] >= b["x1"]) & (o["bbox"]["bottom"] >= b["bottom"]) & ((o["bbox"]["x1"] - o["bbox"]["x0"]) > (b["x1"] - b["x0"]) * 1.5)
    )
    first = _at(row0, 0)
    col0 = F.filter(F.transform(cells, lambda r: _at(r, 0)), lambda c: c != "")
    long_rows = F.size(F.filter(col0, lambda c: F.char_length(c) > 60))
    one_wide = (cols == 1) | ((cols == 2) & F.forall(cells, lambda r: _at(r, 1) == ""))
    prose = (
        one_wide & (F.char_length(first) > 15) & first.contains(" ") & ~T.starts_with_any(first, V.PROSE_HEADER_STARTS)
        & (F.substring(first, 1, 1).rlike(r"^\p{Lu}") | (b["x0"] > 80)) & (long_rows > F.size(col0) * 0.4)
    )
    lone = (cols == 1) & (n_rows > 3) & (F.size(F.filter(cells, lambda r: F.exists(r, _filled))) <= 1)
    footnote = (n_rows == 1) & (cols == 2) & (first == "") & (F.char_length(_at(row0, 1)) > 40) & _at(row0, 1).contains(" ")
    flag = (
        (n_rows == 0) | stripe | ((b["bottom"] - b["top"] < 30) & (cols <= 2))
        | ((cols == 1) & (F.forall(flat_cells, lambda c: ~_filled(c)) | within)) | within_wide | prose | lone | footnote
    )
    return F.coalesce(flag, F.lit(True))


def visual_top(tables: DataFrame, rects: DataFrame) -> DataFrame:
    """``tables`` with ``true_top``: vertical borders that reach above an open table show where it begins."""
    return on_page(tables, rects=rects).withColumn("true_top", _true_top()).drop("_rects")


def _true_top() -> Column:
    b = F.col("bbox")
    border = lambda r: (r["x1"] - r["x0"] < 2) & (r["bottom"] >= b["top"] - 2) & (r["top"] < b["top"]) & ((F.abs(r["x0"] - b["x0"]) < 3) | (F.abs(r["x0"] - b["x1"]) < 3))
    reach = F.array_min(F.transform(F.filter("_rects", border), lambda r: r["top"]))
    return F.least(b["top"], F.coalesce(reach, b["top"]))


def rotated_headers(tiny_words: DataFrame) -> DataFrame:
    """doc_id, page, tiny_cols: columns of the page with four or more tiny words one above the other."""
    by_column = tiny_words.where((F.col("size") < 8) & (F.char_length("text") <= 3)).groupBy(*PAGE, T.quantize(F.col("x0"), 8).alias("xk")).agg(F.count("*").alias("n"))
    return by_column.groupBy(*PAGE).agg(F.count_if(F.col("n") >= 4).alias("tiny_cols"))


def _tiny_columns() -> Column:
    """``rotated_headers`` of the words on the table's page."""
    at = F.transform(F.filter("_words", lambda w: (w["size"] < 8) & (F.char_length(w["text"]) <= 3)), lambda w: T.quantize(w["x0"], 8))
    return F.coalesce(F.size(F.filter(F.array_distinct(at), lambda k: F.size(F.filter(at, lambda x: x == k)) >= 4)), F.lit(0)).cast("long")


def continuations(tables: DataFrame) -> DataFrame:
    """``tables`` (with spurious and true_top) with ``is_continuation``: like the last real table before it, with no page without tables between, and near the top of the page."""
    runs = F.col("page") - F.dense_rank().over(Window.partitionBy("doc_id").orderBy("page"))  # of pages in a row
    last = Window.partitionBy("doc_id", "_run").orderBy("page", "table_idx").rowsBetween(Window.unboundedPreceding, -1)
    t = tables.withColumn("_run", runs).withColumn("_prev", F.last(F.when(~F.col("spurious"), F.col("bbox")), ignorenulls=True).over(last))
    like = (F.abs(F.col("bbox.x0") - F.col("_prev.x0")) < 5) & (F.abs(F.col("bbox.x1") - F.col("_prev.x1")) < 30) & (F.col("true_top") < 120)
    return t.withColumn("is_continuation", ~F.col("spurious") & F.coalesce(like, F.lit(False))).drop("_run", "_prev")


def word_titles(tables: DataFrame, words: DataFrame, most: int | None = 80) -> DataFrame:
    """``tables`` with ``title``: the bold words up to 16 points above."""
    return on_page(tables, words).withColumn("title", _word_title(most)).drop("_words")


def _texts(test) -> Column:
    """Texts of the page's words that pass, in order."""
    return F.coalesce(F.array_join(F.transform(F.filter("_words", test), lambda w: w["text"]), " "), F.lit(""))


def _word_title(most: int | None) -> Column:
    title = _texts(lambda w: w["fontname"].contains("Bold") & (w["top"] >= F.col("bbox.top") - 16) & (w["top"] < F.col("bbox.top")))
    return F.substring(title, 1, most) if most else title


def _corpus_title(bold: Column) -> Column:
    """The title of a table from the bold words of its page (top, x0, word_idx, size, text), in order."""
    near = F.filter(bold, lambda w: (w["top"] < F.col("bbox.top")) & (F.col("bbox.top") - w["top"] <= 20))
    lowest = F.array_max(F.transform(near, lambda w: w["top"]))
    anchor = F.get(F.array_sort(F.transform(F.filter(near, lambda w: w["top"] == lowest), lambda w: F.struct(w["word_idx"], w["size"]))), F.lit(0))["size"]
    kept = F.filter(near, lambda w: F.abs(w["size"] - anchor) <= 1.0)
    return F.coalesce(T.strip(T.join_capitals(F.array_join(F.transform(kept, lambda w: w["text"]), " "))), F.lit(""))


def corpus_titles(tables: DataFrame, words: DataFrame) -> DataFrame:
    """``tables`` with ``title``: the bold words up to 20 points above that are as large as the nearest of them."""
    bold = _held(words.where(F.col("fontname").contains("Bold")), ["x0", "word_idx", "size", "text"], "_bold", ["top"])
    return tables.join(bold, PAGE, "left").withColumn("title", _corpus_title(F.col("_bold"))).drop("_bold")


def profiled_pages(pages: DataFrame) -> DataFrame:
    """``corpus_titles`` and tiny_cols of whole pages, without a shuffle or a join; a page without tables is a row without cells."""
    bold = F.array_sort(F.transform(F.filter("words", lambda w: w["fontname"].contains("Bold")), lambda w: F.struct(*[w[c].alias(c) for c in ("top", "x0", "word_idx", "size", "text")])))
    rows = pages.select(*PAGE, F.col("words").alias("_words"), bold.alias("_bold"), F.explode_outer("tables").alias("t")).select(*PAGE, "t.*", "_words", "_bold")
    return rows.withColumn("title", _corpus_title(F.col("_bold"))).withColumn("tiny_cols", _tiny_columns()).drop("_words", "_bold")


def walked_titles(tables: DataFrame, lines: DataFrame, most: int | None = 80, same_size: bool = False) -> DataFrame:
    """``tables`` with ``title``: the bold lines going up from the table, with gaps of at most 20 points.

    The walk ends at a line that isn't bold, or at a short one above, at the same place, in a larger font (``same_size``: at
    one whose size differs by more than a point). A table at the top of a page without a title takes the bold lines at the foot
    of the page before.
    """
    columns = ["x0", "text", "size", "bold"]
    above = _held(lines, columns, "_above", ["top"])
    nearest = F.reverse(F.filter("_above", lambda w: w["top"] < F.col("bbox.top")))
    kind = "struct<stop:boolean,at:double,x0:double,size:double,got:array<struct<top:double,x0:double,text:string>>>"
    start = F.struct(F.lit(False).alias("stop"), F.col("bbox.top").alias("at"), F.lit(None).cast("double").alias("x0"), F.lit(None).cast("double").alias("size"), F.array().cast("array<struct<top:double,x0:double,text:string>>").alias("got")).cast(kind)

    def step(acc: Column, w: Column) -> Column:
        heading = acc["size"].isNotNull() & (F.abs(w["size"] - acc["size"]) > 1.0) if same_size else acc["size"].isNotNull() & (F.char_length(w["text"]) < 30) & (F.abs(w["x0"] - acc["x0"]) < 5) & (w["size"] > acc["size"] + 0.5)
        stop = acc["stop"] | (acc["at"] - w["top"] > 20) | ~w["bold"] | heading
        took = F.struct(F.lit(False), w["top"].cast("double"), w["x0"].cast("double"), w["size"].cast("double"), F.concat(acc["got"], F.array(F.struct(w["top"].cast("double").alias("top"), w["x0"].cast("double").alias("x0"), w["text"].alias("text")))))
        stay = F.struct(F.lit(True), acc["at"], acc["x0"], acc["size"], acc["got"])
        return F.when(stop, stay.cast(kind)).otherwise(took.cast(kind))

    got = F.col("_walk.got")
    level = lambda g: F.array_max(F.transform(F.filter(got, lambda o: F.abs(o["top"] - g["top"]) <= 6), lambda o: o["top"]))
    keyed = F.array_sort(F.transform(got, lambda g: F.struct(level(g).alias("l"), g["x0"].alias("x"), g["text"].alias("t"))))
    title = F.array_join(F.transform(keyed, lambda k: k["t"]), " ")
    foot = lines.where("bold and top > 650").groupBy("doc_id", (F.col("page") + 1).alias("page")).agg(joined("text", [F.col("top")]).alias("_foot"))
    t = tables.join(above, PAGE, "left").join(foot, PAGE, "left")
    t = t.withColumn("_walk", F.aggregate(F.coalesce(nearest, F.array().cast(f"array<struct<top:double,{','.join(f'{c}:{k}' for c, k in (('x0', 'double'), ('text', 'string'), ('size', 'double'), ('bold', 'boolean')))}>>")), start, step))
    title = F.coalesce(title, F.lit(""))
    whole = F.when((title == "") & (F.col("bbox.top") < 120), F.coalesce("_foot", F.lit(""))).otherwise(title)
    return t.withColumn("title", F.substring(whole, 1, most) if most else whole).drop("_above", "_foot", "_walk")


def left_overhang(tables: DataFrame, words: DataFrame) -> DataFrame:
    """``tables`` with ``left_text``: words that end left of the table, at its height."""
    return on_page(tables, words).withColumn("left_text", _left_text()).drop("_words")


def _left_text() -> Column:
    b = F.col("bbox")
    return _texts(lambda w: (w["x1"] <= b["x0"] + 10) & (w["top"] >= b["top"] - 5) & (w["top"] <= b["bottom"] + 5))


def gray_bottom(tables: DataFrame, rects: DataFrame, low: float = 0.3, slack: float = 2.0) -> DataFrame:
    """``tables`` with ``gray_bottom``: the foot of the lowest gray fill within; null if none."""
    held = _held(rects.where(T.is_gray(F.col("fill"), F.col("color"), low)), ["top", "bottom"], "_gray")
    hit = F.filter("_gray", lambda r: (r["top"] >= F.col("bbox.top") - slack) & (r["bottom"] <= F.col("bbox.bottom") + slack))
    return tables.join(held, PAGE, "left").withColumn("gray_bottom", F.array_max(F.transform(hit, lambda r: r["bottom"]))).drop("_gray")


def bold_header(tables: DataFrame, words: DataFrame) -> DataFrame:
    """``tables`` with a flag: a bold word in the first 20 points."""
    return on_page(tables, words).withColumn("bold_header", _bold_header()).drop("_words")


def _bold_header() -> Column:
    b = F.col("bbox")
    hit = lambda w: w["fontname"].contains("Bold") & w["top"].between(b["top"], b["top"] + 20) & w["x0"].between(b["x0"], b["x1"])
    return F.coalesce(F.exists("_words", hit), F.lit(False))


def _gray_bottom(low: float = 0.3, slack: float = 2.0) -> Column:
    hit = F.filter("_rects", lambda r: T.is_gray(r["fill"], r["color"], low) & (r["top"] >= F.col("bbox.top") - slack) & (r["bottom"] <= F.col("bbox.bottom") + slack))
    return F.array_max(F.transform(hit, lambda r: r["bottom"]))


# Cascades: three, with orders and predicates of their own -------------------------------------------


def _any_cell(row: Column, test) -> Column:
    return F.coalesce(F.exists(row, test), F.lit(False))


def titled(title: Column, keywords: list[str] = V.DETECTOR_TITLE_KW) -> Column:
    """Whether a title is that of a generic table."""
    norm = T.join_capitals(title)
    lower = F.lower(norm)
    return title.rlike(r"^(Appendix\s+)?Table\s+\d+[.]") | T.contains_any(lower, keywords) | T.strip(lower).isin(V.TITLED_GENERIC_EXACT) | norm.rlike(r"^Table\s+\d+[:\s]")


def detected_type() -> Column:
    """Kind of a table (columns cells, spurious, title, left_text, tiny_cols, is_continuation): the first that fits."""
    cells = F.col("cells")
    row0 = F.get(cells, F.lit(0))
    c0, c1 = _at(row0, 0), _at(row0, 1)
    raw0, raw1 = F.coalesce(F.get(row0, F.lit(0)), F.lit("")), F.coalesce(F.get(row0, F.lit(1)), F.lit(""))
    flat0, flat3 = T.flat_with_none(cells, 1), T.flat_with_none(cells, 3)
    dql = _any_cell(row0, lambda c: T.cell(c).isin("Product", "Product Name")) & ~F.lower(c1).contains("criteria") & ~F.lower(c1).contains("use")
    criteria = _any_cell(row0, lambda c: F.regexp_replace(F.regexp_replace(T.cell(c), r"(?U)\s+", ""), ":+$", "") == "Criteria")
    hcpcs = T.contains_any(raw0, ["HCPCS", "CPT"]) | T.contains_any(raw1, ["HCPCS", "CPT"]) | T.contains_any(F.col("left_text"), ["HCPCS", "CPT"])
    filled = lambda r: F.size(F.filter(r, _filled))
    many = ((F.size(row0) >= 2) & (F.exists(cells, lambda r: filled(r) >= 2) | (F.size(cells) >= 3))) | ((F.size(row0) == 1) & (F.size(cells) >= 5))
    return (
        F.when(F.col("spurious"), "spurious")
        .when(c0 == "Type of Revision", "revision")
        .when(dql, "dql")
        .when(F.coalesce(F.col("tiny_cols"), F.lit(0)) >= 4, "availability")
        .when(criteria, "criteria")
        .when(hcpcs, "hcpcs")
        .when(T.flat(cells, 3).contains("Mechanism of Action") & (c0 == ""), "moa")
        .when(raw0.contains("ICD-10"), "hcpcs")
        .when((c0 == "Date") & raw1.contains("EUA"), "generic")
        .when(flat0.contains("Drug") & flat0.contains("Prescribing"), "generic")
        .when(_any_cell(row0, lambda c: F.coalesce(c, F.lit("")).contains("Summary of Changes")), "revision")
        .when(titled(F.col("title")), "generic")
        .when(flat0.contains("Exception Criteria") | (flat0.contains("Non-Preferred") & flat0.contains("Criteria")) | flat0.contains("Criteria for Use"), "generic")
        .when(T.contains_any(flat0, ["Non-Covered Brand", "Non-Covered Product", "Bioequivalent"]), "generic")
        .when(flat0.contains("Medication") & flat3.contains("Mode of Administration"), "generic")
        .when(flat0.contains("Condition") & flat3.contains("Criteria for Use"), "generic")
        .when(T.contains_any(flat0, V.KNOWN_KW), "generic")
        .when(F.col("is_continuation"), "continuation")
        .when(many, "generic")
        .otherwise("unknown")
    )


def detect(tables: DataFrame, words: DataFrame, rects: DataFrame, tiny_words: DataFrame | None = None) -> DataFrame:
    """One row per table with spurious, true_top, is_continuation, title, left_text, tiny_cols, bold_header, first_word, gray_bottom, table_type, covered."""
    t = on_page(tables, words, rects, others=True)
    if tiny_words is not None:
        t = t.join(rotated_headers(tiny_words), PAGE, "left")
    return _detected(t)


def detect_pages(pages: DataFrame) -> DataFrame:
    """``detect`` of whole pages (``page_tables``): one shuffle, by document."""
    return _detected(page_tables(pages))


def _detected(t: DataFrame) -> DataFrame:
    first = F.array_min(F.transform("_words", lambda w: w["top"]))
    found = {"spurious": _spurious(True), "true_top": _true_top(), "title": _word_title(80), "left_text": _left_text(), "bold_header": _bold_header(), "first_word": first, "gray_bottom": _gray_bottom()}
    if "tiny_cols" not in t.columns:
        found["tiny_cols"] = _tiny_columns()
    t = continuations(t.withColumns(found).drop("_others", "_words", "_rects"))
    t = t.withColumn("table_type", detected_type())
    return t.withColumn("covered", ~F.col("table_type").isin("spurious", "unknown"))


def covered_regions(detected: DataFrame) -> DataFrame:
    """doc_id, page, box_top, box_bottom of covered tables, with 5 points above them, criteria tables 30."""
    expand = F.when(F.col("table_type") == "criteria", 30).otherwise(5)
    return detected.where("covered").select(*PAGE, F.greatest(F.lit(0.0), F.col("bbox.top") - expand).alias("box_top"), F.col("bbox.bottom").alias("box_bottom")).distinct()


def handler(but: Column | None = None) -> Column:
    """Name of the builder's handler for a table (columns cells, title, tiny_cols): the first that fits, ``but`` left out."""
    cells = F.col("cells")
    row0 = F.get(cells, F.lit(0))
    c0 = _at(row0, 0)
    raw0, raw1 = F.coalesce(F.get(row0, F.lit(0)), F.lit("")), F.coalesce(F.get(row0, F.lit(1)), F.lit(""))
    flat0, flat3 = T.flat_with_none(cells, 1), T.flat_with_none(cells, 3)
    lower = F.lower(F.col("title"))
    is_product = _any_cell(row0, lambda c: T.cell(c).isin("Product", "Product Name"))
    quantity = F.arrays_overlap(F.split(F.lower(F.array_join(F.transform(row0, lambda c: F.coalesce(c, F.lit(""))), " ")), r"\s+"), F.array(*[F.lit(k) for k in ("strength", "retail", "home", "delivery", "maximum", "quantity", "limit", "limits", "days", "supply", "dosage")]))
    null_first = F.exists(F.slice(cells, 1, 3), lambda r: F.get(r, F.lit(0)).isNull())
    fits = {
        "revision": c0 == "Type of Revision",
        "fda_dosing": lower.contains("fda") & lower.contains("dosing") & null_first,
        "dql": is_product & quantity,
        "availability": (F.coalesce(F.col("tiny_cols"), F.lit(0)) >= 4) & ~_any_cell(row0, lambda c: T.cell(c) == "Product"),
        "criteria": ~is_product & _any_cell(row0, lambda c: T.cell(c) == "Criteria"),
        "hcpcs": T.contains_any(raw0, ["HCPCS", "CPT"]) | T.contains_any(raw1, ["HCPCS", "CPT"]) | raw0.contains("ICD-10"),
        "eua": (c0 == "Date") & raw1.contains("EUA"),
        "fda_rx": flat0.contains("Drug") & flat0.contains("Prescribing"),
        "rev_flex": _any_cell(row0, lambda c: F.coalesce(c, F.lit("")).contains("Summary of Changes")) & (c0 != "Type of Revision"),
        "nonpref": flat0.contains("Exception Criteria") | (flat0.contains("Non-Preferred") & flat0.contains("Criteria")) | flat0.contains("Criteria for Use"),
        "drug_equiv": T.contains_any(flat0, ["Non-Covered Brand", "Bioequivalent"]),
        "medication_moa": flat0.contains("Medication") & flat3.contains("Mode of Administration"),
        "condition_criteria": flat0.contains("Condition") & flat3.contains("Criteria for Use"),
        "known_kw": T.contains_any(flat0, V.KNOWN_KW),
        "titled_generic": titled(F.col("title"), V.TITLED_GENERIC_KW),
        "moa": T.flat(cells, 3).contains("Mechanism of Action") & (c0 == ""),
    }
    found = None
    for name, test in fits.items():
        if but is not None:
            test = test & (but != name)
        found = F.when(test, name) if found is None else found.when(test, name)
    return found.otherwise("catch_all")


def buildable(tables: DataFrame) -> DataFrame:
    """Tables that the builder takes: not spurious, of two rows or more, or one with two cells filled."""
    one = F.size(F.filter(F.get("cells", F.lit(0)), _filled)) >= 2
    return tables.where(~F.col("spurious") & ((F.size("cells") > 1) | ((F.size("cells") == 1) & one)))


#: Handlers whose tables go on over pages: pages (0: any), largest distance on the left, largest top, whether words
#: above or another section end the chain, whether a bold header is needed.
CONTINUES = {
    "dql": (1, None, None, True, True, False),
    "revision": (0, None, None, True, True, False),
    "fda_dosing": (1, 10, 140, True, False, False),
    "titled_generic": (0, 10, 140, True, True, True),
    "known_kw": (0, 10, 140, True, True, True),
    "moa": (0, 10, 120, False, True, False),
    "criteria": (0, 10, 140, False, True, False),
    "rev_flex": (1, None, None, False, False, False),
}


def stitch(tables: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """``tables`` (with handler, segment, bold_header, first_word: the top of the page's first word) with ``consumed``: the pages whose first
    table continues this one, and ``parts``: their cells.

    A chain goes page by page; every condition compares with the first table, and the first page that fails ends it.
    A document's tables are gathered into one row, where the chains are folded: no join of tables with tables. ``words`` give
    first_word where it isn't there.
    """
    if words is not None:
        tables = tables.drop("first_word").join(words.groupBy(*PAGE).agg(F.min("top").alias("first_word")), PAGE, "left")
    fields = [c for c in tables.columns if c not in ("doc_id", "page", "table_idx")]
    held = tables.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("page").cast("int").alias("page"), F.col("table_idx").cast("int").alias("table_idx"), F.struct(*fields).alias("t"))).alias("_tables"))
    held = held.withColumn("_tables", F.array_sort("_tables", lambda a, b: F.when((a["page"] < b["page"]) | ((a["page"] == b["page"]) & (a["table_idx"] < b["table_idx"])), -1).otherwise(1)))
    place = F.transform("_tables", lambda x, i: F.struct(x["page"].alias("page"), x["t"].alias("t"), F.coalesce(F.get("_tables", i - 1)["page"] == x["page"], F.lit(False)).alias("later")))

    def first(x: Column) -> Column:
        t = x["t"]
        row0 = F.get(t["cells"], F.lit(0))
        flat0 = F.array_join(F.filter(row0, lambda c: F.coalesce(c, F.lit("")) != ""), " ")
        other = T.flat(t["cells"], 3).contains("Mechanism of Action") | T.contains_any(flat0, ["HCPCS", "CPT"]) | (_at(row0, 0) == "Product")
        return F.struct(
            x["page"].alias("page"), t["bbox"]["x0"].alias("x0"), t["bbox"]["top"].alias("top"), F.coalesce(F.size(row0), F.lit(0)).alias("cols"), t["segment"].alias("segment"),
            F.coalesce(t["first_word"] < t["bbox"]["top"] - 5, F.lit(False)).alias("words_above"), other.alias("other"), t["cells"].alias("cells"),
        )

    held = held.withColumn("_firsts", F.transform(F.filter(place, lambda x: ~x["later"]), first))
    kind = "struct<next:int,open:boolean,got:array<int>>"

    def test(t: Column, p: Column) -> Column:
        found = F.lit(False)
        for name, (_, dx, top, no_words, same, bold) in CONTINUES.items():
            ok = F.lit(True)
            if dx is not None:
                ok = ok & (F.abs(p["x0"] - t["bbox"]["x0"]) < dx) & (p["top"] < top)
            if no_words:
                ok = ok & ~p["words_above"]
            if same:
                ok = ok & p["segment"].eqNullSafe(t["segment"])
            if bold:
                ok = ok & t["bold_header"]
            if name == "revision":
                ok = ok & (p["cols"] <= 3) & ~p["other"]
            if name == "moa":
                ok = ok & ((p["cols"] == F.size(F.get(t["cells"], F.lit(0)))) | (p["cols"] == 3))
            found = F.when(t["handler"] == name, ok).otherwise(found)
        return found

    def chained(x: Column) -> Column:
        t, limit = x["t"], F.lit(0)
        for name, (pages, *_) in CONTINUES.items():
            limit = F.when(t["handler"] == name, 1_000_000 if pages == 0 else pages).otherwise(limit)
        start = F.struct((x["page"] + 1).cast("int").alias("next"), F.lit(True).alias("open"), F.array().cast("array<int>").alias("got")).cast(kind)

        def step(acc: Column, p: Column) -> Column:
            goes = acc["open"] & (p["page"] == acc["next"]) & (F.size(acc["got"]) < limit) & test(t, p)
            on = F.struct((acc["next"] + 1).cast("int"), F.lit(True), F.concat(acc["got"], F.array(p["page"].cast("int")))).cast(kind)
            return F.when(goes, on).otherwise(F.struct(acc["next"], F.lit(False), acc["got"]).cast(kind))

        later = F.filter("_firsts", lambda p: p["page"] > x["page"])
        return F.struct(x["page"].alias("page"), x["table_idx"].alias("table_idx"), t.alias("t"), F.aggregate(later, start, step)["got"].alias("consumed"))

    rows = held.withColumn("_tables", F.transform("_tables", chained)).select("doc_id", "_firsts", F.explode("_tables").alias("x"))
    parts = F.transform(F.filter("_firsts", lambda p: F.array_contains(F.col("x.consumed"), p["page"])), lambda p: p["cells"])
    return rows.select("doc_id", "x.page", "x.table_idx", "x.t.*", "x.consumed", parts.alias("parts"))


def unconsumed(stitched: DataFrame) -> DataFrame:
    """Tables that continue none before them: the first table of a page in another's ``consumed`` goes.

    A table that is consumed consumes nothing, so chains are taken from the top of the document. The places of a document's
    tables are gathered by a window and folded: the rows stay where they are.
    """
    place = lambda page, idx: F.struct(page.cast("int").alias("page"), idx.cast("int").alias("table_idx"))
    rows = stitched.withColumn("_rows", F.array_sort(F.collect_list(F.struct(F.col("page").cast("int").alias("page"), F.col("table_idx").cast("int").alias("table_idx"), "consumed")).over(Window.partitionBy("doc_id"))))
    start = F.struct(F.array().cast("array<int>").alias("gone"), F.array().cast("array<struct<page:int,table_idx:int>>").alias("kept"), F.lit(0).alias("page")).cast("struct<gone:array<int>,kept:array<struct<page:int,table_idx:int>>,page:int>")

    def step(acc: Column, r: Column) -> Column:
        first = r["page"] != acc["page"]
        stays = ~(first & F.array_contains(acc["gone"], r["page"]))
        gone = F.when(stays, F.concat(acc["gone"], r["consumed"])).otherwise(acc["gone"])
        kept = F.when(stays, F.concat(acc["kept"], F.array(place(r["page"], r["table_idx"])))).otherwise(acc["kept"])
        return F.struct(gone, kept, r["page"]).cast("struct<gone:array<int>,kept:array<struct<page:int,table_idx:int>>,page:int>")

    kept = F.aggregate("_rows", start, step)["kept"]
    return rows.where(F.array_contains(kept, place(F.col("page"), F.col("table_idx")))).drop("_rows")


def backfill_titles(nodes: DataFrame, detected: DataFrame) -> DataFrame:
    """``nodes`` (doc_id, page, top, title) with empty titles filled from the detected table at the same rounded top; the last of several counts."""
    titles = detected.groupBy(*PAGE, F.bround(F.round(F.col("bbox.top"), 1), 0).alias("_top")).agg(F.max_by("title", "table_idx").alias("_title"))
    return nodes.withColumn("_top", F.bround("top", 0)).join(titles, [*PAGE, "_top"], "left").withColumn("title", F.coalesce(F.nullif("title", F.lit("")), "_title", F.lit(""))).drop("_top", "_title")


def nearby_titles(nodes: DataFrame, detected: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """``nodes`` (doc_id, page, top) with the title of the first detected table of the page whose top is less than 5 points away; empty without one."""
    found = detected.select(*PAGE, "table_idx", F.col("bbox.top").alias("_box_top"), "title")
    return first_within(nodes, found, PAGE, "top", "_box_top", tolerance, ["table_idx"], "title", strict=True).withColumn("title", F.coalesce("title", F.lit("")))
