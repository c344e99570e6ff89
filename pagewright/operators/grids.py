"""Cell grids to logical rows: headers, spans, forward fills, matrices, and their HTML.

Operators on whole tables work on the array of rows (``cells``); those that look along rows work on
``grid_rows``, one row of cells each, with windows within a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T

TABLE = ["doc_id", "page", "table_idx"]

# The frame of a rendered table.
TABLE_OPEN = '  <table border="1" bordercolor="#000000" cellpadding="4" cellspacing="0" style="width:100%;font-size:9pt">'
HEAD_ROW = '    <tr style="background:#e8e8e8">'
GROUP_ROW = '    <tr style="background:#e0e0e0">'
TICK, MARK = "√", "✓"
# Kinds of dosage forms as rotated text gives them.
FORM_TYPES = {"tcejniotuA": "Autoinjector", "SFP": "PFS", "laiV": "Vial", "Autoinject": "Autoinjector"}
# Words of multi-row headers.
DQL_HEADER_WORDS = ["product", "strength", "and", "form", "retail", "home", "delivery", "maximum", "quantity", "limit", "limits", "per", "days", "none"]
MOA_HEADER_WORDS = ["biologics", "mechanism", "action", "examples", "indications", "inflammatory", "none", ""]


def grid_rows(tables: DataFrame) -> DataFrame:
    """One row per table row: r and row."""
    return tables.select(*TABLE, F.posexplode("cells").alias("r", "row"))


def _in_table(*order: str):
    return Window.partitionBy(*TABLE).orderBy(*(order or ("r",)))


def _cell(row: Column, i) -> Column:
    return T.cell(F.get(row, F.lit(i) if isinstance(i, int) else i))


def _width(cells: Column) -> Column:
    return F.array_max(F.transform(cells, F.size))


def used_columns(cells: Column) -> tuple[Column, Column]:
    """Header labels in their columns, and the columns to show.

    A label over an empty column goes to the column left of it if that has data and no label. Columns with a label
    are shown; without any, all that have something.
    """
    header, data = F.get(cells, F.lit(0)), F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1)))
    columns = F.sequence(F.lit(0), F.greatest(_width(cells) - 1, F.lit(0)))
    label = lambda i: _cell(header, i)
    has_data = lambda i: F.exists(data, lambda r: _cell(r, i) != "")
    moves = lambda i: (label(i) != "") & ~has_data(i) & (i > 0) & has_data(i - 1) & (label(i - 1) == "")
    labels = F.transform(columns, lambda i: F.when(moves(i), F.lit("")).when(moves(i + 1), label(i + 1)).otherwise(label(i)))
    shown = F.filter(columns, lambda i: F.get(labels, i) != "")
    some = F.filter(columns, lambda i: (label(i) != "") | has_data(i))
    return labels, F.when(F.size(shown) > 0, shown).when(F.size(some) > 0, some).otherwise(columns)


def generic_rows(tables: DataFrame, has_header: Column | bool = True) -> DataFrame:
    """doc_id, page, table_idx, r, kind (header, group, data), values: rows as a generic table shows them.

    A row whose only cell isn't in the first column is a group heading; other rows have their cells moved to the left over
    empty ones and are filled or cut to the number of columns; blank rows go.
    """
    labels, shown = used_columns(F.col("cells"))
    head = F.lit(has_header) if isinstance(has_header, bool) else has_header
    t = tables.withColumn("_labels", labels).withColumn("_shown", shown).withColumn("_head", head)
    rows = t.select(*TABLE, "_labels", "_shown", "_head", F.posexplode("cells").alias("r", "row"))
    filled = F.filter(F.transform("row", T.cell), lambda c: c != "")
    is_head = F.col("_head") & (F.col("r") == 0)
    group = (F.size(filled) == 1) & (F.size("row") > 1) & (_cell(F.col("row"), 0) == "")
    width = F.size("_shown")
    padded = F.slice(F.concat(filled, F.array_repeat(F.lit(""), width)), F.lit(1), width)
    values = F.when(is_head, F.transform("_shown", lambda i: F.get("_labels", i))).when(group, filled).otherwise(padded)
    kind = F.when(is_head, "header").when(group, "group").otherwise("data")
    return rows.where(is_head | (F.size(filled) > 0)).select(*TABLE, "r", kind.alias("kind"), values.alias("values"), width.alias("n_cols"))


def render_generic(rows: DataFrame) -> DataFrame:
    """doc_id, page, table_idx, html of ``generic_rows``."""
    td = lambda v: F.concat(F.lit('     <td style="vertical-align:top">'), T.break_cell(v), F.lit("</td>"))
    th = lambda v: F.concat(F.lit("     <th>"), T.break_cell(v), F.lit("</th>"))
    line = (
        F.when(F.col("kind") == "header", F.concat(F.lit(f"   <thead>\n{HEAD_ROW}\n"), F.array_join(F.transform("values", th), "\n"), F.lit("\n    </tr>\n   </thead>\n   <tbody>")))
        .when(F.col("kind") == "group", F.concat(F.lit(GROUP_ROW + '<td colspan="'), F.col("n_cols").cast("string"), F.lit('" style="font-weight:bold">'), T.break_cell(F.get("values", F.lit(0))), F.lit("</td></tr>")))
        .otherwise(F.concat(F.lit("    <tr>\n"), F.array_join(F.transform("values", td), "\n"), F.lit("\n    </tr>")))
    )
    g = rows.withColumn("_line", line).groupBy(*TABLE).agg(F.array_sort(F.collect_list(F.struct("r", "_line"))).alias("_lines"), F.max(F.col("kind") == "header").alias("_head"))
    body = F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n")
    start = F.when(F.col("_head"), F.lit(TABLE_OPEN + "\n")).otherwise(F.lit(TABLE_OPEN + "\n   <tbody>\n"))
    return g.select(*TABLE, F.concat(start, body, F.lit("\n   </tbody>\n  </table>")).alias("html"))


def collapse_header(tables: DataFrame, header_words: list[str] = DQL_HEADER_WORDS) -> DataFrame:
    """doc_id, page, table_idx, data_start, header: rows before the first whose first cell has a word that is none of a header's, joined by column."""
    words = F.split(F.lower(_cell(F.col("row"), 0)), r"\s+")
    is_data = (_cell(F.col("row"), 0) != "") & F.exists(words, lambda w: ~w.isin(header_words))
    starts = grid_rows(tables).where(is_data).groupBy(*TABLE).agg(F.min("r").alias("data_start"))
    t = tables.join(starts, TABLE, "left").withColumn("data_start", F.coalesce("data_start", F.lit(1)))
    columns = F.sequence(F.lit(0), F.greatest(_width(F.col("cells")) - 1, F.lit(0)))
    head = F.slice("cells", F.lit(1), F.col("data_start"))
    label = lambda i: F.array_join(F.filter(F.transform(head, lambda r: _cell(r, i)), lambda c: c != ""), " ")
    return t.select(*TABLE, "data_start", F.transform(columns, label).alias("header"))


def rowspans(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rowspan``: rows with an empty first cell extend the one above (0); before the first filled one they span nothing."""
    filled = _cell(F.col("row"), 0) != ""
    r = rows.withColumn("_span", F.sum(F.when(filled, 1).otherwise(0)).over(_in_table().rowsBetween(Window.unboundedPreceding, 0)))
    size = F.count("*").over(Window.partitionBy(*TABLE, "_span"))
    return r.withColumn("rowspan", F.when(filled, size).otherwise(0).cast("int")).drop("_span")


def dql_layout(tables: DataFrame) -> DataFrame:
    """doc_id, page, table_idx and the fixed places of a one-product quantity table, rows 2 to 4: product, strengths and quantities, those filled; the second quantity is a copy of the first."""
    at = lambda r, c: T.one_line_cell(F.get(F.get("cells", F.lit(r)), F.lit(c)))
    some = lambda *xs: F.filter(F.array(*xs), lambda x: x != "")
    return tables.select(*TABLE, at(2, 0).alias("product"), some(at(2, 1), at(3, 1), at(4, 1)).alias("strengths"), some(at(2, 2), at(2, 2), at(4, 2)).alias("quantities"))


def revision_rows(rows: DataFrame) -> DataFrame:
    """doc_id, page, table_idx, r, c0, c1, c2 of rows with anything in them; an empty type is that of the row above."""
    c = lambda i: T.one_line_cell(F.get("row", F.lit(i)))
    kept = rows.select(*TABLE, "r", c(0).alias("c0"), c(1).alias("c1"), c(2).alias("c2")).where("r > 0 and (c0 != '' or c1 != '' or c2 != '')")
    carried = F.last(F.nullif("c0", F.lit("")), ignorenulls=True).over(_in_table().rowsBetween(Window.unboundedPreceding, 0))
    return kept.withColumn("c0", F.coalesce(carried, F.lit("")))


def merge_wrapped(rows: DataFrame) -> DataFrame:
    """Rows c0, c1, c2 by (part, r): the first row of a later part with only c1 goes to the end of the row before."""
    order = Window.partitionBy(*TABLE).orderBy("part", "r")
    first = F.row_number().over(Window.partitionBy(*TABLE, "part").orderBy("r")) == 1
    wraps = first & (F.col("part") > 0) & (F.col("c0") == "") & (F.col("c2") == "") & (F.col("c1") != "") & (F.row_number().over(order) > 1)
    r = rows.withColumn("_wraps", wraps)
    r = r.withColumn("_row", F.sum(F.when(F.col("_wraps"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    held = r.groupBy(*TABLE, "_row").agg(F.array_sort(F.collect_list(F.struct("part", "r", "c0", "c1", "c2"))).alias("_rows"))
    head = F.get("_rows", F.lit(0))
    return held.select(*TABLE, head["part"].alias("part"), head["r"].alias("r"), head["c0"].alias("c0"), T.strip(F.array_join(F.transform("_rows", lambda x: x["c1"]), " ")).alias("c1"), head["c2"].alias("c2"))


def availability(tables: DataFrame) -> DataFrame:
    """doc_id, page, table_idx, r, type, dosage, drug, mark: the tick matrix as long rows, a row per form and drug.

    Names read backwards in the first two rows; one that ends in a hyphen takes the next column's. A name's ticks stand one
    column left of it. Rows without a dosage go; an empty type is that of the row above.
    """
    names = (
        tables.select(*TABLE, F.posexplode(F.slice("cells", 1, 2)).alias("r", "row")).select(*TABLE, "r", F.posexplode("row").alias("c", "v"))
        .where(F.col("v").isNotNull() & T.is_reversed_name(F.col("v"))).groupBy(*TABLE, "c")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", T.reverse_cell(F.col("v")).alias("n")))), lambda s: s["n"]), "").alias("name"))
    )
    # of a run of adjacent names with hyphens every second one is taken by the one before
    along = Window.partitionBy(*TABLE).orderBy("c")
    linked = names.withColumn("_links", (F.lag("c").over(along) == F.col("c") - 1) & F.lag("name").over(along).endswith("-"))
    linked = linked.withColumn("_run", F.sum(F.when(F.coalesce(F.col("_links"), F.lit(False)), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    linked = linked.withColumn("_k", F.row_number().over(Window.partitionBy(*TABLE, "_run").orderBy("c")))
    taken = linked.withColumn("_next", F.lead(F.struct("name", "_run")).over(along))
    merged = taken.where("_k % 2 = 1").withColumn("drug", F.when(F.col("name").endswith("-") & (F.col("_next._run") == F.col("_run")), F.concat("name", "_next.name")).otherwise(F.col("name")))
    cells = grid_rows(tables).where("r >= 2").select(*TABLE, "r", F.posexplode("row").alias("c", "v"))
    ticks = cells.where(T.cell(F.col("v")) == TICK)
    columns = merged.join(ticks.select(*TABLE, F.col("c").alias("_t")).distinct(), TABLE).where("_t = c - 1").select(*TABLE, F.col("_t").alias("tick_col"), "drug")
    types = F.create_map(*[F.lit(x) for kv in FORM_TYPES.items() for x in kv])
    raw, back = _cell(F.col("row"), 0), T.reverse_cell(F.get("row", F.lit(0)))
    kind = F.nullif(F.coalesce(F.try_element_at(types, raw), F.try_element_at(types, back), back), F.lit(""))
    forms = grid_rows(tables).where("r >= 2").withColumn("type", F.coalesce(F.last(kind, ignorenulls=True).over(_in_table().rowsBetween(Window.unboundedPreceding, 0)), F.lit("")))
    forms = forms.withColumn("dosage", T.one_line_cell(F.get("row", F.lit(1)))).where("dosage != ''").select(*TABLE, "r", "type", "dosage")
    grid = forms.join(columns, TABLE)
    hits = ticks.select(*TABLE, "r", F.col("c").alias("tick_col"), F.lit(MARK).alias("mark"))
    return grid.join(hits, [*TABLE, "r", "tick_col"], "left").groupBy(*TABLE, "r", "type", "dosage", "drug").agg(F.coalesce(F.max("mark"), F.lit("")).alias("mark"))


def moa_rows(tables: DataFrame) -> DataFrame:
    """doc_id, page, table_idx, r, kind (heading, data), values (3) of a mechanism-of-action table.

    Data begin after the header, with the group headings right above. A row with one cell in the first two columns
    and none in the first is a heading; other rows without a first cell go to the last cell of the row above, after
    a line break (dropped under a heading).
    """
    r = grid_rows(tables)
    filled = F.filter(F.transform("row", lambda c: T.one_line_cell(c)), lambda c: c != "")
    low = F.exists(F.slice("row", 1, 2), lambda c: T.cell(c) != "")
    r = r.withColumn("_cells", filled).withColumn("_first", _cell(F.col("row"), 0))
    r = r.withColumn("_heading", (F.col("_first") == "") & (F.size("_cells") == 1) & low)
    begins = (F.col("r") >= 1) & (F.col("_first") != "") & ~F.lower("_first").isin(MOA_HEADER_WORDS)
    is_header = T.flat_with_none(F.col("cells"), 3).contains("Mechanism of Action")
    starts = r.where(begins).groupBy(*TABLE).agg(F.min("r").alias("_begin"))
    heads = tables.select(*TABLE, is_header.alias("_has_header")).join(starts, TABLE, "left").withColumn("_begin", F.when(F.col("_has_header"), F.coalesce("_begin", F.lit(3))).otherwise(0))
    r = r.join(heads, TABLE)
    # headings right above the first data row belong to the data
    breaks = F.max(F.when((F.col("r") < F.col("_begin")) & (~F.col("_heading") | (F.col("r") < 1)), F.col("r"))).over(Window.partitionBy(*TABLE))
    r = r.withColumn("_start", F.when(F.col("_has_header"), F.coalesce(breaks + 1, F.lit(0))).otherwise(0)).where("r >= _start and size(_cells) > 0")
    anchors = F.when(F.col("_heading") | (F.col("_first") != ""), 1).otherwise(0)
    r = r.withColumn("_own", F.sum(anchors).over(_in_table().rowsBetween(Window.unboundedPreceding, 0)))
    held = r.groupBy(*TABLE, "_own").agg(F.array_sort(F.collect_list(F.struct("r", "_heading", "_cells"))).alias("_rows"))
    head = F.get("_rows", F.lit(0))
    three = F.slice(F.concat(head["_cells"], F.array_repeat(F.lit(""), 3)), 1, 3)
    wraps = F.transform(F.slice("_rows", F.lit(2), F.size("_rows")), lambda x: F.array_join(x["_cells"], " "))
    last = F.array_join(F.filter(F.concat(F.array(F.get(three, F.lit(2))), wraps), lambda c: c != ""), "<br>")
    values = F.when(head["_heading"], F.slice(head["_cells"], 1, 1)).otherwise(F.concat(F.slice(three, 1, 2), F.array(last)))

    return held.select(*TABLE, head["r"].alias("r"), F.when(head["_heading"], "heading").otherwise("data").alias("kind"), values.alias("values"))


def subrow_parents(rows: DataFrame) -> DataFrame:
    """Rows (r, top, starts_at: its first filled column, dose_col) with ``parent``: a row that begins in the dosing column belongs to the nearest full row above; the parent's ``clip`` is its first sub-row's top."""
    full = F.col("starts_at") < F.col("dose_col")
    r = rows.withColumn("parent", F.last(F.when(full, F.col("r")), ignorenulls=True).over(_in_table().rowsBetween(Window.unboundedPreceding, 0)))
    clip = F.min(F.when(~full, F.col("top"))).over(Window.partitionBy(*TABLE, "parent"))
    return r.withColumn("clip", F.when(full, clip))


def chars_in_box(chars: DataFrame, boxes: DataFrame, slack: float = 2.0) -> DataFrame:
    """``chars`` that begin within a box of their page (doc_id, page, x0, top, x1, bottom), with 2 points to spare."""
    held = boxes.groupBy("doc_id", "page").agg(F.collect_list(F.struct("x0", "top", "x1", "bottom")).alias("_boxes"))
    hit = F.exists("_boxes", lambda b: F.col("x0").between(b["x0"] - slack, b["x1"] + slack) & F.col("top").between(b["top"] - slack, b["bottom"] + slack))
    return chars.join(held, ["doc_id", "page"]).where(hit).drop("_boxes")


def assemble_chars(chars: DataFrame, rules: DataFrame) -> DataFrame:
    """doc_id, page, text: characters in lines of two points, underlined runs in <u>, a break before bullets.

    ``rules`` are thin rectangles (x0, x1, top); a character is underlined if one lies within 4 points under it.
    """
    held = rules.groupBy("doc_id", "page").agg(F.collect_list(F.struct("x0", "x1", "top")).alias("_rules"))
    under = F.exists("_rules", lambda u: (u["x0"] <= F.col("x0") + 1) & (u["x1"] >= F.col("x1") - 1) & (F.abs(u["top"] - F.col("bottom")) <= 4))
    c = chars.withColumn("line", T.quantize(F.col("top"), 2)).join(held, ["doc_id", "page"], "left").withColumn("_u", F.coalesce(under, F.lit(False)))
    along = Window.partitionBy("doc_id", "page", "line").orderBy("x0", "char_idx")
    c = c.withColumn("_run", F.sum(F.when(F.col("_u") == F.lag("_u").over(along), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    runs = c.groupBy("doc_id", "page", "line", "_run", "_u").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "char_idx", "text"))), lambda s: s["text"]), "").alias("t"))
    marked = F.when(F.col("_u"), F.concat(F.lit("<u>"), T.escape_html(F.col("t")), F.lit("</u>"))).otherwise(T.escape_html(F.col("t")))
    lines = runs.withColumn("m", marked).groupBy("doc_id", "page", "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_run", "m"))), lambda s: s["m"]), "").alias("m"))
    glue = lambda acc, s: F.when(acc == "", s["m"]).when(s["m"].startswith("•"), F.concat(acc, F.lit("<br>"), s["m"])).otherwise(F.concat(acc, F.lit(" "), s["m"]))
    return lines.groupBy("doc_id", "page").agg(F.aggregate(F.array_sort(F.collect_list(F.struct("line", "m"))), F.lit(""), glue).alias("text"))


def dosing_labels(tables: DataFrame) -> DataFrame:
    """doc_id, page, table_idx, first_label, last_label of a dosing table's header: the first and the last filled cells."""
    filled = F.filter(F.transform(F.get("cells", F.lit(0)), T.one_line_cell), lambda c: c != "")
    return tables.select(*TABLE, F.coalesce(F.get(filled, F.lit(0)), F.lit("")).alias("first_label"), F.coalesce(F.try_element_at(filled, F.lit(-1)), F.lit("")).alias("last_label"))
