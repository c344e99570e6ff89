"""Words to lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions.vocabulary import BULLET_CHARS, FOOTER_TOP, SECTION_VOCAB

from .relational import inside_any

GRID = 4
#: Parts of the names of fonts that list markers are set in.
MARKER_FONTS = ["SymbolMT", "Wingdings", "Courier"]


def _word(text: Column, x0: Column, word_idx: Column, size: Column, font: Column) -> Column:
    """What a line needs of a word."""
    large = F.coalesce(size >= 8, F.lit(False))
    length = F.when(large, F.coalesce(F.char_length(text), F.lit(0))).otherwise(-1)
    piece = F.when(large, F.concat(F.lit(" "), text)).otherwise(text)
    return F.struct(x0.alias("x0"), word_idx.alias("word_idx"), piece.alias("piece"), length.alias("n"), size.alias("size"), font.alias("fontname"))


def _span(of) -> Column:
    """What a line needs of a span: its place, its text, and font and size if they are large."""
    large = F.coalesce(of("size") >= 8, F.lit(False))
    piece = F.when(large, F.concat(F.lit(" "), F.array_join("texts", " "))).otherwise(F.array_join("texts", ""))
    look = F.when(large, F.struct(of("size").alias("size"), of("fontname").alias("fontname")))
    return F.struct(F.get("xs", F.lit(0)).alias("x0"), "word_idx", F.try_element_at("xs", F.lit(-1)).alias("last"), piece.alias("piece"), look.alias("look"), "xs", "texts", "size", "fontname")


def _is_plain(spans: Column) -> Column:
    """Whether the spans of a line follow one another, begin with a word of 8 points or more and have one font and size but for smaller words: there are no words to go through then."""
    first = F.get(spans, F.lit(0))
    meet = F.exists(F.sequence(F.lit(1), F.size(spans) - 1), lambda i: F.get(spans, i)["x0"] <= F.get(spans, i - 1)["last"])
    apart = F.when(F.size(spans) == 1, F.lit(True)).otherwise((F.array_min(spans["look"]) == F.array_max(spans["look"])) & ~meet)
    return F.coalesce(first["look"].isNotNull() & (F.get(first["texts"], F.lit(0)) != "") & apart, F.lit(False))


def _words_of(spans: Column) -> Column:
    return F.flatten(F.transform(spans, lambda s: F.transform(s["texts"], lambda t, i: _word(t, F.get(s["xs"], i), s["word_idx"] + i, s["size"], s["fontname"]))))


def raw_lines(words: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """Words of a page on a grid of 4 points, as lines from left to right.

    A word below 8 points is glued to the word before it and dropped where it comes first. Font and size are
    those of the longest word of 8 points or more (the leftmost of equals), else of the first. Footers are dropped.
    ``words`` are a row each, or come in spans: words of one top, font and size from left to right, with doc_id, page, top, word_idx (of the first), size,
    fontname, texts and xs (arrays). Spans of a line that don't follow one another are put together word by word.
    ``boxes`` (doc_id, page, box_top, box_bottom) mark lines within tables. One shuffle by (doc_id, page, top).
    """
    # structs and orders are worked out in generated code: no function is called for a word that is a row, but where a line begins with a small one
    in_spans = "texts" in words.columns
    word = _span(F.col) if in_spans else _word(*map(F.col, ("text", "x0", "word_idx", "size", "fontname")))
    held = (
        words.select("doc_id", "page", T.quantize(F.col("top"), GRID).cast("int").alias("top"), word.alias("w"))
        .where(F.col("top") <= FOOTER_TOP)
        .groupBy("doc_id", "page", "top")
        .agg(F.sort_array(F.collect_list("w")).alias("ws"))
    )
    first = F.get("ws", F.lit(0))
    glue = lambda acc, w: F.when((acc != "") | (w["n"] > 0), F.concat(acc, w["piece"])).otherwise(acc)
    # the first of the longest; without a large word all are alike, so the first
    dominant = F.get("ws", F.array_position("ws.n", F.array_max("ws.n")).cast("int") - 1)
    dominant = F.struct(dominant["size"].alias("size"), dominant["fontname"].alias("fontname"))
    text = F.substr(F.array_join("ws.piece", ""), F.lit(2))
    late = F.aggregate("ws", F.lit(""), glue)
    x0 = first["x0"]
    if in_spans:
        held = held.withColumnRenamed("ws", "_spans").withColumn("_plain", _is_plain(F.col("_spans")))
        held = held.withColumn("ws", F.when(~F.col("_plain"), F.sort_array(_words_of(F.col("_spans")))))
        one = F.get("_spans", F.lit(0))
        plain = F.substr(F.array_join("_spans.piece", ""), F.lit(2))
        # a text that isn't put together here is there already
        held = held.select("doc_id", "page", "top", F.when(F.col("_plain"), one["x0"]).otherwise(x0).alias("x0"), F.when(F.col("_plain"), one["look"]).otherwise(dominant).alias("d"), F.when(F.col("_plain"), plain).when(first["n"] > 0, text).otherwise(late).alias("_late"))
        text = F.col("_late")
    else:
        held = held.select("doc_id", "page", "top", "ws", F.when(first["n"] <= 0, late).alias("_late"), x0.alias("x0"), dominant.alias("d"))
        text = F.coalesce("_late", text)
    # from an array of one, a text is worked out once a line; a filter would be moved before it, with the text put together anew for every test
    lines = (
        held.select("doc_id", "page", "top", "x0", "d", F.explode(F.array(text)).alias("_text"))
        .select("doc_id", "page", "top", "x0", F.explode(F.array(T.clean(F.col("_text")))).alias("text"), "d.size", "d.fontname")
        .where((F.col("text") != "") & ~T.is_footer(F.col("top"), F.col("text")))
        .withColumn("bold", T.is_bold(F.col("fontname")))
        .withColumn("italic", T.is_italic(F.col("fontname")))
    )
    if boxes is None:
        return lines.withColumn("in_table", F.lit(False))
    return inside_any(lines, boxes, ["doc_id", "page"], "top", "box_top", "box_bottom", "in_table")


def merge_split_headings(lines: DataFrame) -> DataFrame:
    """A short bold line in capitals and the next line, at most 8 points on, that make a section heading together become one line of size 14."""
    order = Window.partitionBy("doc_id").orderBy("page", "top")
    norm = T.normalize_split_heading(F.concat("text", F.lead("text").over(order)))
    merges = (
        F.col("bold") & (F.col("size") >= 8) & (F.char_length("text") <= 3) & T.is_upper(F.col("text"))
        & (F.abs(F.lead("top").over(order) - F.col("top")) <= 8) & norm.isin(SECTION_VOCAB)
    )
    flagged = lines.withColumn("_norm", norm).withColumn("_merges", F.coalesce(merges, F.lit(False)))
    gone = F.coalesce(F.lag("_merges").over(order), F.lit(False))
    return (
        flagged.withColumn("_gone", gone).where(~F.col("_gone"))
        .withColumn("text", F.when(F.col("_merges"), F.initcap("_norm")).otherwise(F.col("text")))
        .withColumn("size", F.when(F.col("_merges"), 14.0).otherwise(F.col("size")))
        .drop("_norm", "_merges", "_gone")
    )


def marker(font: Column, text: Column) -> Column:
    """Kind of list marker a word is; null if none."""
    bare = F.trim(text)
    glyph = bare.isin(BULLET_CHARS) | bare.rlike("[\\uf0b7\\uf0a7\\u2022\\u2023]")
    return (
        F.when(font.contains("Wingdings"), "sub_sub_bullet")
        .when(font.contains("Courier") & (bare == "o"), "sub_bullet")
        .when(font.contains("SymbolMT") & glyph, "bullet")
        .when(bare.startswith("•"), "bullet")
    )


def paragraph_lines(words: DataFrame, line: str = "line_key") -> DataFrame:
    """Words already dealt to lines (``line``) as paragraph lines with list markers.

    Words below 6 points don't count. The last marker of a line gives its kind; a bullet that is stuck to a word
    leaves the rest of it 10 points further right.
    """
    kind = marker(F.col("fontname"), F.col("text"))
    bare = F.trim("text")
    stuck = bare.startswith("•") & ~F.col("fontname").contains("Wingdings") & ~(F.col("fontname").contains("Courier") & (bare == "o")) & ~(F.col("fontname").contains("SymbolMT"))
    rest = F.regexp_replace(bare, "^[• ]+", "")
    keys = [c for c in ("doc_id", "page", line) if c in words.columns]
    tagged = (
        words.where(F.col("size") >= 6).withColumn("_kind", kind)
        .withColumn("_text", F.when(F.col("_kind").isNull(), F.col("text")).when(stuck & (rest != ""), rest))
        .withColumn("_x0", F.when(F.col("_kind").isNull(), F.col("x0")).otherwise(F.col("x0") + 10))
    )
    at = F.struct("x0", "word_idx")
    texts = F.filter("ws", lambda w: w["_text"].isNotNull())
    lines = tagged.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("x0", "word_idx", "_text", "_x0", "size", "fontname"))).alias("ws"),
        F.max_by("_kind", F.when(F.col("_kind").isNotNull(), at)).alias("marker_type"),
        F.max_by(F.struct("size", "fontname"), F.when(F.col("_text").isNotNull(), F.struct(F.char_length("_text").alias("n"), (-F.col("x0")).alias("x"), (-F.col("word_idx")).alias("i")))).alias("longest"),
    )
    first = F.get("ws", F.lit(0))
    dominant = F.coalesce("longest", F.struct(first["size"].alias("size"), first["fontname"].alias("fontname")))
    x0 = F.coalesce(F.get(texts, F.lit(0))["_x0"], F.get("ws", F.lit(1))["x0"], first["x0"])
    return (
        # as in raw_lines, the text is worked out once, not for its test as well
        lines.withColumn("text", F.explode(F.filter(F.array(T.squeeze(F.array_join(F.transform(texts, lambda w: w["_text"]), " "))), lambda t: (t != "") | F.col("marker_type").isNotNull())))
        .withColumn("x0", x0).withColumn("_d", dominant)
        .select(*keys, "x0", "text", F.col("_d.size").alias("size"), F.col("_d.fontname").alias("fontname"), T.is_bold(F.col("_d.fontname")).alias("bold"), T.is_italic(F.col("_d.fontname")).alias("italic"), "marker_type")
    )


def underline(lines: DataFrame, rects: DataFrame) -> DataFrame:
    """``lines`` with a flag: a thin wide rectangle at the foot of the line, and no gray fill behind it."""
    held = rects.groupBy("doc_id", "page").agg(F.collect_list(F.struct("x0", "x1", "top", "bottom", T.is_gray(F.col("fill"), F.col("color")).alias("gray"))).alias("_rects"))
    foot = F.col("top") + F.col("size")
    gray = F.exists("_rects", lambda r: r["gray"] & (r["top"] <= foot + 2) & (r["bottom"] >= F.col("top") - 2))
    rule = F.exists("_rects", lambda r: (r["bottom"] - r["top"] < 2) & (r["x1"] - r["x0"] > 50) & (r["x0"] <= F.col("x0") + 5) & (r["top"] - foot).between(-4, 6))
    return lines.join(held, ["doc_id", "page"], "left").withColumn("underline", F.coalesce(~gray & rule, F.lit(False))).drop("_rects")


def _opened(tops: Column, near: float) -> Column:
    """Of the distinct tops of a page, in the order of its words, those that open a bucket."""
    return F.aggregate(tops, F.array().cast("array<double>"), lambda acc, t: F.when(F.exists(acc, lambda k: F.abs(k - t) <= near), acc).otherwise(F.concat(acc, F.array(t))))


_LONE = "struct<text:string,font:string,to:double,forward:boolean>"


def _moves(buckets: Column) -> Column:
    """For each bucket (key, n, text, font: of its words of 6 points or more) in order of the page, the key it moves to, or null.

    A bucket of a single capital goes to the next bucket within 8 points, else to the one before if that stays. What moved here from the bucket before counts.
    """

    def step(acc: Column, i: Column) -> Column:
        b, last = F.get(buckets, i), F.try_element_at(acc, F.lit(-1))
        came = F.coalesce(last["forward"], F.lit(False))
        text, font = F.when(b["n"] == 0, last["text"]).otherwise(b["text"]), F.when(b["n"] == 0, last["font"]).otherwise(b["font"])
        alone = (b["n"] + came.cast("int") == 1) & (F.char_length(text) == 1) & T.is_upper(text) & ~T.contains_any(font, MARKER_FONTS)
        after, before = F.get(buckets, i + 1)["key"], F.get(buckets, i - 1)["key"]
        forward = F.coalesce(alone & (F.abs(after - b["key"]) <= 8), F.lit(False))
        back = F.coalesce(alone & ~forward & (F.abs(before - b["key"]) <= 8) & last["to"].isNull(), F.lit(False))
        move = F.struct(text.alias("text"), font.alias("font"), F.when(forward, after).when(back, before).alias("to"), forward.alias("forward")).cast(_LONE)
        return F.concat(acc, F.array(move))

    places = F.filter(F.sequence(F.lit(0), F.size(buckets)), lambda i: i < F.size(buckets))
    return F.transform(F.aggregate(places, F.array().cast(f"array<{_LONE}>"), step), lambda m: m["to"])


def greedy_buckets(words: DataFrame, low: float = 0.0, high: float = 9999.0, near: float = 2.0) -> DataFrame:
    """``words`` with ``line_key``: each joins the first bucket opened on its page within 2 points, else opens one.

    The order of words decides, so the tops of a page are folded in their order, as one array; a lone capital then joins the
    next bucket within 8 points, else the previous one. One shuffle by page.
    """
    columns = words.columns
    word = F.struct("word_idx", *[c for c in columns if c not in ("doc_id", "page", "word_idx")])
    held = words.where(F.col("top").between(low, high)).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(word)).alias("_ws"))
    # what holds for a top is worked out for the distinct tops of the page; a word keeps the place of its own
    held = held.withColumn("_tops", F.array_distinct(F.transform("_ws", lambda w: w["top"].cast("double"))))
    held = held.withColumn("_opened", _opened(F.col("_tops"), near))
    held = held.withColumn("_keys", F.transform("_tops", lambda t: F.get(F.filter("_opened", lambda k: F.abs(k - t) <= near), F.lit(0))))
    held = held.withColumn("_ws", F.transform("_ws", lambda w: F.struct(w.alias("w"), (F.array_position("_tops", w["top"].cast("double")) - 1).cast("int").alias("at"))))
    held = held.withColumn("_large", F.filter("_ws", lambda x: x["w"]["size"] >= 6))
    held = held.withColumn("_large_keys", F.transform("_large", lambda x: F.get("_keys", x["at"])))

    def bucket(k: Column) -> Column:
        first = F.get("_large", (F.array_position("_large_keys", k) - 1).cast("int"))["w"]
        return F.struct(k.alias("key"), (F.size("_large_keys") - F.size(F.array_remove("_large_keys", k))).alias("n"), T.strip(first["text"]).alias("text"), first["fontname"].alias("font"))

    held = held.withColumn("_order", F.array_sort("_opened")).withColumn("_buckets", F.transform("_order", bucket))
    # an array of one: the moves of a page are worked out once, not for every top
    goes = lambda to: F.transform("_keys", lambda k: F.struct(k.alias("key"), F.get(to, (F.array_position("_order", k) - 1).cast("int")).alias("to")))
    held = held.withColumn("_goes", F.get(F.transform(F.array(_moves(F.col("_buckets"))), goes), F.lit(0)))
    rows = held.select("doc_id", "page", F.explode(F.transform("_ws", lambda x: F.struct(x["w"].alias("w"), F.get("_goes", x["at"])["key"].alias("key"), F.get("_goes", x["at"])["to"].alias("to")))).alias("x"))
    kept = rows.where(~((F.col("x.w.size") < 6) & F.col("x.to").isNotNull()))
    return kept.select("doc_id", "page", "x.w.*", F.coalesce("x.to", "x.key").alias("line_key")).select(*columns, "line_key")
