"""Sections of a document: headings, boundaries, and the section of every line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions import vocabulary as V

from .relational import asof_last, islands, joined


def _titles(vocab: list[str]) -> dict[str, str]:
    return {v: v.title() for v in vocab}


def _lookup(key: Column, table: dict[str, str]) -> Column:
    entries = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*entries), key)


def section_of(text: Column, bold: Column, size: Column, x0: Column, vocab: list[str] = V.SECTION_VOCAB, norm: Column | None = None) -> Column:
    """The section that a line is the heading of; null if none. ``norm``: the normalised heading, if it is worked out already."""
    norm = T.normalize_heading(text) if norm is None else norm
    titles = _titles(vocab)
    bare: dict[str, str] = {}
    for v in vocab:
        bare.setdefault(v.replace(" ", ""), v.title())
    in_vocab = norm.isin(list(vocab))
    caps = T.is_upper(F.replace(text, F.lit(" "), F.lit("")))
    return (
        F.when(~bold, F.lit(None).cast("string"))
        .when((size >= 10.5) & in_vocab, _lookup(norm, titles))
        .when((size >= 10.5) & norm.startswith("coverage policy"), F.lit("Coverage Policy"))
        .when((size >= 9.5) & (x0 < 70) & in_vocab, _lookup(norm, titles))
        .when((size >= 7.5) & caps, _lookup(F.replace(norm, F.lit(" "), F.lit("")), bare))
    )


def _may_head(text: Column, vocab: list[str]) -> Column:
    """False for texts that ``section_of`` gives nothing for, whatever their case: longer than any entry, and of another first letter than the one that is told by its beginning."""
    bare = F.replace(text, F.lit(" "), F.lit(""))
    return (F.char_length(bare) <= max(len(v.replace(" ", "")) for v in vocab)) | F.substring(bare, 1, 1).isin("C", "c")


def marked(lines: DataFrame, vocab: list[str] = V.SECTION_VOCAB) -> DataFrame:
    """``lines`` with ``_mark``: the section that begins at the line; null at the others.

    The first bullet of page 1 before the instructions begins ``applicable_products``; the first bold instructions line
    begins ``ifu``; other section headings begin theirs, an appendix only after revision details. Footers begin nothing.
    All windows share one partitioning and order. Headings are normalised for bold lines alone.
    """
    before = Window.partitionBy("doc_id").orderBy("page", "top").rowsBetween(Window.unboundedPreceding, -1)
    named = lambda words: F.col("text").rlike(f"(?i){words}")
    # a condition of a case, as what follows an "and" is worked out beforehand where it is used twice
    if_bold = lambda value, other: F.when(F.coalesce("bold", F.lit(True)), value).otherwise(other)
    is_ifu = if_bold(F.col("bold") & (named("instructions for use") | ((F.col("size") <= 11) & named("following coverage policy"))), F.lit(False))
    bullet = (F.col("page") == 1) & F.col("text").contains("•") & T.strip(F.col("text")).startswith("•")
    live = lines.withColumn("_live", ~T.is_footer(F.col("top"), F.col("text"))).withColumn("_norm", if_bold(F.when(_may_head(F.col("text"), vocab), T.normalize_heading(F.col("text"))), F.lit(None)))
    live = live.withColumn("_ifu", F.col("_live") & is_ifu).withColumn("_bullet", F.col("_live") & bullet)
    # one window for what comes before: instructions, bullets, and whether the first line of either kind is both
    first = F.first(F.when(F.col("_ifu") | F.col("_bullet"), F.coalesce(F.col("_ifu") & F.col("_bullet"), F.lit(False))), ignorenulls=True)
    live = live.select("*", F.count_if("_ifu").over(before).alias("_ifus"), F.coalesce(F.max("_bullet").over(before), F.lit(False)).alias("_seen_bullet"), F.coalesce(first.over(before), F.lit(False)).alias("_both"))
    live = live.withColumn("_product", F.col("_bullet") & ~F.col("_seen_bullet") & (F.col("_ifus") == 0))
    # a line that is the first product line is nothing else
    live = live.withColumn("_ifu", F.col("_ifu") & ~F.col("_product")).withColumn("_seen_ifu", F.col("_ifus") - F.col("_both").cast("int") > 0)
    section = section_of(F.col("text"), F.col("bold"), F.col("size"), F.col("x0"), vocab, F.col("_norm"))
    live = live.withColumn("_sec", F.when(F.col("_live") & ~F.col("_product") & ~(F.col("_ifu") & ~F.col("_seen_ifu")), section))
    live = live.withColumn("_revised", F.coalesce(F.max(F.coalesce(F.lower("_sec") == "revision details", F.lit(False))).over(before), F.lit(False)))
    mark = (
        F.when(F.col("_product"), "applicable_products")
        .when(F.col("_ifu") & ~F.col("_seen_ifu"), "ifu")
        .when((F.lower("_sec") == "appendix") & ~F.col("_revised"), F.lit(None).cast("string"))
        .otherwise(F.col("_sec"))
    )
    return live.withColumn("_mark", mark).drop("_live", "_norm", "_ifu", "_bullet", "_ifus", "_seen_bullet", "_both", "_seen_ifu", "_product", "_sec", "_revised")


def boundaries(lines: DataFrame, footers: DataFrame | None = None, vocab: list[str] = V.SECTION_VOCAB) -> DataFrame:
    """doc_id, segment, page, top, seq: where each section begins (``marked``).

    A document with any gets ``header`` at its start; ``footers`` (doc_id, page, top) add ``footer``.
    """
    mark = lambda name, page, top, seq: F.struct(name.alias("segment"), page.cast("int").alias("page"), top.cast("double").alias("top"), F.lit(seq).alias("seq"))
    own, head = mark(F.col("_mark"), F.col("page"), F.col("top"), 1), mark(F.lit("header"), F.lit(1), F.lit(0.0), 0)
    found = marked(lines, vocab).where("_mark is not null")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "top")) == 1
    # the first boundary brings the header's along, so the lines are gone through once
    marks = F.explode(F.when(F.col("_first"), F.array(head, own)).otherwise(F.array(own)))
    out = found.withColumn("_first", first).select("doc_id", marks.alias("b")).select("doc_id", "b.*")
    if footers is not None:
        out = out.unionByName(footers.select("doc_id", F.lit("footer").alias("segment"), "page", "top", F.lit(2).alias("seq")))
    return out


def with_family(lines: DataFrame) -> DataFrame:
    """``lines`` with ``family`` of their document (``metadata``), without a second pass."""
    kind = F.when(F.col("page") <= 2, policy_type(F.col("text"), F.col("bold")))
    last = F.max_by(kind, F.when(kind.isNotNull(), F.struct("page", "top"))).over(Window.partitionBy("doc_id"))
    return lines.withColumn("family", family(F.coalesce(last, F.lit("commercial"))))


def marked_by_family(lines: DataFrame) -> DataFrame:
    """``marked`` with the vocabulary of each document's family (column ``family``)."""
    both = marked(marked(lines, V.SECTION_VOCAB).withColumnRenamed("_mark", "_drug"), V.MM_SECTION_VOCAB)
    return both.withColumn("_mark", F.when(F.col("family") == "mm", F.col("_mark")).otherwise(F.col("_drug"))).drop("_drug")


def segmented(lines: DataFrame, vocab: list[str] = V.SECTION_VOCAB, footers: DataFrame | None = None, default: str | None = "header") -> DataFrame:
    """``lines`` with the segment each belongs to: the boundary is marked on the line itself, so the lines are read and shuffled once.

    Same result as ``assign_segments`` with ``boundaries`` of the same lines. ``footers`` (doc_id, page, top; one a document)
    begin ``footer``.
    """
    here = Window.partitionBy("doc_id").orderBy("page", "top").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.last("_mark", ignorenulls=True).over(here)
    # places get their types first, so that rows are sorted once
    lines = lines.withColumn("page", F.col("page").cast("int")).withColumn("top", F.col("top").cast("double"))
    out = lines if "_mark" in lines.columns else marked(lines, vocab)
    if footers is None:
        found = own
    else:
        out = out.join(footers.select("doc_id", F.struct(F.col("page").cast("int").alias("p"), F.col("top").cast("double").alias("t")).alias("_foot")), "doc_id", "left")
        place = F.struct(F.col("page").cast("int").alias("p"), F.col("top").cast("double").alias("t"))
        # a section that begins after the footer's rule takes over again
        last = F.max(F.when(F.col("_mark").isNotNull(), place)).over(here)
        found = F.when(F.col("_foot").isNotNull() & (place >= F.col("_foot")) & (last.isNull() | (last <= F.col("_foot"))), F.lit("footer")).otherwise(own)
    found = F.coalesce(found, F.lit(default)) if default is not None else found
    return out.withColumn("segment", found).drop("_mark", "_foot")


def footer_rule(rects: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, page, top of the first thin wide coloured rectangle on the last page (``pages``: doc_id, n_pages)."""
    c = F.col("color")
    coloured = (F.col("color_kind") == "tuple") & ~((F.size(c) == 3) & F.forall(c, lambda v: v == 1.0)) & ~((F.size(c) == 3) & F.forall(c, lambda v: v == 0.0))
    thin = (F.col("bottom") - F.col("top") < 5) & (F.col("x1") - F.col("x0") > 400)
    return rects.join(pages, "doc_id").where((F.col("page") == F.col("n_pages")) & thin & coloured).groupBy("doc_id", F.col("n_pages").alias("page")).agg(F.min_by("top", "rect_idx").alias("top"))


def assign_segments(rows: DataFrame, bounds: DataFrame, default: str | None = "header") -> DataFrame:
    """``rows`` (doc_id, page, top) with the segment active there: the latest boundary at or before it."""
    marks = bounds.select("doc_id", F.col("page").cast("int").alias("page"), F.col("top").cast("double").alias("top"), "segment", F.col("seq").alias("_seq"))
    rows = rows.withColumn("page", F.col("page").cast("int")).withColumn("top", F.col("top").cast("double"))
    return asof_last(rows, marks, ["doc_id"], ["page", "top"], "segment", default)


def sections(lines: DataFrame) -> DataFrame:
    """Lines with ``section_id``: a new one wherever the segment differs from the line before."""
    order = Window.partitionBy("doc_id").orderBy("page", "top")
    previous = F.lag("segment").over(order)
    return islands(lines.withColumn("_new", previous.isNull() | (previous != F.col("segment"))), ["doc_id"], ["page", "top"], F.col("_new"), "section_id").drop("_new")


def segment_text(lines: DataFrame) -> DataFrame:
    """doc_id, section_id, segment and the text of its lines in order."""
    return lines.groupBy("doc_id", "section_id", "segment").agg(joined("text", [F.col("page"), F.col("top")]).alias("text"), F.count("*").alias("n_lines"))


def family(policy_type: Column, filename: Column | None = None) -> Column:
    """Medical or administrative documents are of family ``mm``, others of family ``drug``."""
    return F.when(policy_type.isin("medical_policy", "administrative_policy"), "mm").otherwise("drug")


def policy_type(text: Column, bold: Column) -> Column:
    """The type a bold line names; null if none."""
    lower = F.lower(text)
    return (
        F.when(bold & (lower.contains("drug coverage") | lower.contains("drug and biologic")), "drug_policy")
        .when(bold & lower.contains("medical coverage"), "medical_policy")
        .when(bold & lower.contains("administrative policy"), "administrative_policy")
    )


def metadata(lines: DataFrame) -> DataFrame:
    """doc_id, title, publish_date, policy_number, policy_type, doc_type from the first two pages: large bold lines make the title; of dates, numbers and types the last counts."""
    kind = policy_type(F.col("text"), F.col("bold"))
    at = F.struct("page", "top")
    date, number = T.effective_date(F.col("text")), T.policy_number(F.col("text"))
    head = lines.where("page <= 2").withColumn("_date", F.nullif(date, F.lit(""))).withColumn("_number", F.nullif(number, F.lit(""))).withColumn("_kind", kind)
    head = head.withColumn("_title", F.when((F.col("size") >= 18) & F.col("bold"), F.col("text")))
    last = lambda c, when: F.max_by(c, F.when(F.col(when).isNotNull(), at))
    out = head.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("_title").isNotNull(), F.struct("page", "top", "_title")))).alias("_titles"),
        last("_date", "_date").alias("publish_date"), last("_number", "_number").alias("policy_number"),
        last("_kind", "_kind").alias("policy_type"), last(T.strip(F.col("text")), "_kind").alias("doc_type"),
    )
    return out.select(
        "doc_id", T.clean(F.array_join(F.transform("_titles", lambda t: t["_title"]), " ")).alias("title"), F.coalesce("publish_date", F.lit("")).alias("publish_date"),
        "policy_number", F.coalesce("policy_type", F.lit("commercial")).alias("policy_type"), F.coalesce("doc_type", F.lit("Coverage Policy")).alias("doc_type"),
    )


def contents_zone(lines: DataFrame) -> DataFrame:
    """Lines of page 1 between the bold heading of the contents and the bold instructions line."""
    through = Window.partitionBy("doc_id").orderBy("top").rowsBetween(Window.unboundedPreceding, 0)
    lower = F.lower(T.strip(F.col("text")))
    opens = lower.contains("table of contents") & F.col("bold") & (F.col("size") >= 12)
    first = lines.where("page = 1").withColumn("_opens", opens).withColumn("_in", F.max("_opens").over(through))
    first = first.withColumn("_closes", F.col("_in") & ~F.col("_opens") & lower.contains("instructions for use") & F.col("bold"))
    return first.withColumn("_closed", F.max("_closes").over(through)).where("_in and not _opens and not _closed").drop("_opens", "_in", "_closes", "_closed")


def contents(lines: DataFrame) -> DataFrame:
    """doc_id, top, entry, page_no: entries on the left of the zone."""
    zone = contents_zone(lines).where("x0 < 200")
    return zone.select("doc_id", "top", T.strip_leaders(T.strip(F.col("text"))).alias("entry"), T.toc_page(T.strip(F.col("text"))).alias("page_no")).where("entry != ''")


def related_links(lines: DataFrame, annots: DataFrame) -> DataFrame:
    """doc_id, url, text, first_top: lines on the right of the zone, those of one link joined; lines without a link share the empty one."""
    zone = contents_zone(lines).where("x0 >= 200")
    held = annots.where("page = 1 and uri is not null and x0 > 200").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("annot_idx", "top", "bottom", "uri"))).alias("_links"))
    hit = F.get(F.filter("_links", lambda a: (a["top"] <= F.col("top")) & (F.col("top") <= a["bottom"])), F.lit(0))["uri"]
    linked = zone.join(held, "doc_id", "left").withColumn("url", F.coalesce(hit, F.lit("")))
    return linked.groupBy("doc_id", "url").agg(joined("text", [F.col("top")]).alias("text"), F.min("top").alias("first_top"))


# Headings below the section -----------------------------------------------------------------------


def subsection_of(text: Column, bold: Column, size: Column, x0: Column, in_table: Column, publisher: str = "publisher", compat: bool = False) -> Column:
    """The subsection a line is the heading of; null if none.

    Entries are tried the longest first (then by text). By default an entry that matches exactly wins over one that
    matches with up to three characters left out; ``compat`` tries both at each entry, so that a short heading can
    be taken for a longer entry.
    """
    ranked = sorted(V.SUBSECTION_VOCAB, key=lambda v: (-len(v), v))
    entries = F.array(*[F.struct(F.lit(v.replace(" ", "").replace("/", "")).alias("key"), F.lit(V.proper_case(v)).alias("shown"), F.lit(len(v)).alias("long"), F.lit(len(v.split())).alias("words")) for v in ranked])
    raw = T.strip(text)
    tight = F.replace(raw, F.lit(" "), F.lit(""))
    line = F.struct(
        raw.alias("raw"), F.lower(tight).alias("bare"), F.replace(T.normalize_heading(text), F.lit(" "), F.lit("")).alias("norm"),
        (F.upper(tight) == tight).alias("capitals"), F.size(F.split(raw, r"\s+")).alias("words"),
    )

    def found(x: Column) -> Column:
        is_exact = lambda v: (v["key"] == x["bare"]) | (v["key"] == x["norm"])
        length = F.char_length(x["bare"])
        is_near = lambda v: F.when(length.between(F.char_length(v["key"]) - 3, F.char_length(v["key"])), T.is_garbled(x["bare"], v["key"])).otherwise(False)
        first = lambda test: F.get(F.filter(entries, test), F.lit(0))

        def shown(v: Column) -> Column:
            as_written = F.when(x["capitals"] & (x["words"] > v["words"]), v["shown"]).when(F.char_length(x["raw"]) > v["long"], x["raw"]).otherwise(v["shown"])
            return F.when((x["bare"] == v["key"]) | (x["norm"] != v["key"]), v["shown"]).otherwise(as_written)

        if compat:
            either = first(lambda v: is_exact(v) | is_near(v))
            return F.struct(shown(either).alias("bold"), first(lambda v: v["key"] == x["bare"])["shown"].alias("plain"))
        return F.struct(F.coalesce(shown(first(is_exact)), first(is_near)["shown"]).alias("bold"), first(lambda v: v["key"] == x["bare"])["shown"].alias("plain"))

    # one-element array: the line's forms are worked out once, not for every entry
    hit = F.get(F.transform(F.array(line), found), F.lit(0))
    starts_lower = F.substring(text, 1, 1).rlike(r"^\p{Ll}")
    barred = in_table | (size < 7) | (size >= 11.5) | T.is_boilerplate(text, publisher) | starts_lower | text.startswith("•") | text.rlike(r"^\d+\.")
    return F.when(barred, F.lit(None).cast("string")).when(~bold, F.when((x0 < 70) & (size >= 9.5), hit["plain"])).when(x0 <= 120, hit["bold"])


def subsubsection_of(text: Column, bold: Column, italic: Column, size: Column, x0: Column, in_table: Column, publisher: str = "publisher") -> Column:
    """An italic line at the left margin that is short and begins with a capital; null if it is none."""
    raw = T.strip(text)
    starts = [s.format(publisher=publisher) for s in V.ITALIC_BOILERPLATE]
    ok = ~bold & italic & ~in_table & (size >= 9) & (x0 < 70) & raw.rlike(r"^\p{Lu}") & (F.char_length(raw) <= 80) & ~T.starts_with_any(F.lower(raw), starts)
    return F.when(ok, raw)


def mm_heading_level(text: Column, bold: Column, size: Column, x0: Column, in_table: Column, underline: Column, section: Column) -> Column:
    """Level of a heading in medical documents: 1 if underlined, 2 in some sections if short; null if none."""
    raw = T.strip(text)
    lower = F.lower(raw)
    ok = (
        bold & ~in_table & (size >= 9.5) & (size < 14) & (x0 <= 120) & raw.rlike(r"^\p{Lu}")
        & ~T.contains_any(lower, ["instructions for use", "table of contents", "related coverage resources"])
    )
    second = F.lower(section).isin(V.LEVEL_2_SECTIONS) & (F.size(F.split(raw, r"\s+")) <= 12) & ~raw.endswith(".")
    return F.when(ok & underline, 1).when(ok & second, 2)


def join_fragments(lines: DataFrame) -> DataFrame:
    """Bold lines of at most 6 characters in capitals go to the bold line after them, at most 10 points on."""
    order = Window.partitionBy("doc_id").orderBy("page", "top")
    short = F.col("bold") & T.is_upper(F.replace("text", F.lit(" "), F.lit(""))) & (F.char_length("text") <= 6)
    flagged = lines.withColumn("_short", short)
    before = F.lag(F.struct("_short", "text", "top", "page")).over(order)
    flagged = flagged.withColumn("_before", before)
    takes = F.col("bold") & ~F.col("_short") & F.col("_before._short") & (F.col("_before.page") == F.col("page")) & (F.abs(F.col("top") - F.col("_before.top")) <= 10)
    return flagged.withColumn("text", F.when(F.coalesce(takes, F.lit(False)), F.concat("_before.text", "text")).otherwise(F.col("text"))).where(~F.col("_short")).drop("_short", "_before")
