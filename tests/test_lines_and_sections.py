"""Lines and sections on documents of a few words."""

import pytest
from pyspark.sql import functions as F

from pagewright.operators import lines as L
from pagewright.operators import segments as S
from pagewright.operators.relational import asof_last, first_within, inside_any

WORDS = "doc_id long, page int, word_idx int, text string, x0 double, top double, fontname string, size double"


def words(spark, *rows):
    """(text, x0, top, font, size) of page 1."""
    return spark.createDataFrame([(1, 1, i, t, float(x), float(y), f, float(s)) for i, (t, x, y, f, s) in enumerate(rows)], WORDS)


def lines(spark, *rows):
    """(page, top, text, bold, size, x0)."""
    return spark.createDataFrame([(1, p, float(t), x, b, False, float(s), float(x0), False) for p, t, x, b, s, x0 in rows], "doc_id long, page int, top double, text string, bold boolean, italic boolean, size double, x0 double, in_table boolean")


def test_superscripts_are_glued_and_a_leading_one_dropped(spark):
    out = L.raw_lines(words(spark, ("1", 5, 100, "A", 6), ("Drug", 10, 100, "A-Bold", 10), ("®", 40, 99, "A", 6), ("use", 50, 100, "A", 10), ("2", 70, 101, "A", 7))).collect()
    assert [(r["text"], r["x0"], r["bold"], r["top"]) for r in out] == [("Drug® use2", 5.0, True, 100)]


def test_dominant_font_is_the_leftmost_longest_word(spark):
    out = L.raw_lines(words(spark, ("abcd", 50, 8, "A-Italic", 9), ("wxyz", 10, 8, "A-Bold", 11), ("tiny superscript", 90, 8, "B", 5))).first()
    assert (out["fontname"], out["size"], out["bold"], out["italic"]) == ("A-Bold", 11.0, True, False)
    only_small = L.raw_lines(words(spark, ("ab", 50, 8, "S", 5), ("c", 60, 8, "A", 9), ("d", 10, 40, "T", 6)))
    assert only_small.count() == 1  # a line of superscripts alone has no text


def test_half_way_tops_go_to_the_even_multiple(spark):
    out = L.raw_lines(words(spark, *[(t, 10, top, "A", 10) for t, top in (("a", 2), ("b", 6), ("c", 10), ("d", 14))]))
    assert sorted((r["top"], r["text"]) for r in out.collect()) == [(0, "a"), (8, "b c"), (16, "d")]


def test_footers_go(spark):
    out = L.raw_lines(words(spark, ("Page", 1, 700, "A", 9), ("2", 2, 700, "A", 9), ("of", 3, 700, "A", 9), ("9", 4, 700, "A", 9), ("kept", 1, 712, "A", 9), ("gone", 1, 720, "A", 9)))
    assert [r["text"] for r in out.collect()] == ["kept"]


def test_split_headings_merge(spark):
    out = L.merge_split_headings(lines(spark, (1, 100, "O", True, 14, 50), (1, 104, "VERVIEW", True, 10, 60), (1, 120, "B", True, 14, 50), (1, 140, "ACKGROUND", True, 10, 60)))
    assert [(r["text"], r["size"]) for r in out.orderBy("top").collect()] == [("Overview", 14.0), ("B", 14.0), ("ACKGROUND", 10.0)]


def test_greedy_buckets_do_not_chain(spark):
    out = L.greedy_buckets(words(spark, ("a", 1, 10, "A", 9), ("b", 2, 12, "A", 9), ("c", 3, 14, "A", 9)))
    assert sorted((r["text"], r["line_key"]) for r in out.collect()) == [("a", 10.0), ("b", 10.0), ("c", 14.0)]


def test_a_lone_capital_joins_its_heading(spark):
    out = L.greedy_buckets(words(spark, ("O", 1, 192, "A", 9), ("VERVIEW", 5, 196, "A", 9), ("x", 1, 230, "A", 9)))
    assert sorted((r["text"], r["line_key"]) for r in out.collect()) == [("O", 196.0), ("VERVIEW", 196.0), ("x", 230.0)]


def test_markers(spark):
    w = words(spark, ("", 10, 10, "SymbolMT", 9), ("item", 20, 10, "A", 9), ("o", 10, 30, "CourierNew", 9), ("•stuck", 10, 50, "A", 9), ("q", 5, 70, "Wingdings", 9), ("tiny", 5, 90, "A", 5))
    out = L.paragraph_lines(w.withColumn("line_key", F.col("top"))).orderBy("line_key").collect()
    assert [(r["marker_type"], r["text"], r["x0"]) for r in out] == [("bullet", "item", 20.0), ("sub_bullet", "", 10.0), ("bullet", "stuck", 20.0), ("sub_sub_bullet", "", 5.0)]


def test_sections(spark):
    rows = [
        (1, 40.0, "Title", True, 18, 50), (1, 60.0, "• product", False, 10, 50), (1, 80.0, "• other", False, 10, 50), (1, 100.0, "INSTRUCTIONS FOR USE", True, 10, 50),
        (1, 200.0, "O VERVIEW", True, 8, 90), (1, 220.0, "Appendix", True, 12, 50), (2, 40.0, "Revision Details", True, 12, 50), (2, 80.0, "Appendix", True, 12, 50), (2, 90.0, "Overview", False, 12, 50),
    ]
    out = S.boundaries(lines(spark, *rows)).orderBy("page", "top", "seq").collect()
    assert [(r["segment"], r["page"], r["top"]) for r in out] == [("header", 1, 0.0), ("applicable_products", 1, 60.0), ("ifu", 1, 100.0), ("Overview", 1, 200.0), ("Revision Details", 2, 40.0), ("Appendix", 2, 80.0)]


def test_a_line_on_a_boundary_belongs_to_it(spark):
    bounds = spark.createDataFrame([(1, "Overview", 1, 100.0, 1), (1, "Safety", 2, 50.0, 1), (1, "Scope", 2, 50.0, 2)], "doc_id long, segment string, page int, top double, seq int")
    rows = spark.createDataFrame([(1, 1, 99.0), (1, 1, 100.0), (1, 2, 49.0), (1, 2, 50.0), (1, 3, 1.0), (2, 1, 1.0)], "doc_id long, page int, top double")
    assert [r["segment"] for r in S.assign_segments(rows, bounds).orderBy("doc_id", "page", "top").collect()] == ["header", "Overview", "Overview", "Scope", "Scope", "header"]
    assert S.assign_segments(rows, bounds, None).where("doc_id = 2").first()["segment"] is None


def test_polarity_of_headings(spark):
    """The exact entry wins; the compatible mode takes the longer entry with letters left out."""
    df = spark.createDataFrame([("Medically Necessary",), ("Not Medically Necessary",), ("FDA-Approved Indication",), ("P OLICY S TATEMENT",), ("Crteria",), ("1. Criteria",), ("lower criteria",), ("Guidelines/Scientific Statements",)], "t string")
    args = (F.col("t"), F.lit(True), F.lit(10.0), F.lit(50.0), F.lit(False))
    out = df.select(S.subsection_of(*args), S.subsection_of(*args, compat=True)).collect()
    assert [r[0] for r in out] == ["Medically Necessary", "Not Medically Necessary", "FDA-Approved Indication", "Policy Statement", "Criteria", None, None, None]
    assert [r[1] for r in out][:3] == ["Not Medically Necessary", "Not Medically Necessary", "FDA-Approved Indications"]
    assert df.select(S.subsection_of(F.col("t"), F.lit(False), F.lit(10.0), F.lit(50.0), F.lit(False))).first()[0] == "Medically Necessary"


def test_metadata_takes_the_last_date_and_type(spark):
    out = S.metadata(lines(spark, (1, 10, "A Drug", True, 18, 50), (1, 30, "Policy Title", True, 20, 50), (1, 50, "Effective Date .... 1/1/2023", False, 9, 50), (2, 10, "Effective Date .... 2/2/2024", False, 9, 50), (1, 60, "Medical Coverage Policy", True, 9, 50), (3, 1, "Effective Date .... 3/3/2025", False, 9, 5))).first()
    assert (out["title"], out["publish_date"], out["policy_type"], out["doc_type"]) == ("A Drug Policy Title", "2/2/2024", "medical_policy", "Medical Coverage Policy")


def test_footer_rule(spark):
    rects = spark.createDataFrame(
        [(1, 2, 0, 50.0, 560.0, 700.0, 702.0, [0.0, 0.0, 0.0], "tuple"), (1, 2, 1, 50.0, 560.0, 710.0, 712.0, [0.1, 0.5, 0.3], "tuple"), (1, 2, 2, 50.0, 560.0, 600.0, 602.0, [0.5], "scalar"), (1, 1, 0, 50.0, 560.0, 9.0, 10.0, [0.1, 0.5, 0.3], "tuple")],
        "doc_id long, page int, rect_idx int, x0 double, x1 double, top double, bottom double, color array<double>, color_kind string",
    )
    assert [tuple(r) for r in S.footer_rule(rects, spark.createDataFrame([(1, 2)], "doc_id long, n_pages int")).collect()] == [(1, 2, 710.0)]


def test_fragments_join_the_next_bold_line(spark):
    out = S.join_fragments(lines(spark, (1, 10, "D", True, 9, 50), (1, 14, "OSING now", True, 9, 50), (1, 40, "text", False, 9, 50)))
    assert sorted(r["text"] for r in out.collect()) == ["DOSING now", "text"]


def test_shared_joins(spark):
    left = spark.createDataFrame([(1, 5.0), (1, 15.0), (2, 5.0)], "k int, at double")
    boxes = spark.createDataFrame([(1, 0.0, 5.0), (1, 20.0, 30.0)], "k int, lo double, hi double")
    assert [r["hit"] for r in inside_any(left, boxes, ["k"], "at", "lo", "hi", "hit").orderBy("k", "at").collect()] == [True, False, False]
    near = spark.createDataFrame([(1, 1, 7.0, "b"), (1, 0, 9.0, "a")], "k int, i int, at2 double, v string")
    assert [r["v"] for r in first_within(left, near, ["k"], "at", "at2", 4.0, ["i"], "v").orderBy("k", "at").collect()] == ["a", None, None]
    marks = spark.createDataFrame([(1, 5.0, "x")], "k int, at double, v string")
    assert [r["v"] for r in asof_last(left, marks, ["k"], ["at"], "v", "?").orderBy("k", "at").collect()] == ["x", "x", "?"]


@pytest.mark.parametrize(("underline", "section", "text", "want"), [(True, "x", "Heading.", 1), (False, "Coverage Policy", "Heading", 2), (False, "Coverage Policy", "Ends so.", None), (False, "Overview", "Heading", None), (True, "x", "lower", None)])
def test_medical_levels(spark, underline, section, text, want):
    df = spark.createDataFrame([(text, section, underline)], "t string, s string, u boolean")
    assert df.select(S.mm_heading_level(F.col("t"), F.lit(True), F.lit(10.0), F.lit(50.0), F.lit(False), F.col("u"), F.col("s"))).first()[0] == want


def test_words_are_neither_shuffled_nor_sorted(spark, tiny):
    """Texts are dealt once by doc_id; lines, sections and rectangles are made of them where they are."""
    from pagewright.operators import lines as L
    from pagewright.operators import segments as S
    from pagewright.plans import lines_and_sections as P
    from pagewright.sources import layout

    words = layout.words(spark.read.parquet(f"{tiny}/documents.parquet"))
    plan = S.sections(S.segmented(L.raw_lines(words)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    lines = L.raw_lines(words)
    assert L.underline(lines, P._rects(words)).count() == lines.count()
    rows = words.where("doc_id < 20").groupBy("doc_id").agg({"word_idx": "max", "ln": "max"}).count()
    assert rows == words.where("doc_id < 20").select("doc_id").distinct().count()


def test_texts_of_lines_are_put_together_once(spark):
    """Tests of a line's text don't work it out anew."""
    plan = L.raw_lines(words(spark, ("a", 10, 100, "A", 9)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(ws") == 1


def test_buckets_are_settled_once_a_page(spark):
    """The moves of a page aren't worked out for every word or top, and its words aren't gone through for every bucket."""
    plan = L.greedy_buckets(words(spark, ("a", 10, 100, "A", 9)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(_ws") == 1 and "transform(array(transform(aggregate(" in plan


def test_texts_of_paragraph_lines_are_put_together_once(spark):
    plan = L.paragraph_lines(words(spark, ("a", 10, 100, "A", 9)).withColumn("line_key", F.col("top")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_join(") == 1


def test_lines_of_odd_words(spark):
    """Small, empty and white words, no-break spaces, quotes: as put together word by word."""
    import random

    r = random.Random(7)
    rows = [(r.choice(["a", "Drug", "®", "", " ", "x y", "‘q’", "naïve", "“", "\t", "z\n", " e"]), r.choice([10, 20, 30, 40]), 100 + 8 * r.randrange(80), r.choice("AB"), r.choice([5, 7.9, 8, 9, 10])) for _ in range(600)]
    want = {}
    for top in {y for _, _, y, _, _ in rows}:
        ws = [w for _, _, w in sorted((w[1], i, w) for i, w in enumerate(rows) if w[2] == top)]
        text = ""
        for t, _, _, _, size in ws:
            text = (f"{text} {t}" if text else t) if size >= 8 else text + t if text else text
        text = " ".join(text.split()).translate(str.maketrans("’‘“”", "''\"\""))
        large = [w for w in ws if w[4] >= 8]
        first = max(large, key=lambda w: len(w[0])) if large else ws[0]
        if text and top <= 715:
            want[top] = (text, float(ws[0][1]), first[3], float(first[4]))
    assert {x["top"]: (x["text"], x["x0"], x["fontname"], x["size"]) for x in L.raw_lines(words(spark, *rows)).collect()} == want


def test_words_of_a_line_are_put_in_order_by_generated_code(spark, tiny):
    """No function is called for a word or for a comparison of two; words are counted in one window."""
    from pagewright.sources import layout

    plan = L.raw_lines(layout.words(spark.read.parquet(f"{tiny}/documents.parquet")))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort(" not in plan and "bround(" not in plan and "filter(split(" not in plan and plan.count("Window [") == 1


def test_marks_of_random_lines(spark):
    """First bullets, instructions and lines that are both, by a walk through the lines."""
    import random

    r = random.Random(3)
    texts = ["• a", "Instructions for use", "• Instructions for Use", "Overview", "plain", "following coverage policy", "Appendix", "Revision Details", " • b", "Page 1 of 2"]
    rows = [(d, 1 + i // 4, float(100 + i), r.choice(texts), r.random() < 0.6, False, 12.0, 54.0, False) for d in range(300) for i in range(r.randrange(1, 9))]
    lines_ = spark.createDataFrame(rows, "doc_id long, page int, top double, text string, bold boolean, italic boolean, size double, x0 double, in_table boolean")
    want, seen = {}, {}
    for d, page, top, text, bold, *_ in rows:
        ifu, product, revised = seen.get(d, (False, False, False))
        live, lower = not text.startswith("Page"), text.lower()
        is_ifu, mark = live and bold and "instructions for use" in lower, None
        if live and page == 1 and text.strip().startswith("•") and not ifu and not product:
            product, mark = True, "applicable_products"
        elif is_ifu and not ifu:
            ifu, mark = True, "ifu"
        elif live and bold and text in ("Overview", "Appendix", "Revision Details"):
            mark = text if text != "Appendix" or revised else None
            revised = revised or text == "Revision Details"
        elif is_ifu and text == "Instructions for use":
            mark = "Instructions For Use"
        seen[d], want[d, top] = (ifu, product, revised), mark
    assert {(x["doc_id"], x["top"]): x["_mark"] for x in S.marked(lines_).collect()} == want


def test_lines_of_sections_are_sorted_once_and_go_through_few_windows(spark, tiny):
    """One window for all that comes before a line; the type of a place doesn't change between sorts; link ids aren't taken from lines made a second time."""
    from pagewright.sources import layout

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    plan = S.sections(S.segmented(L.raw_lines(layout.words(docs))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and plan.count("Window [") == 6  # paragraphs of texts, then lines
    from pagewright.plans import lines_and_sections as P

    assert P.related_links(spark, tiny)._jdf.queryExecution().optimizedPlan().toString().count("collect_list(w") == 1


def test_lines_of_spans_are_those_of_their_words(spark):
    """Spans that follow one another, that cross, of several fonts, small ones first, empty words: the same lines as from the words one by one."""
    import random

    r = random.Random(11)
    rows, spans = [], []
    for line in range(400):
        top, at, idx = 20 + 8 * (line % 80), 10.0, 1000 * line
        for _ in range(r.randrange(1, 5)):
            texts = [r.choice(["a", "Drug", "®", "", "x y", "‘q”", "naïve", "longest word", " e"]) for _ in range(r.randrange(1, 4))]
            at = max(10.0, at + r.choice([10, 10, 10, 0, -30]))
            xs = [at + 10 * i for i in range(len(texts))]
            font, size, y = r.choice("AAAB"), float(r.choice([10, 10, 10, 9, 6])), float(top + r.choice([0, 0, 1]))
            spans.append((line // 80, 1, y, idx, size, font, texts, xs))
            rows += [(line // 80, 1, idx + i, t, x, y, font, size) for i, (t, x) in enumerate(zip(texts, xs))]
            at, idx = xs[-1], idx + len(texts)
    of_words = L.raw_lines(spark.createDataFrame(rows, WORDS)).collect()
    of_spans = L.raw_lines(spark.createDataFrame(spans, "doc_id long, page int, top double, word_idx int, size double, fontname string, texts array<string>, xs array<double>")).collect()
    assert len(of_words) > 300 and sorted(of_spans) == sorted(of_words)


def test_spans_of_the_layout_hold_its_words(spark):
    """No row a word on the way to the lines: spans have the words of ``layout.words``, and the queries take them."""
    from pagewright.plans import documents as D
    from pagewright.plans import lines_and_sections as P
    from pagewright.sources import layout

    docs = spark.createDataFrame([(-7, "a b  c\n\n d " + "w " * 40), (-1, ""), (5, None), (None, "x"), (6, "\n \n"), (7, "é  ñ \n" * 30), (8, "Page 1 of 3\n" + "z\t y x “q” " * 60)], "doc_id long, text string")
    columns = ["doc_id", "page", "ln", "top", "word_idx", "size", "fontname", "x0", "text"]
    each = layout.spans(docs).select("*", F.posexplode(F.arrays_zip("xs", "texts")).alias("i", "z")).withColumns({"word_idx": F.col("word_idx") + F.col("i"), "x0": F.col("z.xs"), "text": F.col("z.texts")})
    assert sorted(each.select(columns).collect()) == sorted(layout.words(docs).select(columns).collect())
    for q in (D.tree_dump, D.footnote_merge, P.footer_segment, P.asof_table_section, P.segment_text):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode(ws" not in plan and plan.count("collect_list(w") == 1


def test_headings_are_told_without_changing_the_case_of_long_lines(spark):
    """As ``section_of`` with every text normalised: letters that become ASCII in lower case, letter-spacing, long lines that begin like a coverage policy."""
    texts = ["Overview", "O VERVIEW", "OVERVIEW ÉTÉ", "  References ", "coverage policy " + "é " * 90, "COVERAGE POLICY AND " * 9 + "x", "C OVERAGE P OLICY", "Co verage", "bacKground", "BacKground", "İnstructions for use", "INSTRUCTIONS FOR USE É", "Ünstructions", "the following Coverage Policy É", "A" * 200, "É" * 5, "x" * 200]
    lines_ = lines(spark, *[(i + 2, 100, t, True, 10 + i % 2, 50) for i, t in enumerate(texts)])
    want = {x["page"]: x["s"] for x in lines_.select("page", S.section_of(F.col("text"), F.col("bold"), F.col("size"), F.col("x0")).alias("s")).collect()}
    found = {x["page"]: x["_mark"] for x in S.marked(lines_).collect()}
    ifu = 2 + texts.index("INSTRUCTIONS FOR USE É")
    assert found.pop(ifu) == "ifu" and {k: v for k, v in want.items() if k != ifu} == found


@pytest.fixture
def long_documents(spark, tmp_path):
    """A folder of documents of one to eleven pages, with heading lines, a text of many characters a word, empty and null ones."""
    texts = [(2, "a b c\n"), (3, "x y\n" * 200), (4, "w " * 6000), (6, "one two three\n" * 400), (8, "é" * 4000), (10, ""), (12, None), (14, "q " * 44), (16, "q " * 45)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def _against_sql(spark, folder, name):
    """Rows of a query and of its SQL over a folder of documents, in order."""
    import duckdb

    from pagewright.plans import lines_and_sections as P

    with duckdb.connect() as c:
        c.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
        want = c.execute(P.ORACLES[name]).fetchall()
    return sorted(tuple(r) for r in P.QUERIES[name](spark, folder).select("doc_id", "page", "top", "segment").collect()), sorted(want)


def test_table_regions_of_all_pages_get_their_section(spark, long_documents):
    """regions were read up to page 3."""
    found, want = _against_sql(spark, long_documents, "asof_table_section")
    assert found == want
    pages = lambda doc: [p for d, p, _, _ in found if d == doc]
    assert pages(4) == list(range(1, 12000 // 90 + 2)) and pages(6) == list(range(1, 14 * 400 // 90 + 2))


def test_table_regions_of_all_pages_get_their_segment(spark, long_documents):
    """regions were read up to page 3; those after the footer's rule, and before any section, count too."""
    found, want = _against_sql(spark, long_documents, "asof_table_segment")
    assert found == want
    counts = {d: sum(x[0] == d for x in found) for d, *_ in found}
    assert counts == {2: 1, 4: 134, 6: 63, 8: 45, 10: 1, 14: 1, 16: 2}
    assert {s for d, p, _, s in found if d == 8 and p > 3} == {"footer"}
