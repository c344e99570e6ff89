"""Scalar functions, with the places where Python, Spark and SQL differ."""

import pytest
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions import vocabulary as V


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    ("function", "value", "want"),
    [
        (T.clean, "  a \t b’s “q” ", "a b's \"q\""),
        (T.normalize_heading, "P OLICY S TATEMENT", "policystatement"),
        (T.normalize_heading, "Coverage Policy", "coverage policy"),
        (T.normalize_heading, "A B", "ab"),
        (T.normalize_split_heading, "O VERVIEW", "overview"),
        (T.normalize_split_heading, "COVERAGE POLICY", "coveragepolicy"),
        (T.strip_leaders, "Overview ........ 12", "Overview"),
        (T.toc_page, "Overview ........ 12", "12"),
        (T.toc_page, "Overview", ""),
        (T.effective_date, "Effective Date .... 1/15/2024", "1/15/2024"),
        (T.policy_number, "Coverage Policy Number .. IP0123", "IP0123"),
        (T.reverse_cell, "bamu\nxyz", "zyxumab"),
        (T.is_reversed_name, "ab", False),
        (T.is_reversed_name, "ab-c d", True),
        (T.escape_html, "<a href=\"x\">&'", "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"),
        (T.break_cell, " a\n\n b<c ", "a<br>b&lt;c"),
        (T.bullet_cell, "a\nb\n• c\n- d", "a b<br>• c<br>- d"),
        (T.one_line_cell, None, ""),
        (T.prefix, "ph_1234_x.pdf", "ph"),
        (T.html_rows, "<thead><tr></tr></thead><tbody><tr><tr class='x'></tbody><tr>", 2),
        (T.html_rows, "<tr><tr><tr>", 2),
        (T.html_rows, "", 0),
        (T.html_rows, "<track>", 0),
    ],
)
def test_function(spark, function, value, want):
    assert one(spark, value, function) == want


@pytest.mark.parametrize(("value", "want"), [(2.0, 0.0), (6.0, 8.0), (10.0, 8.0), (14.0, 16.0), (10.1, 12.0)])
def test_halves_go_to_even(spark, value, want):
    assert one(spark, value, lambda c: T.quantize(c, 4), "double") == want


@pytest.mark.parametrize(("candidate", "target", "want"), [("ntes", "notes", True), ("no", "notes", True), ("n", "notes", False), ("notess", "notes", False), ("medicallynecessary", "notmedicallynecessary", True), ("seton", "notes", False)])
def test_garbled(spark, candidate, target, want):
    assert spark.createDataFrame([(candidate, target)], "a string, b string").select(T.is_garbled(F.col("a"), F.col("b"))).first()[0] is want


def test_proper_case():
    assert [V.proper_case(x) for x in ("fda-approved indications", "guidelines/scientific statements", "off-label use")] == ["FDA-Approved Indications", "Guidelines/Scientific Statements", "Off-Label Use"]


@pytest.mark.parametrize(("top", "text", "want"), [(715.0, "x", False), (716.0, "x", True), (10.0, "page 2 of 9", True), (10.0, "Coverage  Policy Number : 1", True), (10.0, "on Page 2 of 9", False)])
def test_footer(spark, top, text, want):
    assert spark.createDataFrame([(top, text)], "t double, x string").select(T.is_footer(F.col("t"), F.col("x"))).first()[0] is want


def test_flat(spark):
    df = spark.createDataFrame([([["a ", None], ["", "b"], ["c"], ["d"]],)], "cells array<array<string>>")
    assert df.select(T.flat(F.col("cells")), T.flat_with_none(F.col("cells"), 1)).first()[:] == ("a b c", "a  None")


def test_colours(spark):
    df = spark.createDataFrame([(True, [0.8, 0.8, 0.8]), (True, [0.0, 0.65, 0.3]), (False, [0.5]), (True, []), (True, [0.3])], "fill boolean, color array<double>")
    assert [tuple(r) for r in df.select(T.is_gray(F.col("fill"), F.col("color")), T.is_gray(F.col("fill"), F.col("color"), 0.7), F.coalesce(T.is_green_stripe(F.col("fill"), F.col("color")), F.lit(False))).collect()] == [(True, True, False), (True, False, True), (False, False, False), (False, False, False), (True, False, False)]


@pytest.mark.parametrize(("text", "x0", "want"), [("1. a", 60.0, "num"), ("1. a", 66.0, None), ("ii. a", 90.0, "roman"), ("ii.a", 90.0, None), ("B) a", 70.0, "letter"), ("F) a", 70.0, None), ("Note: a", 1.0, "note"), ("Noted", 1.0, None)])
def test_item_marks(spark, text, x0, want):
    t, x = F.col("t"), F.col("x")
    kind = F.when(T.is_number_item(t, x), "num").when(T.is_roman_item(t, x), "roman").when(T.is_letter_item(t, x), "letter").when(T.is_note(t), "note")
    assert spark.createDataFrame([(text, x0)], "t string, x double").select(kind).first()[0] == want
