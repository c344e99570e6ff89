"""Scalar text functions and predicates as Column expressions: everything stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V

_SPACES = r"(?U)\s+"
#: Words with one space between them, of characters among which are neither white space nor curly quotes.
_CLEAN = r"^[!-~\u00A1-\u167F]++(?: [!-~\u00A1-\u167F]++)*+\z"


def squeeze(text: Column) -> Column:
    """Runs of white space (any Unicode kind) as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, _SPACES, " "), "^ | $", "")


def clean(text: Column) -> Column:
    """``squeeze``, with curly quotes made straight."""
    # most texts are clean: one test instead of a replacement for every space
    return F.when(text.rlike(_CLEAN), text).otherwise(F.translate(squeeze(text), "’‘“”", "''\"\""))


def is_bold(font: Column) -> Column:
    return font.contains("Bold") | font.contains("bold")


def is_italic(font: Column) -> Column:
    return font.contains("Italic") | font.contains("italic") | font.contains("Oblique")


def is_upper(text: Column) -> Column:
    """At least one cased letter, none in lower case."""
    # most texts have a small letter of ASCII: only the others are changed to both cases
    return F.when(text.rlike("[a-z]"), False).otherwise((F.upper(text) == text) & (F.lower(text) != text))


def join_capitals(text: Column) -> Column:
    """Letter-spaced capitals joined: ``O VERVIEW`` to ``OVERVIEW``."""
    return F.regexp_replace(text, "(?<=[A-Z]) (?=[A-Z])", "")


def normalize_heading(text: Column) -> Column:
    """Lower case without letter-spacing; without any space for headings all in capitals."""
    bare = F.replace(F.trim(text), F.lit(" "), F.lit(""))
    return F.when(is_upper(bare) & (F.char_length(bare) >= 4), F.lower(bare)).otherwise(F.trim(F.lower(join_capitals(text))))


def normalize_split_heading(text: Column) -> Column:
    """As for the two halves of a split heading: letter-spacing alone."""
    return F.trim(F.lower(join_capitals(text)))


def is_garbled(candidate: Column, target: Column, most: int = 3) -> Column:
    """Whether the candidate is the target with at most ``most`` characters left out."""
    # the greedy scan for a subsequence: what is left of the candidate after each character of the target
    left = F.aggregate(F.split(target, ""), candidate, lambda rest, ch: F.when((ch != "") & F.startswith(rest, ch), F.substr(rest, F.lit(2))).otherwise(rest))
    return (candidate == target) | ((F.char_length(candidate) <= F.char_length(target)) & (left == "") & (F.char_length(target) - F.char_length(candidate) <= most))


def is_footer(top: Column, text: Column) -> Column:
    # few lines begin like one: the others are told by their first letter, without a pattern
    return (top > V.FOOTER_TOP) | (F.substring(text, 1, 1).isin("P", "p", "C", "c") & (text.rlike(V.FOOTER_PATTERNS[0]) | text.rlike(V.FOOTER_PATTERNS[1])))


def contains_any(text: Column, keywords: list[str]) -> Column:
    found = F.lit(False)
    for k in keywords:
        found = found | text.contains(k)
    return found


def starts_with_any(text: Column, starts: list[str]) -> Column:
    found = F.lit(False)
    for k in starts:
        found = found | text.startswith(k)
    return found


def is_boilerplate(text: Column, publisher: str = "publisher") -> Column:
    return contains_any(F.lower(text), [f.format(publisher=publisher) for f in V.BOILERPLATE_FRAGMENTS])


# Markers of list items -------------------------------------------------------------------------


def has_bullet_glyph(text: Column) -> Column:
    return F.trim(text).isin(V.BULLET_CHARS)


def is_number_item(text: Column, x0: Column) -> Column:
    return (x0 <= 65) & text.rlike(r"^\d+\.")


def is_roman_item(text: Column, x0: Column) -> Column:
    return x0.between(85, 100) & text.rlike(r"^[ivxIVX]+\.\s")


def is_letter_item(text: Column, x0: Column) -> Column:
    return x0.between(68, 78) & text.rlike(r"^[A-E]\)")


def is_note(text: Column) -> Column:
    return text.startswith("Note:") | text.startswith("Note :")


# Cells -------------------------------------------------------------------------------------------


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def cell(value: Column) -> Column:
    """A nullable cell, stripped; empty where it is null."""
    return strip(F.coalesce(value, F.lit("")))


def reverse_cell(value: Column) -> Column:
    """Text of a rotated header, which reads backwards."""
    return F.reverse(strip(F.replace(F.coalesce(value, F.lit("")), F.lit("\n"), F.lit(""))))


def is_reversed_name(value: Column) -> Column:
    bare = strip(F.replace(F.coalesce(value, F.lit("")), F.lit("\n"), F.lit("")))
    return (F.char_length(bare) >= 3) & bare.rlike(r"^[A-Za-z\-\s]+$")


def flat(cells: Column, rows: int = 3) -> Column:
    """The stripped cells of the first rows that aren't empty, joined by spaces."""
    head = F.flatten(F.slice(cells, 1, rows))
    return F.array_join(F.filter(F.transform(head, cell), lambda c: c != ""), " ")


def flat_with_none(cells: Column, rows: int = 3) -> Column:
    """Cells of the first rows as they are, null ones as the word None, joined by spaces."""
    return F.array_join(F.transform(F.flatten(F.slice(cells, 1, rows)), lambda c: F.coalesce(c, F.lit("None"))), " ")


def escape_html(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def one_line_cell(value: Column) -> Column:
    return strip(F.replace(F.coalesce(value, F.lit("")), F.lit("\n"), F.lit(" ")))


def break_cell(value: Column) -> Column:
    """Lines of a cell, escaped, with line breaks between those that aren't empty."""
    parts = F.filter(F.transform(F.split(cell(value), "\n"), lambda p: escape_html(strip(p))), lambda p: p != "")
    return F.array_join(parts, "<br>")


def bullet_cell(value: Column) -> Column:
    """Lines of a cell joined by spaces, by a line break before a bullet or dash."""
    parts = F.filter(F.transform(F.split(cell(value), "\n"), strip), lambda p: p != "")
    parts = F.transform(parts, escape_html)
    glue = lambda acc, p: F.when(acc == "", p).when(p.startswith("•") | p.startswith("-"), F.concat(acc, F.lit("<br>"), p)).otherwise(F.concat(acc, F.lit(" "), p))
    return F.aggregate(parts, F.lit(""), glue)


def prefix(filename: Column) -> Column:
    return F.split_part(filename, F.lit("_"), F.lit(1))


def quantize(value: Column, step: int) -> Column:
    """To the nearest multiple of ``step``, halves to even."""
    return F.rint(value / step) * step


def mean_colour(color: Column) -> Column:
    return F.when(F.size(color) > 0, F.aggregate(color, F.lit(0.0), lambda a, c: a + c) / F.size(color)).otherwise(0.0)


def is_gray(fill: Column, color: Column, low: float = 0.3) -> Column:
    return fill & mean_colour(color).between(low, 0.98)


def is_green_stripe(fill: Column, color: Column) -> Column:
    r, g, b = (F.try_element_at(color, F.lit(i)) for i in (1, 2, 3))
    return fill & (F.size(color) == 3) & (r < 0.1) & (g > 0.5) & (g < 0.85) & (b > 0.1) & (b < 0.5)


def effective_date(text: Column) -> Column:
    """The date after ``Effective Date``; empty without one."""
    return F.regexp_extract(text, r"(?i)Effective\s+Date[.\s\u2026]+([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", 1)


def policy_number(text: Column) -> Column:
    """The word after ``Coverage Policy Number``; empty without one."""
    return F.regexp_extract(text, r"(?i)Coverage\s+Policy\s+Number\s*[.\s]+(\S+)", 1)


def toc_page(text: Column) -> Column:
    """The page number at the end of an entry of a table of contents; empty without one."""
    return F.regexp_extract(text, r"(\d+)\s*$", 1)


def strip_leaders(text: Column) -> Column:
    """Without dot leaders and the page number after them."""
    return strip(F.regexp_replace(strip(F.regexp_replace(text, r"[.\u2025\u2026\s]+\d+\s*$", "")), r"\s+\d+\s*$", ""))


def html_rows(html: Column) -> Column:
    """Rows in the first table body; without one all rows but one."""
    body = F.regexp_extract(html, r"(?s)<tbody>(.*?)</tbody>", 1)
    has_body = html.rlike(r"(?s)<tbody>.*?</tbody>")
    return F.when(has_body, F.regexp_count(body, F.lit(r"<tr\b"))).otherwise(F.greatest(F.regexp_count(html, F.lit(r"<tr\b")) - 1, F.lit(0)))
