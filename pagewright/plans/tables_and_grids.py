"""Queries over made-up ruled tables, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import vocabulary as V
from pagewright.operators import build as H
from pagewright.operators import dosing as X
from pagewright.operators import corpus as C
from pagewright.operators import grids as G
from pagewright.operators import qa as Q
from pagewright.operators import tables as B
from pagewright.sources import grids
from pagewright.sources.stages import Stages

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _tables(spark: SparkSession, d: str) -> DataFrame:
    return grids.tables(spark.read.parquet(f"{d}/part.parquet"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return grids.pages(spark.read.parquet(f"{d}/part.parquet"))


def _all(spark, d):
    pages = _pages(spark, d)
    return _tables(spark, d), grids.words(pages), grids.rects(pages)


def _detected(spark, d):
    """Tables of whole pages with what the detector finds: the source is read once."""
    return B.detect_pages(_pages(spark, d))


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _any(text: str, keywords) -> str:
    return "(" + " OR ".join(f"contains({text}, '{k}')" for k in keywords) + ")"


KEYS = ["doc_id", "page", "table_idx"]
_SHUT = "trim(coalesce(c, ''))"
SPURIOUS_SQL = f"""{grids.GRIDS_SQL},
shaped AS (SELECT *, len(cells) AS n_rows, len(cells[1]) AS cols, trim(coalesce(cells[1][1], '')) AS first, [trim(coalesce(r[1], '')) for r in cells if trim(coalesce(r[1], '')) <> ''] AS col0 FROM tables),
judged AS (SELECT t.*, (
    EXISTS (SELECT 1 FROM grects r WHERE r.doc_id = t.doc_id AND r.page = t.page AND r.fill AND r.r < 0.1 AND r.g > 0.5 AND r.g < 0.85 AND r.b > 0.1 AND r.b < 0.5 AND r.top >= t.top - 2 AND r.bottom <= t.bottom + 2)
    OR (bottom - top < 30 AND cols <= 2)
    OR (cols = 1 AND (len([c for c in flatten(cells) if {_SHUT} <> '']) = 0
      OR EXISTS (SELECT 1 FROM tables o WHERE o.doc_id = t.doc_id AND o.page = t.page AND o.table_idx <> t.table_idx AND o.x0 < t.x0 AND o.top <= t.top AND o.x1 > t.x1 AND o.bottom >= t.bottom)))
    OR EXISTS (SELECT 1 FROM tables o WHERE o.doc_id = t.doc_id AND o.page = t.page AND o.table_idx <> t.table_idx AND o.x0 <= t.x0 AND o.top <= t.top AND o.x1 >= t.x1 AND o.bottom >= t.bottom AND o.x1 - o.x0 > (t.x1 - t.x0) * 1.5)
    OR ((cols = 1 OR (cols = 2 AND len([r for r in cells if trim(coalesce(r[2], '')) <> '']) = 0)) AND length(first) > 15 AND contains(first, ' ') AND NOT {" AND NOT ".join(f"starts_with(first, '{s}')" for s in V.PROSE_HEADER_STARTS)}
      AND (regexp_matches(first, '^\\p{{Lu}}') OR x0 > 80) AND len([c for c in col0 if length(c) > 60]) > len(col0) * 0.4)
    OR (cols = 1 AND n_rows > 3 AND len([r for r in cells if len([c for c in r if {_SHUT} <> '']) > 0]) <= 1)
    OR (n_rows = 1 AND cols = 2 AND first = '' AND length(trim(coalesce(cells[1][2], ''))) > 40)
  ) AS spurious FROM shaped t)
"""


@query(f"WITH {SPURIOUS_SQL} SELECT doc_id, page, table_idx, spurious FROM judged")
def spurious_tables(spark, d):
    t, _, r = _all(spark, d)
    return B.spurious(t, r).select(*KEYS, "spurious")


TOP_SQL = f"""{SPURIOUS_SQL},
topped AS (SELECT j.*, least(j.top, coalesce((SELECT min(r.top) FROM grects r WHERE r.doc_id = j.doc_id AND r.page = j.page AND r.x1 - r.x0 < 2 AND r.bottom >= j.top - 2 AND r.top < j.top AND (abs(r.x0 - j.x0) < 3 OR abs(r.x0 - j.x1) < 3)), j.top)) AS true_top FROM judged j)
"""


@query(f"WITH {TOP_SQL} SELECT doc_id, page, table_idx, true_top FROM topped")
def true_top(spark, d):
    t, _, r = _all(spark, d)
    return B.visual_top(t, r).select(*KEYS, "true_top")


TINY_SQL = "tiny AS (SELECT doc_id, page, count(*) FILTER (n >= 4) AS tiny_cols FROM (SELECT doc_id, page, round_even(x0 / 8, 0) AS xk, count(*) AS n FROM gwords WHERE size < 8 AND length(text) <= 3 GROUP BY ALL) GROUP BY ALL)"


@query(f"WITH {grids.GRIDS_SQL}, {TINY_SQL} SELECT * FROM tiny")
def rotated_headers(spark, d):
    return B.rotated_headers(_all(spark, d)[1])


CONT_SQL = f"""{TOP_SQL}, {TINY_SQL},
pages_ AS (SELECT doc_id, page, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS run FROM (SELECT DISTINCT doc_id, page FROM tables)),
prev AS (SELECT t.*, last_value(CASE WHEN NOT spurious THEN {{'x0': x0, 'x1': x1}} END IGNORE NULLS) OVER (PARTITION BY doc_id, run ORDER BY page, table_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM topped t JOIN pages_ USING (doc_id, page)),
conts AS (SELECT *, NOT spurious AND coalesce(abs(x0 - p.x0) < 5 AND abs(x1 - p.x1) < 30 AND true_top < 120, false) AS is_continuation FROM prev),
bolds AS (SELECT t.doc_id, t.page, t.table_idx, string_agg(w.text, ' ' ORDER BY w.word_idx) AS title FROM tables t JOIN gwords w ON w.doc_id = t.doc_id AND w.page = t.page AND contains(w.fontname, 'Bold') AND w.top >= t.top - 16 AND w.top < t.top GROUP BY ALL),
lefts AS (SELECT t.doc_id, t.page, t.table_idx, string_agg(w.text, ' ' ORDER BY w.word_idx) AS left_text FROM tables t JOIN gwords w ON w.doc_id = t.doc_id AND w.page = t.page AND w.x1 <= t.x0 + 10 AND w.top BETWEEN t.top - 5 AND t.bottom + 5 GROUP BY ALL),
ready AS (SELECT c.*, substr(coalesce(b.title, ''), 1, 80) AS title, coalesce(l.left_text, '') AS left_text, coalesce(tiny_cols, 0) AS tiny_cols,
  array_to_string([coalesce(c, 'None') for c in cells[1]], ' ') AS flat0, array_to_string([coalesce(c, 'None') for c in flatten(cells[1:3])], ' ') AS flat3,
  array_to_string([{_SHUT} for c in flatten(cells[1:3]) if {_SHUT} <> ''], ' ') AS full3, array_to_string([c for c in cells[1] if coalesce(c, '') <> ''], ' ') AS full0, coalesce(cells[1][1], '') AS raw0, coalesce(cells[1][2], '') AS raw1
  FROM conts c LEFT JOIN bolds b USING (doc_id, page, table_idx) LEFT JOIN lefts l USING (doc_id, page, table_idx) LEFT JOIN tiny USING (doc_id, page))
"""


@query(f"WITH {CONT_SQL} SELECT doc_id, page, table_idx, is_continuation, title, left_text FROM ready")
def table_continuation(spark, d):
    return _detected(spark, d).select(*KEYS, "is_continuation", "title", "left_text")


_NORM = "regexp_replace(regexp_replace(title, '([A-Z]) ([A-Z])', '\\1\\2', 'g'), '([A-Z]) ([A-Z])', '\\1\\2', 'g')"


def _titled(keywords) -> str:
    return f"(regexp_matches(title, '^(Appendix\\s+)?Table\\s+\\d+[.]') OR {_any(f'lower({_NORM})', keywords)} OR lower(trim({_NORM})) IN ({_q(V.TITLED_GENERIC_EXACT)}) OR regexp_matches({_NORM}, '^Table\\s+\\d+[:\\s]'))"


_FILLED = "[r for r in cells if len([c for c in r if trim(coalesce(c, '')) <> '']) >= 2]"
TYPE_SQL = f"""{CONT_SQL},
typed AS (SELECT *, CASE WHEN spurious THEN 'spurious' WHEN first = 'Type of Revision' THEN 'revision'
  WHEN len([c for c in cells[1] if {_SHUT} IN ('Product', 'Product Name')]) > 0 AND NOT contains(lower(raw1), 'criteria') AND NOT contains(lower(raw1), 'use') THEN 'dql'
  WHEN tiny_cols >= 4 THEN 'availability' WHEN len([c for c in cells[1] if rtrim(regexp_replace(coalesce(c, ''), '\\s', '', 'g'), ':') = 'Criteria']) > 0 THEN 'criteria'
  WHEN {_any("raw0 || '|' || raw1 || '|' || left_text", ["HCPCS", "CPT"])} THEN 'hcpcs' WHEN contains(full3, 'Mechanism of Action') AND first = '' THEN 'moa' WHEN contains(raw0, 'ICD-10') THEN 'hcpcs'
  WHEN first = 'Date' AND contains(raw1, 'EUA') THEN 'generic' WHEN contains(flat0, 'Drug') AND contains(flat0, 'Prescribing') THEN 'generic' WHEN len([c for c in cells[1] if contains(coalesce(c, ''), 'Summary of Changes')]) > 0 THEN 'revision'
  WHEN {_titled(V.DETECTOR_TITLE_KW)} THEN 'generic' WHEN contains(flat0, 'Exception Criteria') OR (contains(flat0, 'Non-Preferred') AND contains(flat0, 'Criteria')) OR contains(flat0, 'Criteria for Use') THEN 'generic'
  WHEN {_any("flat0", ["Non-Covered Brand", "Non-Covered Product", "Bioequivalent"])} THEN 'generic' WHEN contains(flat0, 'Medication') AND contains(flat3, 'Mode of Administration') THEN 'generic'
  WHEN contains(flat0, 'Condition') AND contains(flat3, 'Criteria for Use') THEN 'generic' WHEN {_any("flat0", V.KNOWN_KW)} THEN 'generic' WHEN is_continuation THEN 'continuation'
  WHEN (cols >= 2 AND (len({_FILLED}) > 0 OR n_rows >= 3)) OR (cols = 1 AND n_rows >= 5) THEN 'generic' ELSE 'unknown' END AS table_type FROM ready)
"""


@query(f"WITH {TYPE_SQL} SELECT doc_id, page, table_idx, table_type, table_type NOT IN ('spurious', 'unknown') AS covered FROM typed")
def table_type_cascade(spark, d):
    return _detected(spark, d).select(*KEYS, "table_type", "covered")


@query(f"WITH {TYPE_SQL} SELECT DISTINCT doc_id, page, greatest(0, top - CASE WHEN table_type = 'criteria' THEN 30 ELSE 5 END) AS box_top, bottom AS box_bottom FROM typed WHERE table_type NOT IN ('spurious', 'unknown')")
def covered_regions(spark, d):
    return B.covered_regions(_detected(spark, d))


_NULL_FIRST = "len([r for r in cells[1:3] if r[1] IS NULL]) > 0"
_QTY = f"list_has_any(string_split(lower(array_to_string([coalesce(c, '') for c in cells[1]], ' ')), ' '), [{_q(['strength', 'retail', 'home', 'delivery', 'maximum', 'quantity', 'limit', 'limits', 'days', 'supply', 'dosage'])}])"
HANDLER_SQL = f"""{CONT_SQL},
handled AS (SELECT *, CASE WHEN first = 'Type of Revision' THEN 'revision' WHEN contains(lower(title), 'fda') AND contains(lower(title), 'dosing') AND {_NULL_FIRST} THEN 'fda_dosing'
  WHEN len([c for c in cells[1] if {_SHUT} IN ('Product', 'Product Name')]) > 0 AND {_QTY} THEN 'dql' WHEN tiny_cols >= 4 AND len([c for c in cells[1] if {_SHUT} = 'Product']) = 0 THEN 'availability'
  WHEN len([c for c in cells[1] if {_SHUT} IN ('Product', 'Product Name')]) = 0 AND len([c for c in cells[1] if {_SHUT} = 'Criteria']) > 0 THEN 'criteria' WHEN {_any("raw0 || '|' || raw1", ["HCPCS", "CPT"])} OR contains(raw0, 'ICD-10') THEN 'hcpcs'
  WHEN first = 'Date' AND contains(raw1, 'EUA') THEN 'eua' WHEN contains(flat0, 'Drug') AND contains(flat0, 'Prescribing') THEN 'fda_rx' WHEN contains(flat0, 'Summary of Changes') THEN 'rev_flex'
  WHEN contains(flat0, 'Exception Criteria') OR (contains(flat0, 'Non-Preferred') AND contains(flat0, 'Criteria')) OR contains(flat0, 'Criteria for Use') THEN 'nonpref' WHEN {_any("flat0", ["Non-Covered Brand", "Bioequivalent"])} THEN 'drug_equiv'
  WHEN contains(flat0, 'Medication') AND contains(flat3, 'Mode of Administration') THEN 'medication_moa' WHEN contains(flat0, 'Condition') AND contains(flat3, 'Criteria for Use') THEN 'condition_criteria' WHEN {_any("flat0", V.KNOWN_KW)} THEN 'known_kw'
  WHEN {_titled(V.TITLED_GENERIC_KW)} THEN 'titled_generic' WHEN contains(full3, 'Mechanism of Action') AND first = '' THEN 'moa' ELSE 'catch_all' END AS handler,
  (NOT spurious AND (n_rows > 1 OR len([c for c in cells[1] if {_SHUT} <> '']) >= 2)) AS buildable FROM ready)
"""


def _handled(spark, d):
    return _detected(spark, d).withColumn("handler", B.handler())


@query(f"WITH {HANDLER_SQL} SELECT doc_id, page, table_idx, handler FROM handled WHERE buildable")
def builder_cascade(spark, d):
    return B.buildable(_handled(spark, d)).select(*KEYS, "handler")


_SEG = "CASE WHEN doc_id % 4 = 1 AND page > 2 THEN 'Coding' ELSE 'Overview' END AS seg"
_FIRSTS = f"""firsts AS (SELECT f.*, {_SEG} FROM handled f JOIN (SELECT doc_id, page, min(table_idx) AS table_idx FROM handled GROUP BY ALL) USING (doc_id, page, table_idx)),
wordtop AS (SELECT doc_id, page, min(top) AS w FROM gwords GROUP BY ALL),
bh AS (SELECT t.*, {_SEG}, EXISTS (SELECT 1 FROM gwords w WHERE w.doc_id = t.doc_id AND w.page = t.page AND contains(w.fontname, 'Bold') AND w.top BETWEEN t.top AND t.top + 20 AND w.x0 BETWEEN t.x0 AND t.x1) AS bold_header FROM handled t),
goes AS (SELECT a.doc_id, a.page, a.table_idx, a.handler, f.page AS next_page, CASE a.handler
  WHEN 'dql' THEN w >= f.top - 5 AND f.seg = a.seg WHEN 'revision' THEN w >= f.top - 5 AND f.seg = a.seg AND len(f.cells[1]) <= 3 AND NOT contains(f.full3, 'Mechanism of Action') AND NOT contains(f.full0, 'HCPCS') AND NOT contains(f.full0, 'CPT') AND f.first <> 'Product'
  WHEN 'fda_dosing' THEN abs(f.x0 - a.x0) < 10 AND f.top < 140 AND w >= f.top - 5 WHEN 'titled_generic' THEN f.seg = a.seg AND a.bold_header AND abs(f.x0 - a.x0) < 10 AND f.top < 140 AND w >= f.top - 5 WHEN 'known_kw' THEN f.seg = a.seg AND a.bold_header AND abs(f.x0 - a.x0) < 10 AND f.top < 140 AND w >= f.top - 5
  WHEN 'moa' THEN f.seg = a.seg AND abs(f.x0 - a.x0) < 10 AND f.top < 120 AND (len(f.cells[1]) = len(a.cells[1]) OR len(f.cells[1]) = 3) WHEN 'criteria' THEN f.seg = a.seg AND abs(f.x0 - a.x0) < 10 AND f.top < 140 WHEN 'rev_flex' THEN true ELSE false END AS ok
  FROM bh a JOIN firsts f ON f.doc_id = a.doc_id AND f.page > a.page JOIN wordtop ON wordtop.doc_id = f.doc_id AND wordtop.page = f.page),
ended AS (SELECT t.doc_id, t.page, t.table_idx, t.handler, coalesce((SELECT min(p) FROM range(t.page + 1, t.page + 9) AS x(p) WHERE NOT EXISTS (SELECT 1 FROM goes g WHERE g.doc_id = t.doc_id AND g.page = t.page AND g.table_idx = t.table_idx AND g.next_page = p AND g.ok)), t.page + 9) AS stop FROM handled t)
"""


def _stitched(spark, d):
    """Tables stitched over pages; sections change between pages 2 and 3 of every fourth document."""
    segment = F.when((F.col("doc_id") % 4 == 1) & (F.col("page") > 2), "Coding").otherwise("Overview")
    return B.stitch(_handled(spark, d).withColumn("segment", segment))


@query(f"WITH {HANDLER_SQL}, {_FIRSTS} SELECT doc_id, page, table_idx, CASE WHEN handler IN ('dql', 'fda_dosing', 'rev_flex') THEN least(stop - page - 1, 1) ELSE stop - page - 1 END AS n_consumed FROM ended")
def page_stitching(spark, d):
    return _stitched(spark, d).select(*KEYS, F.size("consumed").alias("n_consumed"))


# from the top of the document: a table that stays takes the pages of its chain, and their first tables go
_KEPT = f"""{_FIRSTS},
taken AS (SELECT e.*, t.page = t.page AND t.table_idx = (SELECT min(x.table_idx) FROM handled x WHERE x.doc_id = t.doc_id AND x.page = t.page) AS is_first, row_number() OVER (PARTITION BY e.doc_id ORDER BY e.page, e.table_idx) AS k,
  range(e.page + 1, e.page + 1 + CASE WHEN e.handler IN ('dql', 'fda_dosing', 'rev_flex') THEN least(stop - e.page - 1, 1) ELSE stop - e.page - 1 END) AS eats FROM ended e JOIN handled t USING (doc_id, page, table_idx)),
walk AS (SELECT doc_id, page, table_idx, handler, k, true AS stays, eats AS gone FROM taken WHERE k = 1
  UNION ALL SELECT t.doc_id, t.page, t.table_idx, t.handler, t.k, NOT (t.is_first AND list_contains(w.gone, t.page)), CASE WHEN t.is_first AND list_contains(w.gone, t.page) THEN w.gone ELSE list_concat(w.gone, t.eats) END FROM walk w JOIN taken t ON t.doc_id = w.doc_id AND t.k = w.k + 1)
"""


@query(f"WITH RECURSIVE {HANDLER_SQL}, {_KEPT} SELECT doc_id, page, table_idx, handler FROM walk WHERE stays")
def consumed_antijoin(spark, d):
    return B.unconsumed(_stitched(spark, d)).select(*KEYS, "handler")


def _sql_lines(*lines: str) -> str:
    return " || chr(10) || ".join(lines)


def _built(spark, d):
    return H.built(B.unconsumed(B.stitch(B.buildable(_handled(spark, d)).withColumn("segment", F.expr(_SEG.replace(" AS seg", ""))))))


@query()
def built_tables(spark, d):
    return _built(spark, d).select(*KEYS, "handler", "table_type", "title", "html")


# what is built, with the rows that a table's body shows: those with anything in them below the header, or all where no bold header is found; a
# quantity table of one product has one row and one for each row after the first of the next page
_CASCADE = HANDLER_SQL[HANDLER_SQL.index("CASE WHEN first = 'Type of Revision' THEN 'revision' WHEN contains(lower(title)") : HANDLER_SQL.index(" AS handler,")]
_TICKS = _CASCADE[_CASCADE.index("WHEN tiny_cols >= 4") : _CASCADE.index("\n  WHEN len([c for c in cells[1] if", _CASCADE.index("WHEN tiny_cols >= 4"))]
# no tick stands in these tables, so the tick matrix shows nothing and the next handler takes them
_BUILDABLE = HANDLER_SQL.replace(" AS handler,", f" AS handler, {_CASCADE.replace(_TICKS, '')} AS next_handler,").replace("handled AS (", "every_handled AS (") + ", handled AS (SELECT * FROM every_handled WHERE buildable)"
_ROWS_SQL = f"""{_BUILDABLE}, {_KEPT},
stayed AS (SELECT w.doc_id, w.page, w.table_idx, CASE WHEN w.handler = 'availability' THEN b.next_handler ELSE w.handler END AS handler, t.eats, b.bold_header, b.cells FROM walk w JOIN taken t USING (doc_id, page, table_idx) JOIN bh b USING (doc_id, page, table_idx) WHERE w.stays),
more AS (SELECT s.doc_id, s.page, s.table_idx, flatten(list(f.cells ORDER BY f.page)) AS rest FROM stayed s JOIN firsts f ON f.doc_id = s.doc_id AND list_contains(s.eats, f.page) GROUP BY ALL),
whole AS (SELECT s.*, list_concat(s.cells, coalesce(m.rest, [])) AS rows_ FROM stayed s LEFT JOIN more m USING (doc_id, page, table_idx)),
shown AS (SELECT *, len([r for r in rows_ if len([c for c in r if {_SHUT} <> '']) > 0]) - CASE WHEN handler IN ('known_kw', 'titled_generic', 'catch_all') AND NOT bold_header THEN 0 WHEN len([c for c in rows_[1] if {_SHUT} <> '']) > 0 THEN 1 ELSE 0 END AS n_rows FROM whole)
"""


@query(f"WITH RECURSIVE {_ROWS_SQL} SELECT doc_id, page, table_idx, handler, n_rows FROM shown WHERE handler NOT IN ('revision', 'rev_flex', 'dql', 'availability', 'moa', 'fda_dosing')")
def built_rows(spark, d):
    found = _built(spark, d).where("handler not in ('revision', 'rev_flex', 'dql', 'availability', 'moa', 'fda_dosing')")
    body = F.regexp_extract("html", r"(?s)<tbody>(.*)</tbody>", 1)
    return found.select(*KEYS, "handler", F.regexp_count(body, F.lit("</tr>")).alias("n_rows"))


_E = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


def _l(text: str) -> str:
    return "'" + text.replace("\n", "' || chr(10) || '") + "'"


@query(
    f"""WITH RECURSIVE {_ROWS_SQL},
    revs AS (SELECT * FROM whole WHERE handler IN ('revision', 'rev_flex')),
    rr AS (SELECT doc_id, page, table_idx, generate_subscripts(rows_, 1) - 1 AS r, unnest(rows_) AS row FROM revs),
    rc AS (SELECT doc_id, page, table_idx, r, replace(trim(coalesce(row[1], '')), chr(10), ' ') AS c0, replace(trim(coalesce(row[2], '')), chr(10), ' ') AS c1, replace(trim(coalesce(row[3], '')), chr(10), ' ') AS c2 FROM rr),
    rf AS (SELECT *, coalesce(last_value(CASE WHEN r > 0 THEN nullif(c0, '') END IGNORE NULLS) OVER (PARTITION BY doc_id, page, table_idx ORDER BY r), '') AS kind FROM rc),
    rh AS (SELECT doc_id, page, table_idx, max(CASE WHEN r = 0 THEN '     <th>' || {_E.format("c0")} || '</th>' || chr(10) || '     <th>' || {_E.format("c1")} || '</th>' || chr(10) || '     <th>' || {_E.format("c2")} || '</th>' END) AS head,
      string_agg(CASE WHEN r > 0 AND (c0 <> '' OR c1 <> '' OR c2 <> '') THEN {_l("    <tr>" + chr(10) + H.TOP_CELL)} || {_E.format("kind")} || {_l("</td>" + chr(10) + H.TOP_CELL)} || {_E.format("c1")} || {_l("</td>" + chr(10) + H.DATE_CELL)} || {_E.format("c2")} || {_l("</td>" + chr(10) + "    </tr>")} END, chr(10) ORDER BY r) AS body FROM rf GROUP BY ALL)
    SELECT doc_id, page, table_idx, {_l(G.TABLE_OPEN + chr(10) + "   <thead>" + chr(10) + G.HEAD_ROW + chr(10))} || head || {_l(chr(10) + "    </tr>" + chr(10) + "   </thead>" + chr(10) + "   <tbody>" + chr(10))} || body || {_l(chr(10) + "   </tbody>" + chr(10) + "  </table>")} AS html FROM rh WHERE body IS NOT NULL"""
)
def built_revisions(spark, d):
    return _built(spark, d).where("table_type = 'revision'").select(*KEYS, "html")


def _frame(head: str, body: str) -> str:
    """SQL of a table from the SQL of its labels and of its rows."""
    return f"""{_l(G.TABLE_OPEN + chr(10) + "   <thead>" + chr(10) + G.HEAD_ROW + chr(10))} || {head} || {_l(chr(10) + "    </tr>" + chr(10) + "   </thead>" + chr(10) + "   <tbody>" + chr(10))} || {body} || {_l(chr(10) + "   </tbody>" + chr(10) + "  </table>")}"""


_TD, _END = _l(H.TOP_CELL), _l("</td>" + chr(10))
_ONE = "replace(trim(coalesce({0}, '')), chr(10), ' ')"
_MOA_WORDS = _q(w for w in G.MOA_HEADER_WORDS)


# mechanisms of action: headings and rows with what goes on in their last cell
@query(
    f"""WITH RECURSIVE {_ROWS_SQL},
    mr AS (SELECT doc_id, page, table_idx, generate_subscripts(rows_, 1) - 1 AS r, unnest(rows_) AS row FROM whole WHERE handler = 'moa'),
    mc AS (SELECT *, trim(coalesce(row[1], '')) AS c0, [{_ONE.format("c")} for c in row if {_SHUT} <> ''] AS f, trim(coalesce(row[1], '')) <> '' OR trim(coalesce(row[2], '')) <> '' AS low FROM mr),
    mh AS (SELECT *, c0 = '' AND len(f) = 1 AND low AS headish FROM mc),
    mb AS (SELECT doc_id, page, table_idx, coalesce(min(r) FILTER (r >= 1 AND c0 <> '' AND lower(c0) NOT IN ({_MOA_WORDS})), 3) AS start FROM mh GROUP BY ALL),
    ms AS (SELECT doc_id, page, table_idx, coalesce(max(r) FILTER (r < start AND (r < 1 OR NOT headish)), -1) AS barrier FROM mh JOIN mb USING (doc_id, page, table_idx) GROUP BY ALL),
    md AS (SELECT mh.*, row_number() OVER (PARTITION BY doc_id, page, table_idx ORDER BY r) = 1 AS leads FROM mh JOIN ms USING (doc_id, page, table_idx) WHERE r > barrier AND len(f) > 0),
    mg AS (SELECT *, sum((headish OR c0 <> '' OR leads)::INT) OVER (PARTITION BY doc_id, page, table_idx ORDER BY r) AS g FROM md),
    ma AS (SELECT doc_id, page, table_idx, g, arg_min(headish, r) AS heading, arg_min(f, r) AS f, list(array_to_string(f, ' ') ORDER BY r) AS texts FROM mg GROUP BY ALL),
    ml AS (SELECT *, array_to_string([{_E.format("x")} for x in list_concat([coalesce(f[3], '')], texts[2:]) if x <> ''], '<br>') AS last FROM ma),
    mt AS (SELECT doc_id, page, table_idx, string_agg(CASE WHEN heading THEN {_l(G.HEAD_ROW + chr(10) + H.MOA_GROUP)} || {_E.format("f[1]")} || {_l("</td>" + chr(10) + "    </tr>")}
      ELSE {_l("    <tr>" + chr(10))} || {_TD} || {_E.format("f[1]")} || {_END} || {_TD} || {_E.format("coalesce(f[2], '')")} || {_END} || {_TD} || last || {_END} || '    </tr>' END, chr(10) ORDER BY g) AS body FROM ml GROUP BY ALL)
    SELECT doc_id, page, table_idx, {_frame("(" + " || chr(10) || ".join(_l(f"     <th>{h}</th>") for h in H.MOA_HEADERS) + ")", "body")} AS html FROM mt"""
)
def built_moa(spark, d):
    return _built(spark, d).where("handler = 'moa'").select(*KEYS, "html")


_DQL_WORDS = _q([*G.DQL_HEADER_WORDS, ""])
_LINES_OF = f"array_to_string([{_E.format('trim(x)')} for x in string_split({{0}}, chr(10)) if trim(x) <> ''], '<br>')"
_JOIN_OF = f"array_to_string([{_E.format('x')} for x in [{{0}}] if x <> ''], '<br>')"


def _at_sql(rows: str, r: int, c: int) -> str:
    return _ONE.format(f"{rows}[{r + 1}][{c + 1}]")


# quantity limits: the rows above the first one with a product of its own make the header, and a product spans the rows below it; with a header of
# one row the places of a table of one product count
@query(
    f"""WITH RECURSIVE {_ROWS_SQL},
    dq AS (SELECT w.doc_id, w.page, w.table_idx, w.cells AS own, coalesce(m.rest, []) AS more, list_max([len(r) for r in w.cells]) AS width FROM whole w LEFT JOIN more m USING (doc_id, page, table_idx) WHERE handler = 'dql'),
    ds AS (SELECT *, coalesce(list_min([i for i in range(1, len(own) + 1) if trim(coalesce(own[i][1], '')) <> '' AND len([x for x in regexp_split_to_array(lower(trim(own[i][1])), '\\s+') if x NOT IN ({_DQL_WORDS})]) > 0]) - 1, 1) AS start FROM dq),
    dl AS (SELECT *, [array_to_string([trim(coalesce(r[c], '')) for r in own[1:start] if trim(coalesce(r[c], '')) <> ''], ' ') for c in range(1, width + 1)] AS labels, list_concat(own[start + 1:], [r[1:width] for r in more if len([c for c in r if {_SHUT} <> '']) > 0]) AS rows2 FROM ds WHERE start > 1),
    dr AS (SELECT doc_id, page, table_idx, labels, width, generate_subscripts(rows2, 1) AS i, unnest(rows2) AS row, len(rows2) AS n FROM dl),
    df AS (SELECT *, trim(coalesce(row[1], '')) <> '' AS filled, lead(CASE WHEN trim(coalesce(row[1], '')) <> '' THEN i END IGNORE NULLS) OVER (PARTITION BY doc_id, page, table_idx ORDER BY i) AS next_filled FROM dr),
    dx AS (SELECT *, CASE WHEN filled THEN coalesce(next_filled, n + 1) - i ELSE 0 END AS span FROM df),
    dh AS (SELECT doc_id, page, table_idx, any_value(labels) AS labels, string_agg({_l("    <tr>" + chr(10))} || CASE WHEN span = 0 THEN '' ELSE {_l(H.TOP_CELL[:-1])} || CASE WHEN span > 1 THEN ' rowspan="' || span || '"' ELSE '' END || '>' || {_E.format("trim(row[1])")} || {_END} END
      || array_to_string([{_TD} || {_E.format("trim(coalesce(row[c], ''))")} || {_END} for c in range(2, width + 1)], '') || '    </tr>', chr(10) ORDER BY i) FILTER (len([c for c in row[1:width] if {_SHUT} <> '']) > 0) AS body FROM dx GROUP BY ALL)
    SELECT doc_id, page, table_idx, {_frame(f"array_to_string(['     <th>' || {_E.format('x')} || '</th>' for x in labels], chr(10))", "body")} AS html FROM dh
    UNION ALL SELECT doc_id, page, table_idx, {_frame(f"array_to_string(['     <th>' || {_E.format('x')} || '</th>' for x in [{_at_sql('own', 0, 0)}, {_at_sql('own', 0, 1)}, trim({_at_sql('own', 0, 3)} || ' ' || {_at_sql('own', 1, 3)})]], chr(10))",
      f"array_to_string(list_concat([{_l('    <tr>' + chr(10))} || {_TD} || " + _LINES_OF.format("coalesce(own[3][1], '') || chr(10) || coalesce(more[1][1], '')") + f" || {_END} || {_TD} || " + _JOIN_OF.format(", ".join(_at_sql("own", r, 1) for r in (2, 3, 4))) + f" || {_END} || {_TD} || " + _JOIN_OF.format(", ".join(_at_sql("own", r, 2) for r in (2, 2, 4))) + f" || {_END} || '    </tr>'], ["
      + f"{_l('    <tr>' + chr(10) + '     <td>')} || " + _E.format(_ONE.format("r[1]")) + f" || {_l('</td>' + chr(10) + '     <td>')} || " + _LINES_OF.format("coalesce(r[2], '')") + f" || {_l('</td>' + chr(10) + '     <td>')} || " + _E.format(_ONE.format("r[3]")) + f" || {_l('</td>' + chr(10) + '    </tr>')} for r in more[2:] if trim(coalesce(r[1], '')) <> '' OR trim(coalesce(r[2], '')) <> '' OR trim(coalesce(r[3], '')) <> '']), chr(10))")} AS html FROM ds WHERE start = 1"""
)
def built_limits(spark, d):
    return _built(spark, d).where("handler = 'dql'").select(*KEYS, "html")


@query(f"WITH {grids.GRIDS_SQL} SELECT t.doc_id, t.page, t.table_idx, (SELECT max(r.bottom) FROM grects r WHERE r.doc_id = t.doc_id AND r.page = t.page AND r.fill AND (r.r + r.g + r.b) / 3 BETWEEN 0.3 AND 0.98 AND r.top >= t.top - 2 AND r.bottom <= t.bottom + 2) AS gray_bottom FROM tables t")
def gray_bottom(spark, d):
    t, _, r = _all(spark, d)
    return B.gray_bottom(t, r).select(*KEYS, "gray_bottom")


@query(f"WITH {grids.GRIDS_SQL}, tt AS (SELECT t.doc_id, t.page, t.table_idx, coalesce((SELECT string_agg(w.text, ' ' ORDER BY w.top, w.x0, w.word_idx) FROM gwords w WHERE w.doc_id = t.doc_id AND w.page = t.page AND contains(w.fontname, 'Bold') AND w.top < t.top AND t.top - w.top <= 20 AND abs(w.size - (SELECT arg_max(n.size, (n.top, -n.word_idx)) FROM gwords n WHERE n.doc_id = t.doc_id AND n.page = t.page AND contains(n.fontname, 'Bold') AND n.top < t.top AND t.top - n.top <= 20)) <= 1), '') AS title FROM tables t) SELECT doc_id, page, table_idx, {_NORM} AS title FROM tt")
def title_words_above(spark, d):
    t, w, _ = _all(spark, d)
    return B.corpus_titles(t, w).select(*KEYS, "title")


@query(f"WITH {TYPE_SQL}, n AS (SELECT doc_id, page, table_idx, top, CASE WHEN table_idx = 0 THEN '' ELSE 'own' END AS title FROM tables), k AS (SELECT doc_id, page, round_even(round(top, 1), 0) AS rt, arg_max(title, table_idx) AS dt FROM typed GROUP BY ALL) SELECT n.doc_id, n.page, n.table_idx, coalesce(nullif(n.title, ''), k.dt, '') AS title FROM n LEFT JOIN k ON k.doc_id = n.doc_id AND k.page = n.page AND k.rt = round_even(n.top, 0)")
def title_backfill(spark, d):
    nodes = _tables(spark, d).select(*KEYS, F.col("bbox.top").alias("top"), F.when(F.col("table_idx") == 0, F.lit("")).otherwise(F.lit("own")).alias("title"))
    return B.backfill_titles(nodes, _detected(spark, d)).select(*KEYS, "title")


def _walk(heading: str) -> str:
    return f"""{grids.GRIDS_SQL},
above AS (SELECT t.doc_id, t.page, t.table_idx, w.top, w.x0, w.text, w.size, contains(w.fontname, 'Bold') AS bold, row_number() OVER (PARTITION BY t.doc_id, t.page, t.table_idx ORDER BY w.top DESC, w.x0 DESC, w.text DESC, w.size DESC) AS k
  FROM tables t JOIN gwords w ON w.doc_id = t.doc_id AND w.page = t.page AND w.top < t.top),
walk AS (SELECT doc_id, page, table_idx, 0::BIGINT AS k, false AS stop, top AS at, NULL::DOUBLE AS x, NULL::DOUBLE AS sz, ''  AS text FROM tables
  UNION ALL SELECT a.doc_id, a.page, a.table_idx, a.k, w.at - a.top > 20 OR NOT a.bold OR coalesce({heading}, false), a.top, a.x0, a.size, a.text
  FROM walk w JOIN above a ON a.doc_id = w.doc_id AND a.page = w.page AND a.table_idx = w.table_idx AND a.k = w.k + 1 WHERE NOT w.stop),
got AS (SELECT * FROM walk WHERE k > 0 AND NOT stop),
level AS (SELECT g.*, (SELECT max(o.at) FROM got o WHERE o.doc_id = g.doc_id AND o.page = g.page AND o.table_idx = g.table_idx AND abs(o.at - g.at) <= 6) AS l FROM got g),
named AS (SELECT doc_id, page, table_idx, string_agg(text, ' ' ORDER BY l, x, text) AS title FROM level GROUP BY ALL)
SELECT doc_id, page, table_idx, substr(coalesce(title, ''), 1, 80) AS title FROM tables LEFT JOIN named USING (doc_id, page, table_idx)"""


def _walked(spark, d, same_size: bool):
    t, w, _ = _all(spark, d)
    lines = w.select("doc_id", "page", "top", "x0", "text", "size", F.col("fontname").contains("Bold").alias("bold"))
    return B.walked_titles(t, lines, same_size=same_size).select(*KEYS, "title")


@query("WITH RECURSIVE " + _walk("length(a.text) < 30 AND abs(a.x0 - w.x) < 5 AND a.size > w.sz + 0.5"))
def title_walk(spark, d):
    return _walked(spark, d, False)


@query("WITH RECURSIVE " + _walk("abs(a.size - w.sz) > 1"))
def title_walk_same_size(spark, d):
    return _walked(spark, d, True)


# Grids -------------------------------------------------------------------------------------------

_GROWS = f"{grids.GRIDS_SQL}, grows AS (SELECT doc_id, page, table_idx, generate_subscripts(cells, 1) - 1 AS r, unnest(cells) AS row FROM tables)"
_CELL = "trim(coalesce({0}, ''))"
_SHAPE = f"""{_GROWS},
flat AS (SELECT doc_id, page, table_idx, r, generate_subscripts(row, 1) - 1 AS c, trim(coalesce(unnest(row), '')) AS v FROM grows),
cols AS (SELECT doc_id, page, table_idx, c, max(CASE WHEN r = 0 THEN v ELSE '' END) AS label, max(CASE WHEN r > 0 AND v <> '' THEN 1 ELSE 0 END) AS data FROM flat GROUP BY ALL),
near AS (SELECT *, lag(data) OVER w AS ldata, lag(label) OVER w AS llabel, lead(label) OVER w AS rlabel, lead(data) OVER w AS rdata FROM cols WINDOW w AS (PARTITION BY doc_id, page, table_idx ORDER BY c)),
maps AS (SELECT *, CASE WHEN label <> '' AND data = 0 AND ldata = 1 AND llabel = '' THEN '' WHEN label = '' AND data = 1 AND rlabel <> '' AND rdata = 0 THEN rlabel ELSE label END AS shown FROM near),
header AS (SELECT doc_id, page, table_idx, coalesce(list(shown ORDER BY c) FILTER (shown <> ''), list('' ORDER BY c) FILTER (label <> '' OR data = 1), list('' ORDER BY c)) AS labels FROM maps GROUP BY ALL),
filled AS (SELECT doc_id, page, table_idx, r, coalesce(list(v ORDER BY c) FILTER (v <> ''), []) AS vs, count(*) AS n, max(CASE WHEN c = 0 THEN v END) AS v0 FROM flat GROUP BY ALL)
"""


@query(f"""WITH {_SHAPE} SELECT doc_id, page, table_idx, r, CASE WHEN r = 0 THEN 'header' WHEN len(vs) = 1 AND n > 1 AND v0 = '' THEN 'group' ELSE 'data' END AS kind,
    array_to_string(CASE WHEN r = 0 THEN labels WHEN len(vs) = 1 AND n > 1 AND v0 = '' THEN vs ELSE list_concat(vs, list_transform(range(len(labels)), lambda i: ''))[1:len(labels)] END, '|') AS row_values
    FROM filled JOIN header USING (doc_id, page, table_idx) WHERE r = 0 OR len(vs) > 0""")
def left_compact_rows(spark, d):
    return G.generic_rows(_tables(spark, d)).select(*KEYS, "r", "kind", F.array_join("values", "|").alias("row_values"))


def _sql(text: str) -> str:
    return "'" + text.replace("\n", "' || chr(10) || '") + "'"


_ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query(f"""WITH {_SHAPE}, k AS (SELECT doc_id, page, table_idx, r, len(labels) AS n_cols, CASE WHEN r = 0 THEN 'header' WHEN len(vs) = 1 AND n > 1 AND v0 = '' THEN 'group' ELSE 'data' END AS kind, labels, vs FROM filled JOIN header USING (doc_id, page, table_idx) WHERE r = 0 OR len(vs) > 0),
    v AS (SELECT *, CASE kind WHEN 'header' THEN labels WHEN 'group' THEN vs ELSE list_concat(vs, list_transform(range(n_cols), lambda i: ''))[1:n_cols] END AS vals FROM k),
    l AS (SELECT *, CASE kind WHEN 'header' THEN {_sql("   <thead>" + chr(10) + G.HEAD_ROW + chr(10))} || array_to_string(list_transform(vals, lambda x: '     <th>' || {_ESC.format("x")} || '</th>'), chr(10)) || {_sql(chr(10) + "    </tr>" + chr(10) + "   </thead>" + chr(10) + "   <tbody>")}
      WHEN 'group' THEN '{G.GROUP_ROW}<td colspan="' || n_cols || '" style="font-weight:bold">' || {_ESC.format("vals[1]")} || '</td></tr>'
      ELSE '    <tr>' || chr(10) || array_to_string(list_transform(vals, lambda x: '     <td style="vertical-align:top">' || {_ESC.format("x")} || '</td>'), chr(10)) || chr(10) || '    </tr>' END AS line FROM v)
    SELECT doc_id, page, table_idx, {_sql(G.TABLE_OPEN + chr(10))} || string_agg(line, chr(10) ORDER BY r) || {_sql(chr(10) + "   </tbody>" + chr(10) + "  </table>")} AS html FROM l GROUP BY doc_id, page, table_idx""")
def render_generic(spark, d):
    return G.render_generic(G.generic_rows(_tables(spark, d)))


_HW = _q([*G.DQL_HEADER_WORDS, ""])


@query(f"""WITH {_GROWS}, s AS (SELECT t.doc_id, t.page, t.table_idx, coalesce((SELECT min(r) FROM grows g WHERE g.doc_id = t.doc_id AND g.page = t.page AND g.table_idx = t.table_idx AND len([w for w in string_split(lower({_CELL.format('g.row[1]')}), ' ') if w NOT IN ({_HW})]) > 0), 1) AS data_start, cells FROM tables t)
    SELECT doc_id, page, table_idx, data_start, array_to_string(list_transform(range(1, list_max([len(r) for r in cells]) + 1), lambda i: array_to_string([trim(coalesce(r[i], '')) for r in cells[1:data_start] if trim(coalesce(r[i], '')) <> ''], ' ')), '|') AS header FROM s""")
def header_collapse(spark, d):
    return G.collapse_header(_tables(spark, d)).select(*KEYS, "data_start", F.array_join("header", "|").alias("header"))


@query(f"WITH {_GROWS}, s AS (SELECT *, sum(CASE WHEN {_CELL.format('row[1]')} <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page, table_idx ORDER BY r) AS g FROM grows) SELECT doc_id, page, table_idx, r, CASE WHEN {_CELL.format('row[1]')} <> '' THEN count(*) OVER (PARTITION BY doc_id, page, table_idx, g) ELSE 0 END AS rowspan FROM s")
def rowspan(spark, d):
    return G.rowspans(G.grid_rows(_tables(spark, d))).select(*KEYS, "r", "rowspan")


def _picks(*cells: str) -> str:
    return "array_to_string([x for x in [" + ", ".join(_CELL.format(c) for c in cells) + "] if x <> ''], '|')"


@query(f"WITH {grids.GRIDS_SQL} SELECT doc_id, page, table_idx, {_CELL.format('cells[3][1]')} AS product, {_picks('cells[3][2]', 'cells[4][2]', 'cells[5][2]')} AS strengths, {_picks('cells[3][3]', 'cells[3][3]', 'cells[5][3]')} AS quantities FROM tables")
def dql_layout(spark, d):
    return G.dql_layout(_tables(spark, d)).select(*KEYS, "product", F.array_join("strengths", "|").alias("strengths"), F.array_join("quantities", "|").alias("quantities"))


@query(f"WITH {_GROWS}, k AS (SELECT doc_id, page, table_idx, r, {_CELL.format('row[1]')} AS c0, {_CELL.format('row[2]')} AS c1, {_CELL.format('row[3]')} AS c2 FROM grows WHERE r > 0) SELECT doc_id, page, table_idx, r, coalesce(last_value(nullif(c0, '') IGNORE NULLS) OVER (PARTITION BY doc_id, page, table_idx ORDER BY r), '') AS c0, c1, c2 FROM k WHERE c0 <> '' OR c1 <> '' OR c2 <> ''")
def forward_fill(spark, d):
    return G.revision_rows(G.grid_rows(_tables(spark, d)))


def _parts(spark, d):
    c = lambda i: F.trim(F.coalesce(F.get("row", F.lit(i)), F.lit("")))
    r = G.grid_rows(_tables(spark, d)).where("r > 0")
    wrap = (F.col("r") == 3) & (F.col("doc_id") % 2 == 0)
    return r.select(*KEYS, F.expr("cast((r - 1) div 2 as int)").alias("part"), "r", F.when(wrap, F.lit("")).otherwise(c(0)).alias("c0"), c(1).alias("c1"), F.when(wrap, F.lit("")).otherwise(c(2)).alias("c2"))


@query(f"""WITH {_GROWS}, p AS (SELECT doc_id, page, table_idx, (r - 1) // 2 AS part, r, CASE WHEN r = 3 AND doc_id % 2 = 0 THEN '' ELSE {_CELL.format('row[1]')} END AS c0, {_CELL.format('row[2]')} AS c1, CASE WHEN r = 3 AND doc_id % 2 = 0 THEN '' ELSE {_CELL.format('row[3]')} END AS c2 FROM grows WHERE r > 0),
    w AS (SELECT *, (part > 0 AND r % 2 = 1 AND c0 = '' AND c2 = '' AND c1 <> '') AS wraps FROM p), g AS (SELECT *, sum(CASE WHEN wraps THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page, table_idx ORDER BY r) AS n FROM w)
    SELECT doc_id, page, table_idx, arg_min(part, r) AS part, min(r) AS r, arg_min(c0, r) AS c0, trim(string_agg(c1, ' ' ORDER BY r)) AS c1, arg_min(c2, r) AS c2 FROM g GROUP BY doc_id, page, table_idx, n""")
def wrap_merge(spark, d):
    return G.merge_wrapped(_parts(spark, d))


def _matrices(spark, d):
    """Tick matrices made of suppliers: three drugs with names backwards in row 0, ticks one column left of them."""
    s = spark.read.parquet(f"{d}/supplier.parquet")
    k = F.col("s_suppkey")
    name = lambda t: F.reverse(F.lit(t))
    tick = lambda on: F.when(on, F.lit(G.TICK)).otherwise(F.lit(""))
    none = F.lit(None).cast("string")
    head = F.array(none, none, none, name("alphamab-"), name("xyz"), none, name("betamab"))
    second = F.array(*[none] * 7)
    row = lambda form, dose, i: F.array(form, dose, tick((k + i) % 2 == 0), none, none, tick((k + i) % 3 == 0), none)
    rows = F.array(head, second, row(F.lit("SFP"), F.lit("10 mg"), 0), row(none, F.lit("20\nmg"), 1), row(F.lit("laiV"), none, 2), row(F.lit("ebuT"), F.lit("30 mg"), 3))
    return s.select(k.alias("doc_id"), F.lit(1).alias("page"), F.lit(0).alias("table_idx"), rows.alias("cells"))


@query("""WITH f(r, type, dosage) AS (VALUES (2, 'PFS', '10 mg'), (3, 'PFS', '20 mg'), (5, 'Tube', '30 mg')), g(drug, m) AS (VALUES ('alphamab-xyz', 2), ('betamab', 3)),
    x AS (SELECT s_suppkey AS doc_id, r, type, dosage, drug, m, (s_suppkey + r - 2) % m = 0 AS hit FROM supplier, f, g)
    SELECT doc_id, 1 AS page, 0 AS table_idx, r, type, dosage, drug, CASE WHEN hit THEN '✓' ELSE '' END AS mark FROM x
    WHERE EXISTS (SELECT 1 FROM range(4) AS i(n) WHERE (doc_id + n) % m = 0)""")
def availability_matrix(spark, d):
    return G.availability(_matrices(spark, d))


def _moa(spark, d):
    """Mechanism tables made of nations: a header, headings, wrapped rows."""
    s = spark.read.parquet(f"{d}/supplier.parquet")
    none, lit = F.lit(None).cast("string"), F.lit
    rows = F.array(
        F.array(lit(""), lit("Mechanism of Action"), lit("Examples")), F.array(none, F.concat(lit("Group "), F.col("s_nationkey").cast("string")), none),
        F.array(F.col("s_name"), lit("first"), lit("one")), F.array(none, none, F.when(F.col("s_suppkey") % 2 == 0, lit("two"))),
        F.array(none, lit("Second group"), none), F.array(none, none, lit("lost")), F.array(lit("x"), none, lit("y & z")),
    )
    return s.select(F.col("s_suppkey").alias("doc_id"), lit(1).alias("page"), lit(0).alias("table_idx"), rows.alias("cells"))


@query("""SELECT s_suppkey AS doc_id, 1 AS page, 0 AS table_idx, unnest([1, 2, 4, 6]) AS r, unnest(['heading', 'data', 'heading', 'data']) AS kind,
    unnest(['Group ' || CAST(s_nationkey AS VARCHAR), s_name || '|first|one' || CASE WHEN s_suppkey % 2 = 0 THEN '<br>two' ELSE '' END, 'Second group', 'x|y & z|']) AS row_values FROM supplier""")
def moa_rows(spark, d):
    return G.moa_rows(_moa(spark, d)).select(*KEYS, "r", "kind", F.array_join("values", "|").alias("row_values"))


def _steps(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    steps = li.groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("r")).agg(F.min(F.when(F.col("l_returnflag") == "N", 2).otherwise(0)).alias("starts_at"))
    return steps.select("doc_id", F.lit(1).alias("page"), F.lit(0).alias("table_idx"), "r", (100.0 + 20 * F.col("r")).alias("top"), "starts_at", F.lit(2).alias("dose_col"))


@query("""WITH s AS (SELECT l_orderkey AS doc_id, l_linenumber AS r, 100.0 + 20 * l_linenumber AS top, bool_or(l_returnflag <> 'N') AS is_full FROM lineitem GROUP BY l_orderkey, l_linenumber),
    p AS (SELECT *, last_value(CASE WHEN is_full THEN r END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY r) AS parent FROM s)
    SELECT doc_id, r, parent, CASE WHEN is_full THEN min(CASE WHEN NOT is_full THEN top END) OVER (PARTITION BY doc_id, parent) END AS clip FROM p""")
def subrow_parent(spark, d):
    return G.subrow_parents(_steps(spark, d)).select("doc_id", "r", "parent", "clip")


def _chars(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("doc_id"), F.lit(1).alias("page"), F.posexplode(F.split("p_name", "")).alias("char_idx", "text")).where("text <> ''")
    x, line = F.col("char_idx") % 6, F.expr("char_idx div 6")
    return p.select("doc_id", "page", "char_idx", F.when((x == 0) & (line == 1), "•").otherwise(F.col("text")).alias("text"), (5.0 * x).alias("x0"), (5.0 * x + 5).alias("x1"), (100.0 + 12 * line).alias("top"), (108.0 + 12 * line).alias("bottom"))


@query("""WITH p AS (SELECT p_partkey AS doc_id, p_name, generate_subscripts(string_split(p_name, ''), 1) - 1 AS i, unnest(string_split(p_name, '')) AS ch FROM part),
    c AS (SELECT doc_id, i, i % 6 AS x, i // 6 AS ln, CASE WHEN i = 6 THEN '•' ELSE ch END AS ch FROM p),
    u AS (SELECT *, doc_id % 2 = 0 AND ln = 0 AND x BETWEEN 2 AND 3 AS un FROM c),
    g AS (SELECT *, CASE WHEN lag(un) OVER w IS NOT DISTINCT FROM un THEN 0 ELSE 1 END AS st FROM u WINDOW w AS (PARTITION BY doc_id, ln ORDER BY x)),
    n AS (SELECT *, sum(st) OVER (PARTITION BY doc_id, ln ORDER BY x) AS run FROM g),
    t AS (SELECT doc_id, ln, run, CASE WHEN un THEN '<u>' || string_agg(ch, '' ORDER BY x) || '</u>' ELSE string_agg(ch, '' ORDER BY x) END AS m FROM n GROUP BY doc_id, ln, run, un),
    l AS (SELECT doc_id, ln, string_agg(m, '' ORDER BY run) AS m FROM t GROUP BY doc_id, ln)
    SELECT doc_id, string_agg(CASE WHEN ln = 0 THEN m WHEN starts_with(m, '•') THEN '<br>' || m ELSE ' ' || m END, '' ORDER BY ln) AS text FROM l GROUP BY doc_id""")
def char_assembly(spark, d):
    chars = _chars(spark, d)
    rules = chars.select("doc_id", "page").distinct().where("doc_id % 2 = 0").select("doc_id", "page", F.lit(10.0).alias("x0"), F.lit(20.0).alias("x1"), F.lit(109.0).alias("top"))
    return G.assemble_chars(chars, rules).select("doc_id", "text")


def _dosing(spark, d):
    keep = Stages(spark, "dosing")
    pages = keep(grids.dosing_pages(spark.read.parquet(f"{d}/part.parquet")), "pages")
    detected = keep(B.detect_pages(pages).withColumn("handler", B.handler()), "detected")
    whole = keep(B.unconsumed(B.stitch(B.buildable(detected).withColumn("segment", F.lit("Overview")))), "whole")
    out = keep(H.built(whole.join(X.char_rows(whole, detected, pages), X.TABLE, "left")), "built")
    keep.close(but=("built",))
    return out


# characters meet the boxes of rows; runs with and without a rule below, lines, rows; a row without an indication goes on in the one above
@query(
    f"""WITH p AS (SELECT p_partkey // 6 AS doc_id, p_partkey % 6 AS n, p_partkey % 6 < 4 AS head, p_brand, p_name, p_size, CASE WHEN p_size % 2 = 1 THEN '• ' ELSE '' END || '<' || p_type AS second FROM part),
    placed AS (SELECT *, n % 3 = 2 AS sub, CASE WHEN head THEN 100.0 + 30 * (n + 1) ELSE 60.0 + 30 * (n - 4) END AS top FROM p),
    boxes AS (SELECT *, CASE WHEN n % 3 = 1 AND head THEN coalesce(lead(top) OVER (PARTITION BY doc_id, head ORDER BY n), top + 60) ELSE top + 30 END AS bottom FROM placed),
    written AS (SELECT doc_id, head, n, top, 4 AS down, 58.0 AS left_, p_brand AS t FROM boxes WHERE NOT sub UNION ALL SELECT doc_id, head, n, top, 4, 140.0, p_name FROM boxes UNION ALL SELECT doc_id, head, n, top, 16, 140.0, second FROM boxes),
    chars AS (SELECT doc_id, head, top + down AS y, left_ + 5 * (generate_subscripts(string_split(t, ''), 1) - 1) AS x, unnest(string_split(t, '')) AS ch FROM written),
    rules AS (SELECT doc_id, head, top + 13 AS y, 140.0 AS x0, 140.0 + 5 * (instr(p_name, ' ') - 1) AS x1 FROM boxes WHERE p_size % 4 = 0),
    sides AS (SELECT doc_id, head, n, 'a' AS side, 54 AS x0, 135 AS x1, top, bottom FROM boxes WHERE NOT sub UNION ALL SELECT doc_id, head, n, 'b', 135, 527, top, bottom FROM boxes),
    met AS (SELECT s.doc_id, s.n, s.side, c.ch, c.x, round_even(c.y / 2, 0) AS line, EXISTS (SELECT 1 FROM rules r WHERE r.doc_id = c.doc_id AND r.head = c.head AND r.y BETWEEN c.y AND c.y + 10 AND r.x0 <= c.x AND c.x + 5 <= r.x1 + 2) AS u
      FROM sides s JOIN chars c ON c.doc_id = s.doc_id AND c.head = s.head AND c.x >= s.x0 - 2 AND c.x + 5 <= s.x1 + 2 AND c.y >= s.top - 2 AND c.y + 8 <= s.bottom + 2),
    turns AS (SELECT *, CASE WHEN lag(u) OVER w IS DISTINCT FROM u THEN 1 ELSE 0 END AS t FROM met WINDOW w AS (PARTITION BY doc_id, n, side, line ORDER BY x)),
    runs AS (SELECT *, sum(t) OVER (PARTITION BY doc_id, n, side, line ORDER BY x) AS run FROM turns),
    marked AS (SELECT doc_id, n, side, line, run, CASE WHEN u THEN '<u>' ELSE '' END || {_E.format("string_agg(ch, '' ORDER BY x)")} || CASE WHEN u THEN '</u>' ELSE '' END AS m FROM runs GROUP BY doc_id, n, side, line, run, u),
    lines_ AS (SELECT doc_id, n, side, line, string_agg(m, '' ORDER BY run) AS m FROM marked GROUP BY ALL),
    cells_ AS (SELECT doc_id, n, side, ltrim(string_agg(CASE WHEN starts_with(trim(m), '•') THEN '<br>' || m ELSE ' ' || m END, '' ORDER BY line)) AS html FROM lines_ GROUP BY ALL),
    rows_ AS (SELECT doc_id, n, max(html) FILTER (side = 'a') AS a, max(html) FILTER (side = 'b') AS b FROM cells_ GROUP BY ALL),
    whole AS (SELECT doc_id, max(a) AS a, string_agg(b, '<br>' ORDER BY n) AS b, min(n) AS n FROM (SELECT *, sum(CASE WHEN a IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM rows_) WHERE g > 0 GROUP BY doc_id, g)
    SELECT doc_id, {_l(G.TABLE_OPEN + chr(10) + "   <thead>" + chr(10) + G.HEAD_ROW + chr(10) + "     <th>Indication &amp; use</th>" + chr(10) + "     <th>Doses</th>" + chr(10) + "    </tr>" + chr(10) + "   </thead>" + chr(10) + "   <tbody>" + chr(10))}
      || string_agg({_l("    <tr>" + chr(10) + H.TOP_CELL)} || a || {_l("</td>" + chr(10) + H.TOP_CELL)} || b || {_l("</td>" + chr(10) + "    </tr>")}, chr(10) ORDER BY n) || {_l(chr(10) + "   </tbody>" + chr(10) + "  </table>")} AS html FROM whole GROUP BY doc_id"""
)
def dosing_tables(spark, d):
    return _dosing(spark, d).where("handler = 'fda_dosing'").select("doc_id", "html")


@query(f"WITH {grids.GRIDS_SQL}, f AS (SELECT *, [{_SHUT} for c in cells[1] if {_SHUT} <> ''] AS vs FROM tables) SELECT doc_id, page, table_idx, coalesce(vs[1], '') AS first_label, coalesce(vs[-1], '') AS last_label FROM f")
def dosing_labels(spark, d):
    return G.dosing_labels(_tables(spark, d))


# Corpus ------------------------------------------------------------------------------------------

_CQTY = f"list_has_any(string_split(lower(full0), ' '), [{_q(V.DQL_KW)}])"
CORPUS_SQL = f"""{CONT_SQL},
kinds AS (SELECT doc_id, page, table_idx, CASE WHEN first = 'Type of Revision' THEN 'has_revision' WHEN first = 'Product' AND {_CQTY} THEN 'has_dql' WHEN contains(lower(title), 'fda') AND contains(lower(title), 'dosing') AND {_NULL_FIRST} THEN 'has_fda_dosing'
  WHEN contains(full3, 'Mechanism of Action') AND first = '' THEN 'has_moa' WHEN {_any("full0", V.KNOWN_KW)} THEN 'has_known_kw' WHEN {_titled(V.TITLED_GENERIC_KW)} THEN 'has_titled_generic'
  WHEN (contains(full0, 'Criteria') AND {_any("full0", ["Indication", "Coverage", "Criteria for Use"])}) OR contains(full0, 'Coverage Criteria') THEN 'has_criteria' WHEN {_any("full0", ["HCPCS", "CPT", "ICD-10"])} THEN 'has_hcpcs' WHEN contains(full3, 'Letter of Medical Necessity') THEN 'has_eua'
  WHEN contains(full0, 'FDA') AND contains(full3, 'Prescribing Information') THEN 'has_fda_rx' WHEN {_any("full0", ["Non-Preferred", "Exception"])} THEN 'has_nonpref' WHEN {_any("full0", ["Non-Covered Brand", "Bioequivalent"])} THEN 'has_drug_equiv'
  WHEN contains(full0, 'Medication') AND contains(full3, 'Mode of Administration') THEN 'has_medication_moa' WHEN contains(full0, 'Condition') AND contains(full3, 'Criteria for Use') THEN 'has_condition_criteria' WHEN cols >= 2 THEN 'has_catch_all' END AS kind FROM ready),
files AS (SELECT doc_id FROM documents),
flags AS (SELECT f.doc_id, coalesce((SELECT max(tiny_cols) >= 4 FROM tiny WHERE tiny.doc_id = f.doc_id), false) AS has_avail, {", ".join(f"EXISTS (SELECT 1 FROM kinds k WHERE k.doc_id = f.doc_id AND k.kind = '{x}') AS {x}" for x in C.FLAGS if x != "has_avail")} FROM files f)
"""


def _flags(spark, d):
    return C.page_flags(spark.read.parquet(f"{d}/documents.parquet").select("doc_id"), _pages(spark, d))


@query(f"WITH {CORPUS_SQL} SELECT doc_id, page, table_idx, kind FROM kinds")
def corpus_cascade(spark, d):
    return B.profiled_pages(_pages(spark, d)).select(*KEYS, C.corpus_type().alias("kind"))


@query(f"WITH {CORPUS_SQL} SELECT * FROM flags")
def corpus_flags(spark, d):
    return _flags(spark, d)


@query(f"WITH {CORPUS_SQL}, u AS (UNPIVOT flags ON {', '.join(C.FLAGS)} INTO NAME flag VALUE v) SELECT flag, count(*) FILTER (v) AS n, round(100 * count(*) FILTER (v) / count(*), 1) AS percent FROM u GROUP BY flag HAVING count(*) FILTER (v) > 0")
def flag_distribution(spark, d):
    return C.flag_distribution(_flags(spark, d))


# Reconciliation ----------------------------------------------------------------------------------

_BOUNDS = "bounds AS (SELECT DISTINCT doc_id, 'Overview' AS segment, 1 AS page, 50.0 AS top FROM tables UNION ALL SELECT DISTINCT doc_id, 'References', 2, 100.0 FROM tables WHERE doc_id % 3 = 0 UNION ALL SELECT DISTINCT doc_id, 'Appendix', 3, 200.0 FROM tables WHERE doc_id % 6 = 0)"


def _bounds(t):
    one = lambda seg, page, top: F.struct(F.lit(seg).alias("segment"), F.lit(page).alias("page"), F.lit(top).alias("top"), F.lit(1).alias("seq"))
    some = lambda by, bound: F.when(F.col("doc_id") % by == 0, F.array(bound)).otherwise(F.filter(F.array(bound), lambda x: F.lit(False)))
    marks = F.concat(F.array(one("Overview", 1, 50.0)), some(3, one("References", 2, 100.0)), some(6, one("Appendix", 3, 200.0)))
    return t.select("doc_id").distinct().select("doc_id", F.explode(marks).alias("b")).select("doc_id", "b.*")


@query(f"WITH {grids.GRIDS_SQL}, {_BOUNDS} SELECT doc_id, 2 AS from_page, 100.0 AS from_top, CASE WHEN doc_id % 6 = 0 THEN 3 END AS to_page, CASE WHEN doc_id % 6 = 0 THEN 200.0 END AS to_top FROM bounds WHERE segment = 'References'")
def references_range(spark, d):
    return Q.references_range(_bounds(_tables(spark, d)))


@query(f"""WITH {TYPE_SQL}, regions AS (SELECT doc_id, page, greatest(0, top - CASE WHEN table_type = 'criteria' THEN 30 ELSE 5 END) AS a, bottom AS b FROM typed WHERE table_type NOT IN ('spurious', 'unknown') AND doc_id % 4 <> 1)
    SELECT doc_id, page, table_idx, CASE WHEN spurious OR (doc_id % 3 = 0 AND (page, top) > (2, 100.0) AND (doc_id % 6 <> 0 OR (page, top) < (3, 200.0))) THEN 'SPURIOUS' WHEN EXISTS (SELECT 1 FROM regions r WHERE r.doc_id = t.doc_id AND r.page = t.page AND r.a <= t.top + 10 AND r.b >= t.bottom - 10) THEN 'OK' ELSE 'MISSED' END AS status FROM typed t""")
def missed_tables(spark, d):
    keep = Stages(spark, "missed")
    found = keep(_detected(spark, d), "detected")
    out = keep(Q.coverage(found, B.covered_regions(found.where("doc_id % 4 <> 1")), Q.references_range(_bounds(found))).select(*KEYS, "status"), "missed")
    keep.close(but=("missed",))
    return out


def _expected(spark, d):
    """Rows that tables should give; the tops of rows are made up, 25 points each."""
    t = _detected(spark, d).select(*KEYS, "bbox", "cells", "gray_bottom")
    tops = t.select(*KEYS, F.posexplode("cells").alias("r", "row"), "bbox").select(*KEYS, "r", (F.col("bbox.top") + 25 * F.col("r")).alias("row_top"))
    return t, Q.expected_rows(t, tops)


_EXPECTED = f"{_GROWS}, gb AS (SELECT t.doc_id, t.page, t.table_idx, t.top, t.bottom, (SELECT max(r.bottom) FROM grects r WHERE r.doc_id = t.doc_id AND r.page = t.page AND r.fill AND (r.r + r.g + r.b) / 3 BETWEEN 0.3 AND 0.98 AND r.top >= t.top - 2 AND r.bottom <= t.bottom + 2) AS g FROM tables t), st AS (SELECT gb.*, coalesce((SELECT min(x.r) FROM grows x WHERE x.doc_id = gb.doc_id AND x.page = gb.page AND x.table_idx = gb.table_idx AND gb.top + 25 * x.r >= g - 1), 1) AS s FROM gb), ex AS (SELECT st.doc_id, st.page, st.table_idx, st.top, count(*) FILTER (x.r >= s AND len([c for c in x.row if {_SHUT} <> '']) > 0) AS expected FROM st JOIN grows x USING (doc_id, page, table_idx) GROUP BY ALL)"


@query(f"WITH {_EXPECTED} SELECT doc_id, page, table_idx, expected FROM ex")
def expected_rows(spark, d):
    return _expected(spark, d)[1]


def _losses(spark, d):
    """Rendered nodes are made up, with a number of rows by document, so that some lose rows (``converted_rows`` judges tables that are built)."""
    t, expected = _expected(spark, d)
    sources = t.join(expected, KEYS)
    html = F.concat(F.lit("<tbody>"), F.expr("repeat('<tr>', cast(doc_id % 6 as int))"), F.lit("</tbody>"))
    nodes = t.select("doc_id", "page", F.when(F.col("doc_id") % 9 == 0, "moa").otherwise("generic").alias("table_type"), (F.col("bbox.top") + 3).alias("top"), html.alias("html"))
    return Q.row_loss(nodes, sources)


_LOSS = f"{_EXPECTED}, nodes AS (SELECT doc_id, page, table_idx, top + 3 AS top, doc_id % 6 AS actual FROM tables WHERE doc_id % 9 <> 0), near AS (SELECT n.doc_id, n.page, n.top, n.actual, (SELECT arg_min(expected, e.table_idx) FROM ex e WHERE e.doc_id = n.doc_id AND e.page = n.page AND abs(e.top - n.top) <= 20) AS expected FROM nodes n), loss AS (SELECT doc_id, page, 'generic' AS table_type, top, expected, actual, expected - actual AS missing FROM near WHERE expected IS NOT NULL AND actual < expected - 1)"


@query(f"WITH {_LOSS} SELECT * FROM loss")
def row_loss(spark, d):
    return _losses(spark, d)


@query(f"WITH {_LOSS} SELECT doc_id, count(*) AS n_tables, sum(missing) AS n_missing FROM loss GROUP BY doc_id")
def missing_rollup(spark, d):
    return Q.missing_by_document(_losses(spark, d))


# Lookups ------------------------------------------------------------------------------------------


@query(f"WITH {grids.GRIDS_SQL} SELECT t.doc_id, t.page, t.table_idx, EXISTS (SELECT 1 FROM gwords w WHERE w.doc_id = t.doc_id AND w.page = t.page AND contains(w.fontname, 'Bold') AND w.top BETWEEN t.top AND t.top + 20 AND w.x0 BETWEEN t.x0 AND t.x1) AS bold_header FROM tables t")
def bold_header(spark, d):
    t, w, _ = _all(spark, d)
    return B.bold_header(t, w.where("doc_id >= 0")).select(*KEYS, "bold_header")


@query(f"WITH {grids.GRIDS_SQL}, n AS (SELECT doc_id, page, table_idx, top + CAST(doc_id % 8 AS DOUBLE) AS top FROM tables) SELECT n.doc_id, n.page, n.table_idx, coalesce((SELECT arg_min('title ' || t.table_idx, t.table_idx) FROM tables t WHERE t.doc_id = n.doc_id AND t.page = n.page AND abs(t.top - n.top) < 5), '') AS title FROM n")
def tolerant_title(spark, d):
    t = _tables(spark, d)
    nodes = t.select(*KEYS, (F.col("bbox.top") + (F.col("doc_id") % 8).cast("double")).alias("top"))
    return B.nearby_titles(nodes, t.withColumn("title", F.concat(F.lit("title "), F.col("table_idx").cast("string")))).select(*KEYS, "title")


@query(f"WITH {TYPE_SQL} SELECT doc_id, page, table_idx, CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE table_type END AS table_type FROM typed")
def type_attach(spark, d):
    return Q.with_types(_tables(spark, d), _detected(spark, d).where("doc_id % 3 != 0")).select(*KEYS, "table_type")


@query("""WITH p AS (SELECT p_partkey AS doc_id, generate_subscripts(string_split(p_name, ''), 1) - 1 AS i, unnest(string_split(p_name, '')) AS ch FROM part)
    SELECT doc_id, count(*) AS n_chars FROM p WHERE ch <> '' AND 5.0 * (i % 6) BETWEEN 3 AND 17 AND 100.0 + 12 * (i // 6) BETWEEN 98 AND 114 GROUP BY doc_id""")
def chars_in_box(spark, d):
    chars = _chars(spark, d)
    boxes = chars.select("doc_id", "page").distinct().select("doc_id", "page", F.lit(5.0).alias("x0"), F.lit(100.0).alias("top"), F.lit(15.0).alias("x1"), F.lit(112.0).alias("bottom"))
    return G.chars_in_box(chars, boxes).groupBy("doc_id").agg(F.count("*").alias("n_chars"))


@query(f"WITH {grids.GRIDS_SQL}, last AS (SELECT doc_id, max(page) AS n_pages FROM tables GROUP BY doc_id) SELECT r.doc_id, r.page, arg_min(r.top, r.rect_idx) AS top FROM grects r JOIN last l ON l.doc_id = r.doc_id AND l.n_pages = r.page WHERE r.bottom - r.top - 17 < 5 AND r.x1 - r.x0 > 400 AND NOT (r.r = 0 AND r.g = 0 AND r.b = 0) GROUP BY r.doc_id, r.page")
def footer_rule(spark, d):
    from pagewright.operators import segments as S

    t, _, r = _all(spark, d)
    thin = r.withColumn("bottom", F.col("bottom") - 17).withColumn("color_kind", F.lit("tuple"))
    return S.footer_rule(thin, t.groupBy("doc_id").agg(F.max("page").alias("n_pages")))
