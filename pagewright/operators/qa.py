"""Reconciling what was detected with what was rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T

from .tables import PAGE


def references_range(bounds: DataFrame) -> DataFrame:
    """doc_id, from_page, from_top, to_page, to_top: from the first references section to the next section; open-ended if it is the last."""
    order = Window.partitionBy("doc_id").orderBy("page", "top", "seq")
    b = bounds.withColumn("_next", F.lead(F.struct("page", "top")).over(order)).where(F.lower("segment").contains("reference"))
    return b.groupBy("doc_id").agg(F.min_by(F.struct("page", "top", "_next"), F.struct("page", "top", "seq")).alias("r")).select("doc_id", F.col("r.page").alias("from_page"), F.col("r.top").alias("from_top"), F.col("r._next.page").alias("to_page"), F.col("r._next.top").alias("to_top"))


def coverage(tables: DataFrame, regions: DataFrame, references: DataFrame) -> DataFrame:
    """``tables`` (with spurious) with ``status``: SPURIOUS if spurious or strictly within the references, OK if a region covers it within 10 points, else MISSED."""
    held = regions.groupBy(*PAGE).agg(F.collect_list(F.struct("box_top", "box_bottom")).alias("_regions"))
    hit = F.exists("_regions", lambda r: (r["box_top"] <= F.col("bbox.top") + 10) & (r["box_bottom"] >= F.col("bbox.bottom") - 10))
    here = F.struct(F.col("page").cast("int").alias("p"), F.col("bbox.top").alias("t"))
    start = F.struct(F.col("from_page").cast("int").alias("p"), F.col("from_top").alias("t"))
    end = F.struct(F.col("to_page").cast("int").alias("p"), F.col("to_top").alias("t"))
    within = F.coalesce((here > start) & (F.col("to_page").isNull() | (here < end)), F.lit(False)) & F.col("from_page").isNotNull()
    t = tables.join(held, PAGE, "left").join(references, "doc_id", "left")
    status = F.when(F.col("spurious") | within, "SPURIOUS").when(F.coalesce(hit, F.lit(False)), "OK").otherwise("MISSED")
    return t.withColumn("status", status).drop("_regions", "from_page", "from_top", "to_page", "to_top")


def with_types(tables: DataFrame, detected: DataFrame) -> DataFrame:
    """``tables`` with the detector's type by page and box to one decimal; ``unknown`` without one."""
    key = lambda: F.struct(*[F.round(F.col(f"bbox.{c}"), 1) for c in ("x0", "top", "x1", "bottom")])
    types = detected.groupBy(*PAGE, key().alias("_key")).agg(F.max_by("table_type", "table_idx").alias("table_type"))
    return tables.withColumn("_key", key()).join(types, [*PAGE, "_key"], "left").withColumn("table_type", F.coalesce("table_type", F.lit("unknown"))).drop("_key")


def expected_rows(tables: DataFrame, row_tops: DataFrame) -> DataFrame:
    """doc_id, page, table_idx, expected: rows with anything in them from the first row at or below the gray header.

    ``tables`` has gray_bottom; ``row_tops`` (doc_id, page, table_idx, r, row_top) the tops of rows. Without gray, or a row below
    it, data begin at row 1.
    """
    keys = [*PAGE, "table_idx"]
    starts = row_tops.join(tables.select(*keys, "gray_bottom"), keys).where("row_top >= gray_bottom - 1").groupBy(*keys).agg(F.min("r").alias("_start"))
    rows = tables.select(*keys, F.posexplode("cells").alias("r", "row")).join(starts, keys, "left")
    filled = F.exists("row", lambda c: T.cell(c) != "") & (F.col("r") >= F.coalesce("_start", F.lit(1)))
    return rows.groupBy(*keys).agg(F.count_if(filled).alias("expected"))


def row_loss(nodes: DataFrame, sources: DataFrame) -> DataFrame:
    """doc_id, page, table_type, top, expected, actual, missing: rendered tables (html) with fewer than all but one of the rows of the first source table within 20 points; mechanism-of-action tables aren't judged."""
    held = sources.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("table_idx", F.col("bbox.top").alias("t"), "expected"))).alias("_near"))
    near = F.get(F.filter("_near", lambda s: F.abs(s["t"] - F.col("top")) <= 20), F.lit(0))["expected"]
    judged = nodes.where("table_type != 'moa'").join(held, PAGE).withColumn("expected", near).withColumn("actual", T.html_rows(F.col("html")).cast("long"))
    return judged.where("expected is not null and actual < expected - 1").select(*PAGE, "table_type", "top", "expected", "actual", (F.col("expected") - F.col("actual")).alias("missing"))


def missing_by_document(losses: DataFrame) -> DataFrame:
    return losses.groupBy("doc_id").agg(F.count("*").alias("n_tables"), F.sum("missing").alias("n_missing"))
