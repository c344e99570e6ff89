"""Joins and groupings that the layout operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_last(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], value: str, default=None) -> DataFrame:
    """``left`` with ``value`` of the latest ``right`` row at or before it within ``keys``, by the ordered columns.

    One union and one window: no range join, so a document's rows are sorted once. A ``right`` row goes before a
    ``left`` row at the same place; of several at one place the last by value of ``_seq`` (if there) counts.
    """
    seq = F.col("_seq") if "_seq" in right.columns else F.lit(0)
    marks = right.select(*keys, *order, F.lit(0).alias("_side"), seq.cast("long").alias("_at"), F.col(value).alias("_mark"))
    rows = left.withColumn("_side", F.lit(1)).withColumn("_at", F.lit(0).cast("long")).withColumn("_mark", F.lit(None).cast(right.schema[value].dataType))
    every = rows.unionByName(marks, allowMissingColumns=True)
    # keys as a struct, so that the rows are dealt anew: Spark 4.1 takes a union of tables that share an exchange for dealt by key, which it isn't
    w = Window.partitionBy(F.struct(*keys)).orderBy(*order, "_side", "_at").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("_mark", ignorenulls=True).over(w)
    found = F.coalesce(found, F.lit(default)) if default is not None else found
    return every.withColumn(value, found).where("_side = 1").drop("_side", "_at", "_mark")


def inside_any(left: DataFrame, boxes: DataFrame, keys: list[str], at: str, low: str, high: str, flag: str) -> DataFrame:
    """``left`` with a flag: whether ``at`` lies in an interval [low, high] of ``boxes`` with the same keys.

    The intervals of a key are gathered into one array (a page has few), so the join is on keys alone and
    ``left`` keeps its rows.
    """
    held = boxes.groupBy(*keys).agg(F.collect_set(F.struct(F.col(low).alias("low"), F.col(high).alias("high"))).alias("_boxes"))
    hit = F.exists("_boxes", lambda b: (b["low"] <= F.col(at)) & (F.col(at) <= b["high"]))
    return left.join(held, keys, "left").withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_boxes")


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str) -> DataFrame:
    """``df`` with the number of the run each row belongs to; ``starts`` marks the first row of a run."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(w))


def joined(text: str, order: list[Column], sep: str = " ") -> Column:
    """Aggregate: the texts of a group in order, joined."""
    return F.array_join(F.sort_array(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(text).alias("v"))))["v"], sep)


def first_within(left: DataFrame, right: DataFrame, keys: list[str], at: str, to: str, tolerance: float, order: list[str], value: str, strict: bool = False) -> DataFrame:
    """``left`` with ``value`` of the first ``right`` row (by ``order``) of the same keys whose ``to`` is within the tolerance of ``at``."""
    held = right.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(to).alias("_to"), F.col(value).alias("_value")))).alias("_near"))
    gap = lambda s: F.abs(s["_to"] - F.col(at))
    near = F.filter("_near", lambda s: gap(s) < tolerance if strict else gap(s) <= tolerance)
    return left.join(held, keys, "left").withColumn(value, F.get(near, F.lit(0))["_value"]).drop("_near")
