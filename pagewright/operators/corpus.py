"""Statistics over a corpus of documents, and the batches made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions import vocabulary as V

from .tables import profiled_pages
from .relational import joined

FLAGS = [
    "has_avail", "has_dql", "has_revision", "has_fda_dosing", "has_moa", "has_known_kw", "has_titled_generic", "has_criteria",
    "has_hcpcs", "has_eua", "has_fda_rx", "has_nonpref", "has_drug_equiv", "has_medication_moa", "has_condition_criteria", "has_catch_all",
]
ARROW = " → "


def corpus_type() -> Column:
    """Flag of a table in the corpus profile (columns cells, title): the first that fits; null if none. No table is spurious here."""
    cells = F.col("cells")
    row0 = F.get(cells, F.lit(0))
    c0 = T.cell(F.get(row0, F.lit(0)))
    flat0 = F.array_join(F.filter(row0, lambda c: F.coalesce(c, F.lit("")) != ""), " ")
    flat3 = T.flat(cells, 3)
    norm = T.join_capitals(F.col("title"))
    lower = F.lower(norm)
    is_titled = norm.rlike(r"^(Appendix\s+)?Table\s+\d+[.]") | norm.rlike(r"^Table\s+\d+[:\s]") | T.contains_any(lower, V.TITLED_GENERIC_KW) | T.strip(lower).isin(V.TITLED_GENERIC_EXACT)
    quantity = F.arrays_overlap(F.split(F.lower(flat0), r"\s+"), F.array(*[F.lit(k) for k in V.DQL_KW]))
    null_first = F.exists(F.slice(cells, 1, 3), lambda r: F.get(r, F.lit(0)).isNull())
    title = F.lower(F.col("title"))
    return (
        F.when(c0 == "Type of Revision", "has_revision")
        .when((c0 == "Product") & quantity, "has_dql")
        .when(title.contains("fda") & title.contains("dosing") & null_first, "has_fda_dosing")
        .when(flat3.contains("Mechanism of Action") & (c0 == ""), "has_moa")
        .when(T.contains_any(flat0, V.KNOWN_KW), "has_known_kw")
        .when(is_titled, "has_titled_generic")
        .when((flat0.contains("Criteria") & T.contains_any(flat0, ["Indication", "Coverage", "Criteria for Use"])) | flat0.contains("Coverage Criteria"), "has_criteria")
        .when(T.contains_any(flat0, ["HCPCS", "CPT", "ICD-10"]), "has_hcpcs")
        .when(flat3.contains("Letter of Medical Necessity"), "has_eua")
        .when(flat0.contains("FDA") & flat3.contains("Prescribing Information"), "has_fda_rx")
        .when(T.contains_any(flat0, ["Non-Preferred", "Exception"]), "has_nonpref")
        .when(T.contains_any(flat0, ["Non-Covered Brand", "Bioequivalent"]), "has_drug_equiv")
        .when(flat0.contains("Medication") & flat3.contains("Mode of Administration"), "has_medication_moa")
        .when(flat0.contains("Condition") & flat3.contains("Criteria for Use"), "has_condition_criteria")
        .when(F.size(row0) >= 2, "has_catch_all")
    )


def document_flags(files: DataFrame, tables: DataFrame, rotated: DataFrame | None = None) -> DataFrame:
    """Every row of ``files`` (doc_id) with the sixteen flags, true if any of its tables has the kind; documents without tables stay."""
    kinds = tables.withColumn("_kind", corpus_type())
    seen = kinds.groupBy("doc_id").agg(*[F.max(F.coalesce(F.col("_kind") == f, F.lit(False))).alias(f) for f in FLAGS if f != "has_avail"])
    out = files.join(seen, "doc_id", "left")
    if rotated is not None:
        out = out.join(rotated.groupBy("doc_id").agg((F.max("tiny_cols") >= 4).alias("has_avail")), "doc_id", "left")
    else:
        out = out.withColumn("has_avail", F.lit(False))
    return out.select(*files.columns, *[F.coalesce(f, F.lit(False)).alias(f) for f in FLAGS])


def page_flags(files: DataFrame, pages: DataFrame) -> DataFrame:
    """``document_flags`` of whole pages: they are read once."""
    kinds = profiled_pages(pages).withColumn("_kind", corpus_type())
    seen = kinds.groupBy("doc_id").agg(*[(F.max("tiny_cols") >= 4).alias(f) if f == "has_avail" else F.max(F.coalesce(F.col("_kind") == f, F.lit(False))).alias(f) for f in FLAGS])
    return files.join(seen, "doc_id", "left").select(*files.columns, *[F.coalesce(f, F.lit(False)).alias(f) for f in FLAGS])


def flag_distribution(flags: DataFrame) -> DataFrame:
    """flag, n, percent of documents, for flags that any document has."""
    counted = flags.agg(F.count("*").alias("total"), *[F.count_if(F.col(f)).alias(f) for f in FLAGS])
    stacked = counted.select("total", F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("n")) for f in FLAGS])).alias("s"))
    return stacked.select("s.flag", "s.n", F.round(100 * F.col("s.n") / F.col("total"), 1).alias("percent")).where("n > 0")


def heading_sequence(words: DataFrame) -> DataFrame:
    """doc_id, page, line_top, section: lines with a bold word, 9 points or more, that are headings of the profile."""
    lines = words.withColumn("line_top", T.quantize(F.col("top"), 4).cast("int")).groupBy("doc_id", "page", "line_top").agg(
        joined("text", [F.col("x0"), F.col("word_idx")]).alias("text"), F.max(F.col("fontname").contains("Bold")).alias("bold"), F.max("size").alias("size")
    )
    text = T.strip(F.col("text"))
    lower = F.lower(text)
    tight = F.regexp_replace(lower, "(?<=[a-z]) (?=[a-z])", "")
    section = F.when(lower.isin(V.CORPUS_HEADINGS) | tight.isin(V.CORPUS_HEADINGS), text).when(lower.startswith("coverage policy"), "Coverage Policy")
    return lines.where("bold and size >= 9").withColumn("section", section).where("section is not null").select("doc_id", "page", "line_top", "section")


def section_patterns(files: DataFrame, headings: DataFrame) -> DataFrame:
    """Every row of ``files`` (doc_id) with ``pattern``: its sections in order, repeats of the one before left out; ``(none)`` without any."""
    order = Window.partitionBy("doc_id").orderBy("page", "line_top")
    fresh = headings.withColumn("_before", F.lag("section").over(order)).where("_before is null or _before != section")
    patterns = fresh.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "line_top", "section"))), lambda s: s["section"]), ARROW).alias("pattern"))
    return files.join(patterns, "doc_id", "left").withColumn("pattern", F.coalesce("pattern", F.lit("(none)")))


def top_patterns(patterns: DataFrame, n: int = 15) -> DataFrame:
    """pattern, n_docs, first_doc of the most frequent patterns; ties by first document."""
    return patterns.groupBy("pattern").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")).orderBy(F.desc("n_docs"), "first_doc").limit(n)


def pattern_prefixes(patterns: DataFrame) -> DataFrame:
    """pattern, prefix, n_docs."""
    return patterns.groupBy("pattern", "prefix").agg(F.count("*").alias("n_docs"))


# Batches -------------------------------------------------------------------------------------------


def split_batch(manifest: DataFrame, max_pages: int = 10, only_prefix: str | None = None) -> DataFrame:
    """``manifest`` with ``status``: skipped above the page limit (whatever the prefix), excluded by another prefix, else selected."""
    other = F.col("prefix") != only_prefix if only_prefix else F.lit(False)
    return manifest.withColumn("status", F.when(F.col("n_pages") > max_pages, "skipped").when(other, "excluded").otherwise("selected"))


def prefix_rank(prefix: Column) -> Column:
    """Place of a prefix in a batch: the known ones in their order, then the others."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in V.PREFIX_ORDER]), prefix), F.lit(0)), F.lit(len(V.PREFIX_ORDER) + 1)).cast("int")


def ordered_prefixes(batch: DataFrame) -> DataFrame:
    """prefix, position, n_docs of selected documents in the order they are worked on."""
    counts = batch.where("status = 'selected'").groupBy("prefix").agg(F.count("*").alias("n_docs"))
    return counts.withColumn("position", F.row_number().over(Window.orderBy(prefix_rank(F.col("prefix")), "prefix")))


def batch_summary(results: DataFrame) -> DataFrame:
    """prefix (null: all), total, ok, err of results (prefix, ok, elapsed), and elapsed, which the grand total hasn't."""
    return results.rollup("prefix").agg(F.count("*").alias("total"), F.count_if(F.col("ok")).alias("ok"), F.count_if(~F.col("ok")).alias("err"), F.when(F.grouping("prefix") == 0, F.sum("elapsed")).alias("elapsed"))


def largest_skipped(batch: DataFrame, n: int = 10) -> DataFrame:
    """The skipped documents with the most pages; ties by place in the manifest (doc_id)."""
    return batch.where("status = 'skipped'").orderBy(F.desc("n_pages"), "doc_id").limit(n)


def isolate(df: DataFrame, work, fields: str, keep: list[str]) -> DataFrame:
    """``work`` (row as dict to a dict of ``fields``) applied to every row; one that raises gives ok = false and the error, and the others go on."""
    import pandas as pd

    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    out.append({**{k: row[k] for k in keep}, "ok": True, "error": "", **work(row)})
                except Exception as e:  # a document that fails is counted, not fatal
                    out.append({**{k: row[k] for k in keep}, "ok": False, "error": str(e), **dict.fromkeys(names)})
            yield pd.DataFrame(out, columns=[*keep, "ok", "error", *names])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keep)
    return df.mapInPandas(run, f"{kept}, ok boolean, error string, {fields}")
