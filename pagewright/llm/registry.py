"""Every query of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, embeddings, kmeans, licenses, packing, sharding, simhash, spelling, substring_dedup, suffix_dedup, token_files, toxicity, warc

_MODULES = (toxicity, suffix_dedup, substring_dedup, simhash, sharding, licenses, embeddings, decontamination, token_files, packing, warc, kmeans, spelling)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
