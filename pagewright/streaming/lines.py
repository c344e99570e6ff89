"""Documents that arrive as files: their patterns of sections and running counts of them, as streams (extension).

The batch operators on words keep no state across documents, so each micro-batch runs them as they are. What spans batches, the count of
each pattern, is the state of a second stream over what the first has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagewright.operators import corpus as C
from pagewright.sources import layout

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
PATTERNS = "doc_id long, pattern string"
COUNTS = "pattern string, n_docs long, first_doc long, batch long"


def read_documents(spark: SparkSession, path: str, files_a_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def _done(spark: SparkSession, folder: str) -> bool:
    """Whether a batch has been written whole; one that is run again after that leaves its files as they are."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def section_patterns(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends (doc_id, pattern) of each batch's documents to a table, exactly once: a batch writes a folder of its own."""

    def batch(docs: DataFrame, number: int) -> None:
        if not _done(docs.sparkSession, f"{out}/batch={number}"):
            headings = C.heading_sequence(layout.words(docs))
            C.section_patterns(docs.select("doc_id"), headings).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pattern_counts(spark: SparkSession, patterns: str, out: str, checkpoint: str, files_a_batch: int = 16) -> StreamingQuery:
    """Counts the documents of each pattern in the table that ``section_patterns`` writes; the counts are the stream's state.

    Each batch writes the counts that it changes to a folder of its own (``current_counts`` reads them).
    """
    stream = spark.readStream.schema(PATTERNS).option("maxFilesPerTrigger", files_a_batch).parquet(patterns)
    counted = stream.groupBy("pattern").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))

    def batch(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return counted.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_counts(spark: SparkSession, out: str) -> DataFrame:
    """pattern, n_docs, first_doc as of the last batch that changed each pattern."""
    changes = spark.read.schema(COUNTS).parquet(out)
    return changes.groupBy("pattern").agg(F.max_by(F.struct("n_docs", "first_doc"), "batch").alias("x")).select("pattern", "x.*")
