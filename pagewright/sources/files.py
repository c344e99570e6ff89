"""Files in and out: directories of documents, manifests, reports, HTML."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from pagewright.operators.corpus import FLAGS

MANIFEST = "filename string, prefix string, n_pages string, sections string, " + ", ".join(f"{f} string" for f in FLAGS)


def scan_directory(spark: SparkSession, path: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """path, filename, prefix, length of the documents of a directory, without their content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("filename"), F.split_part(name, F.lit("_"), F.lit(1)).alias("prefix"), "length")


def find_document(spark: SparkSession, path: str, policy_id: str) -> DataFrame:
    """The first document (by path) at any depth whose name begins with ``policy_id``; raises without one."""
    found = scan_directory(spark, path, f"{policy_id}*.pdf", recursive=True).orderBy("path").limit(1)
    if found.isEmpty():
        raise FileNotFoundError(f"no document named {policy_id}*.pdf below {path}")
    return found


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A corpus manifest: CSV with a header; ``n_pages`` must be a number."""
    rows = spark.read.schema(MANIFEST).option("header", True).option("mode", "FAILFAST").csv(path)
    return _typed(rows, F.col("n_pages").cast("int"))


def read_manifest_tolerantly(spark: SparkSession, path: str, containing: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """As ``read_manifest``, but rows without a page number go, as do those whose name lacks ``containing`` or isn't among ``files``."""
    rows = _typed(spark.read.schema(MANIFEST).option("header", True).csv(path), F.col("n_pages").try_cast("int")).where("n_pages is not null")
    if containing:
        rows = rows.where(F.col("filename").contains(containing))
    return rows.join(files.select("filename"), "filename", "left_semi") if files is not None else rows


def _typed(rows: DataFrame, pages) -> DataFrame:
    return rows.select("filename", "prefix", pages.alias("n_pages"), "sections", *[F.lower(f).eqNullSafe("true").alias(f) for f in FLAGS])


def write_manifest(df: DataFrame, path: str) -> None:
    """CSV with a header and flags as True or False, replacing what is there."""
    shown = df.select("filename", "prefix", "n_pages", "sections", *[F.initcap(F.col(f).cast("string")).alias(f) for f in FLAGS])
    shown.write.mode("overwrite").option("header", True).csv(path)


@dataclass
class Staged(WriterCommitMessage):
    """The folder that a task has written its files to, and how many."""

    folder: str
    files: int


class HtmlWriter(DataSourceArrowWriter):
    """Files of (stem, html) rows. A task writes to a folder of its own; files come to their place when all tasks are done, and none does if one fails."""

    def __init__(self, options: dict):
        self.path, self.staging = options["path"], f"_staging-{uuid.uuid4().hex}"

    def _opened(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        to, root = self._opened()
        own, n = f"{root}/{self.staging}/{uuid.uuid4().hex}", 0
        to.create_dir(own, recursive=True)
        for batch in iterator:
            for stem, html in zip(batch.column("stem").to_pylist(), batch.column("html").to_pylist()):
                with to.open_output_stream(f"{own}/{stem}.htm", compression=None) as out:
                    out.write(html.encode())
                n += 1
        return Staged(own, n)

    def commit(self, messages: list[Staged | None]) -> None:
        to, root = self._opened()
        for m in messages:
            if m is not None and m.files:
                for f in to.get_file_info(fs.FileSelector(m.folder)):
                    to.move(f.path, f"{root}/{f.base_name}")
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        to, root = self._opened()
        if to.get_file_info(f"{root}/{self.staging}").type != fs.FileType.NotFound:
            to.delete_dir(f"{root}/{self.staging}")


class HtmlFiles(DataSource):
    """df.write.format("html_files").mode("append").save(path), df with stem and html."""

    @classmethod
    def name(cls) -> str:
        return "html_files"

    def schema(self) -> str:
        return "stem string, html string"

    def writer(self, schema, overwrite: bool) -> HtmlWriter:
        return HtmlWriter(self.options)


def write_html(documents: DataFrame, path: str, dry_run: bool = False) -> int:
    """Writes (stem, html) as files <stem>.htm below ``path``; returns the number of documents, each of which has a stem of its own.

    ``path`` is a folder that driver and executors share, in a file system that Arrow knows (file, hdfs, s3, gs). A file that is there is replaced. Attempts that
    failed leave nothing in ``path``.
    """
    rows = documents.select("stem", "html")
    if dry_run:
        return rows.count()
    spark = documents.sparkSession
    spark.dataSource.register(HtmlFiles)
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).write.format("html_files").mode("append").save(path)
    return seen.get["n"]


def write_report(lines: DataFrame, path: str, order: list[str]) -> None:
    """Text lines (column ``line``) in order, as one file: a report has a line a document that failed."""
    lines.orderBy(*order).select("line").coalesce(1).write.mode("overwrite").text(path)


def write_logs(results: DataFrame, path: str) -> None:
    """One folder of log lines (prefix, line) a prefix."""
    results.select("prefix", "line").write.mode("overwrite").partitionBy("prefix").text(path)


def write_table(df: DataFrame, url: str, table: str, key: list[str], properties: dict[str, str] | None = None) -> None:
    """Merges rows into a table of a relational database by ``key``, which is unique in ``df``: rows of the table with a key of ``df`` are replaced, others stay.

    The tasks write to a table of their own; one transaction then takes its rows over. So a job that failed changes nothing, and one that is run again
    gives the same table. A missing table is made; ``properties`` may have createTableColumnTypes, as keys must be comparable (extension).
    """
    spark, properties = df.sparkSession, dict(properties or {})
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    quote = dialect.quoteIdentifier
    options = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(url, table, jvm.PythonUtils.toScalaMap(properties))
    columns = ", ".join(quote(c) for c in df.columns)
    same = " AND ".join(f"s.{quote(k)} = {table}.{quote(k)}" for k in key)
    connection = None
    try:
        df.write.mode("overwrite").jdbc(url, staging, properties=properties)
        df.limit(0).write.mode("append").jdbc(url, table, properties=properties)
        connection = dialect.createConnectionFactory(options).apply(-1)
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        statement.executeUpdate(f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})")
        statement.executeUpdate(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}")
        connection.commit()
    finally:
        connection = connection or dialect.createConnectionFactory(options).apply(-1)
        if not connection.getAutoCommit():
            connection.rollback()  # nothing after a commit
            connection.setAutoCommit(True)
        if _is_there(connection, staging):
            connection.createStatement().executeUpdate(f"DROP TABLE {staging}")
        connection.close()


def _is_there(connection, table: str) -> bool:
    """Whether a table is there, in whatever case the database keeps its name."""
    found = connection.getMetaData().getTables(None, None, "%", None)
    while found.next():
        if found.getString("TABLE_NAME").lower() == table.lower():
            return True
    return False
