"""Pieces shared by the operators: scratch tables, document keys and byte-level word splitting."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch between Spark and Python, where the session has Spark's own 10,000: texts are long.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Stands for a null doc_id inside an operator, so that it sorts before every other id.
NULL_ID = -(2**63)

#: bytes.translate table: A-Z to a-z, every other ASCII byte outside 0-9a-z to a space.
ALNUM_TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder in spark.checkpoint.dir.

    A session in one process without that setting gets a temporary folder as its own; on a cluster the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='pagewright-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, str(BATCH_ROWS))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """A scratch table that nothing reads any more goes."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def tidy(f):
    """A generator function for ``mapInArrow`` that gives memory back to the system when it ends, as its worker stays."""

    @functools.wraps(f)
    def run(*args, **named):
        try:
            yield from f(*args, **named)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # not with every C library
                pass

    return run


def merged(df: DataFrame, merge: int = 4) -> DataFrame:
    """``df`` with so many small shuffle partitions to a task, and so to a file where it is written.

    Not for what Python makes in the same stage: a task would start a worker for each partition before it gives back the last.
    """
    return df.coalesce(max(8, partitions(df.sparkSession) // merge))


def few_files(df: DataFrame, merge: int = 4) -> DataFrame:
    """Narrow rows that Python makes, dealt anew to fewer partitions."""
    return df.repartition(max(8, partitions(df.sparkSession) // merge))


def written(df: DataFrame, name: str, merge: int = 1) -> DataFrame:
    """``df`` as a table in the shared folder, read back: its lineage ends there and survives lost executors."""
    path = scratch(df.sparkSession, name)
    (merged(df, merge) if merge > 1 else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def doc_key() -> Column:
    """doc_id as a long without nulls; ``from_key`` gives the id back."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def from_key(c: Column) -> Column:
    return F.nullif(c, F.lit(NULL_ID))


def text_bytes() -> Column:
    """The text as UTF-8 bytes, empty where it is null."""
    return F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))


def lower_alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return text.translate(ALNUM_TABLE).split()


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, converted a few at a time so long texts don't pile up."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))


def flush(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of what the lists hold; the lists are emptied."""
    batch = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)
    for c in columns:
        c.clear()
    return batch


def fresh(columns: list[str], name: str = "_pw") -> str:
    """``name``, with underscores until no column has it."""
    while name in columns:
        name += "_"
    return name


def skewed_join(left: DataFrame, right: DataFrame, keys: list[str], hot: Column) -> DataFrame:
    """Inner join with ``right``, a row a key. ``hot`` marks the keys of a share of all rows, so few that they are broadcast: no task gets all rows of one."""
    few = F.broadcast(right.where(hot))
    rest = left.join(F.broadcast(right.where(hot).select(*keys)), keys, "left_anti").join(right.where(~hot), keys)
    return left.join(few, keys).unionByName(rest)


def annotate(docs: DataFrame, keep: list[str], fields: str, make, name: str = "_pw") -> DataFrame:
    """The ``keep`` columns of ``docs`` and a struct column ``name`` of ``fields`` worked out from the text.

    ``make()`` is called once a task and returns a function from a list of texts (UTF-8 bytes, None
    where null) to a list of tuples. A column of ``keep`` called ``name`` gives way.
    """
    keep = [c for c in keep if c != name]
    source = docs.select(F.col("text").cast("string").cast("binary").alias(name), *[f"`{c}`" for c in keep])
    kept = docs.select(*[f"`{c}`" for c in keep]).schema
    names = [x.split()[0] for x in fields.split(", ")]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = work(part.column(0).to_pylist())
                structs = pa.StructArray.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(arrow)], names)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], structs], names=[*keep, name])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    schema = _parse_datatype_string(fields)
    arrow = [to_arrow_type(f.dataType) for f in schema]
    return source.mapInArrow(run, StructType([*kept, StructField(name, schema)]))
