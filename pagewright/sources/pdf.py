"""Words, rectangles, links, characters and ruled tables of PDF files, as a data source that reads what is asked for.

Needs pdfplumber, an optional package; the rest of the library only needs relations of these shapes, from
whatever reader.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Bytes of a file that one task reads pages of.
BYTES_PER_TASK = 64 << 20

#: One row per page: arrays of its primitives, in the order of the reader.
SCHEMA = (
    "path string, page int, error string, "
    "words array<struct<text:string,x0:double,x1:double,top:double,bottom:double,fontname:string,size:double>>, "
    "tiny_words array<struct<text:string,x0:double,top:double,size:double>>, "
    "chars array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>, "
    "rects array<struct<x0:double,x1:double,top:double,bottom:double,fill:boolean,color:array<double>,color_kind:string>>, "
    "annots array<struct<uri:string,x0:double,top:double,bottom:double>>, "
    "tables array<struct<bbox:struct<x0:double,top:double,x1:double,bottom:double>,cells:array<array<string>>,row_tops:array<double>,row_boxes:array<struct<x0:double,top:double,x1:double,bottom:double>>>>"
)


def _colour(value) -> tuple[list[float], str]:
    """A fill colour as an array, and whether it was a number, a tuple or missing."""
    if value is None:
        return [], "none"
    if isinstance(value, (list, tuple)):
        return [float(v) for v in value], "tuple"
    return [float(value)], "scalar"


def _pick(rows, *names) -> list[dict]:
    return [{n: r.get(n) for n in names} for r in rows]


def _table(t) -> dict:
    box = lambda b: dict(zip(("x0", "top", "x1", "bottom"), map(float, b)))
    return {"bbox": box(t.bbox), "cells": t.extract() or [], "row_tops": [float(r.bbox[1]) for r in t.rows], "row_boxes": [box(r.bbox) for r in t.rows]}


#: Arrays of a page by name, each with how it is read: what isn't asked for isn't read.
_READERS = {
    "words": lambda p: _pick(p.extract_words(extra_attrs=["fontname", "size"], keep_blank_chars=False, x_tolerance=3, y_tolerance=3), "text", "x0", "x1", "top", "bottom", "fontname", "size"),
    "tiny_words": lambda p: _pick(p.extract_words(extra_attrs=["size"], x_tolerance=2, y_tolerance=2), "text", "x0", "top", "size"),
    "chars": lambda p: _pick(p.chars, "text", "x0", "x1", "top", "bottom"),
    "rects": lambda p: [{**{n: float(r[n]) for n in ("x0", "x1", "top", "bottom")}, "fill": bool(r.get("fill")), **dict(zip(("color", "color_kind"), _colour(r.get("non_stroking_color"))))} for r in p.rects],
    "annots": lambda p: _pick((a for a in p.annots or [] if a.get("uri")), "uri", "x0", "top", "bottom"),
    "tables": lambda p: [_table(t) for t in p.find_tables()],
}


@dataclass
class Share(InputPartition):
    """One of so many shares of a file's pages: the pages in a row that fall to it."""

    path: str
    number: int
    of: int

    def pages(self, count: int) -> range:
        return range(count * self.number // self.of, count * (self.number + 1) // self.of)


class PageReader(DataSourceReader):
    """Reads the columns of the schema that it is given. A file is split by its size, into shares of its pages; every task opens its own."""

    def __init__(self, schema: StructType, options: dict):
        self.names, self.kinds = schema.names, to_arrow_schema(schema)
        self.path, self.pattern, self.bytes = options["path"], options.get("pattern", "*.pdf"), int(options.get("bytesPerTask", BYTES_PER_TASK))

    def partitions(self) -> list[Share]:
        files, root = fs.FileSystem.from_uri(self.path)
        info = files.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, recursive=True))
        held = sorted((f.path, max(1, -(-f.size // self.bytes))) for f in found if f.type == fs.FileType.File and fnmatch(f.base_name, self.pattern))
        return [Share(path, k, n) for path, n in held for k in range(n)] or [Share("", 0, 0)]

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        if not share.of:
            return
        import pdfplumber

        arrays = [n for n in self.names if n in _READERS]

        def batch(**row) -> pa.RecordBatch:
            row = {"path": share.path, "page": 0, "error": None, **{n: [] for n in arrays}, **row}
            return pa.RecordBatch.from_pylist([{n: row[n] for n in self.names}], schema=self.kinds)

        try:
            files, _ = fs.FileSystem.from_uri(self.path)
            with files.open_input_file(share.path) as source, pdfplumber.open(io.BytesIO(source.read())) as document:
                for i in share.pages(len(document.pages)):
                    yield batch(page=i + 1, **{n: _READERS[n](document.pages[i]) for n in arrays})
        except Exception as e:  # counted with the document, as in a batch
            if share.number == 0:
                yield batch(error=str(e))


class Pages(DataSource):
    """spark.read.format("pdf_pages").schema(...).load(path): one row per page. The schema names the columns of SCHEMA that are wanted."""

    @classmethod
    def name(cls) -> str:
        return "pdf_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(schema, self.options)


def read_pages(spark: SparkSession, path: str, pattern: str = "*.pdf", columns: list[str] | None = None, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """One row per page of every document below ``path``; a file that can't be read gives one row with its error.

    ``columns``: those of SCHEMA that are wanted (path, page and error always are); others aren't read from the pages. Files are listed on the
    driver and opened by the tasks, by the file systems that Arrow knows. A file larger than ``bytes_per_task`` is read by several tasks, each its own pages.
    """
    spark.dataSource.register(Pages)
    wanted = None if columns is None else {"path", "page", "error", *columns}
    schema = StructType([f for f in _parse_datatype_string(SCHEMA) if wanted is None or f.name in wanted])
    return spark.read.format("pdf_pages").schema(schema).option("pattern", pattern).option("bytesPerTask", bytes_per_task).load(path)


def pages(read: DataFrame) -> DataFrame:
    """``read_pages`` as whole pages for ``operators.convert``: doc_id (a hash of the path), path, page, words, rects, tables, annots with their indices, and chars; pages of files that failed go."""
    numbered = lambda column, name: F.transform(column, lambda x, i: x.withField(name, i))
    return read.where("error is null").select(
        F.xxhash64("path").alias("doc_id"), "path", "page", numbered("words", "word_idx").alias("words"), numbered("rects", "rect_idx").alias("rects"),
        numbered("tables", "table_idx").alias("tables"), "annots", "chars",
    )
