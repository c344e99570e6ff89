"""WARC archives with an index that is written first and read first.

``write`` puts one record per page into WARC/1.1 files, a gzip member each, so that any record can be read alone. Of records with equal
payloads of at least ``MIN_REVISIT`` bytes, that with the largest page_id is a response; the others are revisits, which hold no payload and name it. Each task
writes files of its own, named anew at every attempt, and gives back a row of the index per record: file, offset, length, URL, digest. The index is a Parquet table
whose commit is the archive's: files of attempts that failed are in no index, and go when it is there.

``read`` takes selected rows of the index. Byte ranges are sorted by file and offset, and neighbours with at most ``GAP`` bytes between them are read as
one range, at most ``CHUNK`` bytes and what the last record of it has beyond; then each record is cut out, unpacked and checked against its digests.

Which record is a response is decided on rows without their payload: ids, lengths and digests (SHA-256 tells payloads apart, as SHA-1 has known
collisions). Revisits are written from those rows; pages with payloads only lose the rows that are revisits (an anti-join by
id and digest). So a payload shared by a third of all pages is moved for its one response alone, and meets in no task.

A null html is an empty payload. A null page_id counts as smaller than any other and is given back as null. Of rows that share the largest page_id and the payload
one is the response and the rest are revisits of it. A null or empty URL is ``urn:page:<page_id>`` in the record and stays null in the index; bytes that can't stand in a header
are percent-encoded there. An empty table gives an archive without records. Columns other than page_id, url and html are not read.

Files are written and read by Arrow's file systems (file, hdfs, viewfs, s3, gs, abfs), below a folder that all executors share.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import NULL_ID, partitions, rows, scratch, skewed_join, tidy, written

#: Payloads of so many bytes or more are written once.
MIN_REVISIT = 1000
#: A file ends after so many bytes.
FILE_BYTES = 1 << 30
#: Ranges with so many bytes between them are read as one; a range starts anew at multiples of CHUNK.
GAP = 1 << 16
CHUNK = 8 << 20
#: Bytes of archives to a task that reads, and of payloads in a batch that it gives.
TASK_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
#: A payload that holds so large a share of all pages is broadcast: there are at most as many.
HOT_SHARE = 1000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that stand for themselves in a URI of a header.
PLAIN = frozenset(b"!#$%&'()*+,-./0123456789:;=?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[]_abcdefghijklmnopqrstuvwxyz~")

INDEX = "page_id long, url string, record_type string, digest string, file string, offset long, length long"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# Records -----------------------------------------------------------------------------------------


def quoted(url: str) -> str:
    return "".join(chr(b) if b in PLAIN else f"%{b:02X}" for b in url.encode("utf-8", "surrogatepass"))


def base32(digest: bytes) -> str:
    return f"sha1:{base64.b32encode(digest).decode()}"


def response_id(sha256: str) -> str:
    """The one response of a payload that revisits may name."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'sha256:{sha256}')}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def http_head(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def page_record(key: int, url: str | None, n: int, sha1: str, sha256: str, named: bool, refers: int | None, payload: bytes | None) -> bytes:
    """A response with its payload, or a revisit (refers is the response's key) without. named: revisits may name the response."""
    number = lambda k: str(k) if k != NULL_ID else ""
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", response_id(sha256) if named and refers is None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quoted(url) if url else f"urn:page:{number(key)}"),
        ("WARC-Payload-Digest", base32(bytes.fromhex(sha1))),
        ("Page-Id", number(key)),
    ]
    if refers is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", response_id(sha256)), ("Refers-To-Page-Id", number(refers))]
    block = http_head(n) + (payload if refers is None else b"")
    headers += [("WARC-Block-Digest", base32(hashlib.sha1(block).digest())), ("Content-Type", "application/http; msgtype=response")]
    return member(headers, block)


def parsed(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers, HTTP head, payload) of one gzip member; digests that don't fit raise ValueError."""
    data = zlib.decompress(record, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or base32(hashlib.sha1(block).digest()) != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    if headers["WARC-Type"] == "response" and base32(hashlib.sha1(payload).digest()) != headers["WARC-Payload-Digest"]:
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    return headers, http, payload


# Writing -----------------------------------------------------------------------------------------


class Archive:
    """Files of one task below ``folder``."""

    def __init__(self, folder: str, file_bytes: int):
        self.files, self.root = opened(folder)
        self.file_bytes, self.out, self.name, self.at = file_bytes, None, "", 0

    def add(self, record: bytes) -> tuple[str, int, int]:
        """(file, offset, length) where the record stands."""
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
            about = f"format: WARC File Format 1.1\r\nfile: {self.name}\r\n".encode()
            self._put(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], about))
        where = self.name, self.at, len(record)
        self._put(record)
        if self.at >= self.file_bytes:
            self.close()
        return where

    def _put(self, record: bytes) -> None:
        self.out.write(record)
        self.at += len(record)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _writer(folder: str, file_bytes: int):
    names = [x.split()[0] for x in INDEX.split(", ")]

    def line(archive: Archive, row: tuple) -> tuple:
        key, url, _, sha1, _, _, refers, _ = row
        where = archive.add(page_record(*row))
        return (None if key == NULL_ID else key, url, "response" if refers is None else "revisit", sha1, *where)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        archive, held = Archive(folder, file_bytes), []
        for row in rows(batches):
            held.append(line(archive, row))
            if len(held) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
                held = []
        archive.close()  # before the last rows of the index, so that no row is there without its file
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)

    return run


def _pages(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    key = F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID))
    return pages.select(key.alias("key"), F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "key", "url", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256"), "payload"
    )


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """key, url, n, sha1, sha256, named, refers, payload: what is written of each page. A revisit has refers (a key) and no payload."""
    whole = _pages(pages)
    narrow = written(whole.select("key", "url", "n", "sha1", "sha256").where(F.col("n") >= min_revisit), "pages")
    each = narrow.groupBy("sha256", "key").agg(F.count("*").alias("rows"))
    first = each.groupBy("sha256").agg(F.max(F.struct("key", "rows")).alias("first"), F.sum("rows").alias("all")).where("all > 1")
    first = written(first.select("sha256", F.col("first.key").alias("refers"), F.col("first.rows").alias("rows"), "all"), "responses")
    met = skewed_join(narrow, first, ["sha256"], F.col("all") * HOT_SHARE >= narrow.count())
    older = written(met.where("key < refers").select(*narrow.columns, "refers"), "revisits")
    kept = whole.join(older.select("key", "sha256").distinct(), ["key", "sha256"], "left_anti")
    ties = first.where("rows > 1").select(F.col("refers").alias("key"), "sha256")
    revisits = [older]
    if not ties.isEmpty():  # rows that share the largest id and the payload: one keeps it, with the least URL
        tied = kept.join(ties, ["key", "sha256"], "left_semi")
        same = tied.groupBy("key", "n", "sha1", "sha256", "url").agg(F.count("*").alias("c"))
        url = F.min(F.struct(F.col("url").isNotNull().alias("known"), "url")).alias("least")
        least = same.groupBy("key", "sha256").agg(url)
        rest = F.col("c") - F.col("url").eqNullSafe(F.col("least.url")).cast("int")
        again = same.join(least, ["key", "sha256"]).withColumn("c", rest.cast("int")).where("c > 0")
        revisits.append(again.withColumn("refers", F.col("key")).select(*older.columns, F.explode(F.sequence(F.lit(1), "c")).alias("_")).drop("_"))
        one = tied.groupBy("key", "n", "sha1", "sha256").agg(url, F.any_value("payload").alias("payload")).withColumn("url", F.col("least.url"))
        kept = kept.join(ties, ["key", "sha256"], "left_anti").unionByName(one.select(kept.columns))
    columns = ["key", "url", "n", "sha1", "sha256", "named", "refers", "payload"]
    out = kept.withColumns({"named": F.col("n") >= min_revisit, "refers": F.lit(None).cast("long")}).select(columns)
    for x in revisits:
        out = out.unionByName(x.withColumns({"named": F.lit(False), "payload": F.lit(None).cast("binary")}).select(columns))
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark takes it to have."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def write(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) in ``folder``/archive, which must be new; returns their index, which is written to ``folder``/index."""
    spark = pages.sparkSession
    archive = qualified(spark, f"{folder}/archive")
    files, root = opened(archive)
    files.create_dir(root, recursive=True)
    records(pages, min_revisit).mapInArrow(_writer(archive, file_bytes), INDEX).write.parquet(f"{folder}/index")
    found = index(spark, folder)
    listed = {r["file"] for r in found.select("file").distinct().collect()}  # a name a file
    for f in files.get_file_info(fs.FileSelector(root)):
        if f.base_name not in listed:  # of an attempt that failed
            files.delete_file(f.path)
    return found


# Reading -----------------------------------------------------------------------------------------


def index(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, record_type, digest, file, offset, length: a row a record."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def ranges(selected: DataFrame, gap: int = GAP, chunk: int = CHUNK) -> DataFrame:
    """file, start, end, parts (offset, length): the byte ranges that hold the selected records, in order of the files."""
    spark = selected.sparkSession
    size = selected.agg(F.sum("length")).first()[0] or 0
    n = max(partitions(spark), size // TASK_BYTES)
    dealt = selected.select("file", "offset", "length", F.floor(F.col("offset") / chunk).alias("chunk")).repartition(n, "file", "chunk")
    order = Window.partitionBy("file", "chunk").orderBy("offset")
    end = F.max(F.col("offset") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = dealt.withColumn("new", F.coalesce((F.col("offset") - end > gap).cast("int"), F.lit(0))).withColumn("island", F.sum("new").over(order))
    parts = F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("parts")  # of one chunk at most
    found = islands.groupBy("file", "chunk", "island").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"), parts)
    return found.select("file", "start", "end", "parts").sortWithinPartitions("file", "start")


RECORDS = "page_id long, target_uri string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _reader(folder: str, payloads: bool):
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def fields(record: bytes) -> tuple:
        headers, http, payload = parsed(record)
        number = lambda name: int(v) if (v := headers.get(name)) else None
        n = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: ")).split(b": ")[1])
        response = headers["WARC-Type"] == "response"
        if response and n != len(payload):
            raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
        digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        return number("Page-Id"), headers["WARC-Target-URI"], headers["WARC-Type"], n, digest, number("Refers-To-Page-Id"), payload if payloads and response else None

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        name, source, held, size = None, None, [], 0
        for file, start, end, parts in rows(batches):
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, files.open_input_file(f"{root}/{file}")
            read = source.read_at(end - start, start)
            for part in parts:
                at = part["offset"] - start
                held.append(fields(read[at : at + part["length"]]))
                size += held[-1][3] if payloads else 64
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
                    held, size = [], 0
        if source is not None:
            source.close()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)

    return run


def read(spark: SparkSession, folder: str, selected: DataFrame | None = None, payloads: bool = True, gap: int = GAP, chunk: int = CHUNK) -> DataFrame:
    """The records of the selected rows of the index of ``folder`` (all of them if None), read back from the archives.

    A revisit's payload is null; its payload_bytes and payload_digest are those of the payload that it stands for. Without ``payloads`` they are all null.
    """
    chosen = index(spark, folder) if selected is None else selected
    return ranges(chosen, gap, chunk).mapInArrow(_reader(qualified(spark, f"{folder}/archive"), payloads), RECORDS)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    found = read(spark, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op11_warc": op11_warc}
ORACLES = {
    "op11_warc": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= {MIN_REVISIT} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_REVISIT} AND page_id < last THEN last END AS refers_to
FROM p
"""
}
