"""WARC archives with a two-level capture index.

Writing. Equal payloads (SHA-256) of ``LEAST_REVISIT`` bytes or more have one
response, the page with the smallest id; the others are revisits without a
body. A record is its headers, an empty line, the payload in UTF-8 and two line
ends, all of it UTF-8; Spark's text writer puts the records of a task into
files of at most ``FILE_RECORDS``, with its commit protocol, so that a lost
executor leaves no half file.

Indexing. The files are read back as bytes and walked record by record. Each
capture gives a line: the URL key (host reversed, ``com,example)/path``), page
id, file, offset and length. Lines are range-sorted by key, cut into blocks and
compressed (level two); the directory (level one) keeps the first and the last
key of every block. Blocks hold ``BLOCK_LINES`` lines, or more where the
directory would exceed ``DIRECTORY_BLOCKS`` entries: that bounds what is
broadcast, about 200 bytes an entry.

Reading. A key is found by binary search in the directory, then in the block's
lines; that gives files and ranges. For many keys the searches run in tasks,
requests meet their block by its id, and the ranges of a file are cut from its
bytes in the task that holds it. ``read_range`` reads one range by a seek.

Defined results: null html is an empty payload; a null URL has the key ``-``;
line ends in a URL are percent-encoded; a null page_id is a response, or a
revisit if another page has its payload; rows of one page_id that share a
payload are responses all. An empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.llm.common import partitions_for, scratch_path, small_batches, written

LEAST_REVISIT = 100
FILE_RECORDS = 2000
FILES_AT_ONCE = 4  # that go to a Python worker in one batch
BLOCK_LINES = 300
DIRECTORY_BLOCKS = 100_000
DATE = "2026-01-01T00:00:00Z"
END = b"\r\n\r\n"

CAPTURE = ("key string, page_id long, file string, offset long, length long, record_type string")


# ------------------------------------------------------------------- writing

def _record(payload: Column, revisit: Column) -> Column:
    """A record but for the two line ends that close it."""
    def line(name: str, value: Column) -> Column:
        # concat is null where the value is null; such lines are left out
        return F.concat(F.lit(f"\r\n{name}: "), value)

    def urn(page: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(">"))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = F.concat_ws(
        "", F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        F.when(revisit, line("WARC-Refers-To", urn("_first"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("X-Payload-Length", F.col("_size").cast("string")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("_size").cast("string"))))
    return F.concat(lines, F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(payload))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``."""
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html"), F.lit("")).alias("html"))
    d = d.withColumns({"_digest": F.sha2(F.col("html").cast("binary"), 256),
                       "_size": F.octet_length("html")})
    # payloads met more than once; a map-side minimum, whatever their number
    firsts = written(
        d.filter(F.col("_size") >= LEAST_REVISIT).groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("_digest", "_first"), "repeated_payloads")
    d = d.join(firsts, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    (d.select(_record(F.col("html"), revisit).alias("value")).write
     .option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", FILE_RECORDS).text(path))


# ------------------------------------------------------------------- parsing

def url_key(url: str | None) -> str:
    """The sort key of a URL: reversed host, then path and query."""
    if url is None:
        return "-"
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url)
    if not m:
        return url
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/")


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], int, int]:
    """(headers, where the body begins, its length) of the record at ``at``."""
    end = data.index(END, at)
    headers = {}
    for line in data[at:end].decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        headers[name] = value
    return headers, end + 4, int(headers["Content-Length"])


def _page_of(urn: str) -> int | None:
    number = urn[len("<urn:page:"):-1]
    return int(number) if number else None


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the archive files: a file of at most FILE_RECORDS
    records a row."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
            .select("path", "content"))


def captures(spark: SparkSession, path: str) -> DataFrame:
    """The capture of every record of the archives under ``path``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, at = [], 0
                while at < len(data):
                    headers, body, size = parse_record(data, at)
                    stop = body + size + 4
                    rows.append((url_key(headers.get("WARC-Target-URI")),
                                 _page_of(headers["WARC-Record-ID"]), file, at, stop - at,
                                 headers["WARC-Type"]))
                    at = stop
                cols = list(zip(*rows)) or [()] * 6
                types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    ["key", "page_id", "file", "offset", "length", "record_type"])

    small_batches(spark, FILES_AT_ONCE)
    return archive_files(spark, path).mapInArrow(walk, CAPTURE)


# ------------------------------------------------------------------ indexing

def _line(key, page, file, offset, length) -> str:
    return "\t".join((key, "" if page is None else str(page), file, str(offset), str(length)))


def build_index(found: DataFrame) -> DataFrame:
    """Level two, written: (block, first_key, last_key, lines, data), the
    lines of each block sorted by key and compressed."""
    found = written(found, "captures")
    n = found.count()
    per_block = max(BLOCK_LINES, partitions_for(n, DIRECTORY_BLOCKS))
    order = ["key", "page_id", "file", "offset"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[str, str]] = []

        def emit(rows):
            nonlocal number
            number += 1
            data = zlib.compress("\n".join(line for _, line in rows).encode())
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([rows[0][0]]), pa.array([rows[-1][0]]),
                 pa.array([len(rows)], pa.int32()), pa.array([data], pa.binary())],
                ["block", "first_key", "last_key", "lines", "data"])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(5)]
            # tabs and line ends cannot stand in a line of the index
            keys = [k.replace("\t", "%09").replace("\n", "%0A") for k in cols[0]]
            held += [(k, _line(k, *rest)) for k, *rest in zip(keys, *cols[1:])]
            while len(held) >= per_block:
                yield emit(held[:per_block])
                del held[:per_block]
        if held:
            yield emit(held)

    small_batches(found.sparkSession)
    sorted_ = found.select("key", "page_id", "file", "offset", "length") \
        .repartitionByRange(*order).sortWithinPartitions(*order)
    return written(sorted_.mapInArrow(
        blocks, "block long, first_key string, last_key string, lines int, data binary"),
        "index_blocks")


class Directory:
    """Level one: the sparse, sorted list of blocks."""

    def __init__(self, index: DataFrame):
        rows = index.select("first_key", "last_key", "block").toArrow().to_pylist()
        rows.sort(key=lambda r: (r["first_key"].encode(), r["last_key"].encode(), r["block"]))
        self.first = [r["first_key"].encode() for r in rows]
        self.last = [r["last_key"].encode() for r in rows]
        self.block = [r["block"] for r in rows]

    def blocks(self, key: str) -> list[int]:
        """The blocks that can hold ``key``: a key may fill several."""
        k = key.encode()
        i = bisect_left(self.last, k)
        out = []
        while i < len(self.first) and self.first[i] <= k:
            out.append(self.block[i])
            i += 1
        return out


def search_block(data: bytes, keys: list[str]) -> list[tuple[str, int | None, str, int, int]]:
    """The captures of the sorted lines in ``data`` with one of ``keys``."""
    lines = [line.split("\t") for line in zlib.decompress(data).decode().split("\n")]
    have = [line[0].encode() for line in lines]
    out = []
    for key in keys:
        k = key.encode()
        i = bisect_left(have, k)
        while i < len(have) and have[i] == k:
            _, page, file, offset, length = lines[i]
            out.append((key, int(page) if page else None, file, int(offset), int(length)))
            i += 1
    return out


def lookup(index: DataFrame, urls: DataFrame) -> DataFrame:
    """(key, page_id, file, offset, length) of every capture of the URLs in
    the one column of ``urls``."""
    directory = index.sparkSession.sparkContext.broadcast(Directory(index))

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for url in batch.column(0).to_pylist():
                if url is not None:
                    url = url.replace("\r", "%0D").replace("\n", "%0A")
                keys.append(url_key(url).replace("\t", "%09"))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(b, key) for key in batch.column(0).to_pylist()
                     for b in directory.value.blocks(key)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in found], pa.int64()),
                 pa.array([key for _, key in found], pa.string())], ["block", "key"])

    def search(requests: pa.Table, block: pa.Table) -> pa.Table:
        rows = []
        if requests.num_rows and block.num_rows:
            rows = search_block(block.column("data")[0].as_py(),
                                sorted(set(requests.column("key").to_pylist())))
        cols = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.table({name: pa.array(c, t) for name, c, t in zip(
            ("key", "page_id", "file", "offset", "length"), cols, types)})

    small_batches(index.sparkSession)
    # each key once, before it is sent to the blocks that it fills
    keys = urls.mapInArrow(keys_of, "key string").distinct()
    requests = keys.mapInArrow(find, "block long, key string")
    return requests.groupBy("block").cogroup(index.select("block", "data").groupBy("block")) \
        .applyInArrow(search, "key string, page_id long, file string, offset long, length long")


# ------------------------------------------------------------------- reading

def read_range(spark: SparkSession, file: str, offset: int, length: int) -> bytes:
    """One record by a seek, from any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        stream.seek(offset)
        return bytes(stream.readNBytes(length))
    finally:
        stream.close()


def read_record(data: bytes) -> dict:
    """The page that a record tells of; raises if its body and digest differ."""
    headers, body, size = parse_record(data)
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = data[body:body + size]
    response = headers["WARC-Type"] == "response"
    if response and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return {"page_id": _page_of(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"),
            "payload": payload if response else None,
            "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": digest,
            "record_type": headers["WARC-Type"],
            "refers_to": None if response else _page_of(headers["WARC-Refers-To"])}


def read_captures(spark: SparkSession, path: str, wanted: DataFrame, bodies: bool = False) -> DataFrame:
    """The records of ``wanted`` (file, offset, length): page_id,
    payload_bytes, payload_digest, record_type, refers_to and, if asked for,
    payload. Ranges are cut from a file's bytes; every body is checked."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if bodies:
        schema, names, types = schema + ", payload binary", names + ["payload"], types + [pa.binary()]

    def cut(ranges: pa.Table, files: pa.Table) -> pa.Table:
        rows = []
        if ranges.num_rows and files.num_rows:
            content = memoryview(pa.decompress(
                files.column("data").chunk(0)[0].as_buffer(),
                decompressed_size=files.column("size")[0].as_py(), codec="zstd"))
            offset, length = ranges.column("offset").to_numpy(), ranges.column("length").to_numpy()
            for at in np.argsort(offset, kind="stable"):
                rows.append(read_record(bytes(content[offset[at]:offset[at] + length[at]])))
        return pa.table({n: pa.array([r[n] for r in rows], t) for n, t in zip(names, types)})

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # files travel to the task of their ranges compressed
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1)):
                data = data.as_buffer()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.as_py()]), pa.array([data.size], pa.int64()),
                     pa.array([pa.compress(data, codec="zstd", asbytes=True)], pa.binary())],
                    ["file", "size", "data"])

    small_batches(spark, FILES_AT_ONCE)
    ranges = wanted.select("file", "offset", "length")
    files = archive_files(spark, path).mapInArrow(squeeze, "file string, size long, data binary")
    return ranges.groupBy("file").cogroup(files.groupBy("file")).applyInArrow(cut, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, index them, look every URL up and read the
    records found: one row per row of ``pages``."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    index = build_index(captures(spark, path))
    found = lookup(index, pages.select(F.col("url").cast("string")))
    return read_captures(spark, path, found)
