"""WARC archives of pages, written and read as a chunked record table.

A payload of any size is rows of (record, chunk, at most ``CHUNK`` bytes); no task holds more than a batch of them.

1. The chunk table is made in one pass over the pages and stored. The chunks of a record follow each other in a task, so
   each row carries the length and the SHA-256 of the payload up to its end; the last chunk's are the record's. A chunk's
   bytes are stored, and shuffled later, compressed one by one.
2. Records are narrow rows. Of equal payloads (length and SHA-256) of at least ``LEAST`` bytes the smallest page id is the
   response. The counts per payload are partial aggregates, and a payload that a third of all pages share is one row on
   the other side of a join that adaptive execution splits.
3. One row a record (its header) and its chunks are dealt to archives by record and sorted. The body of a response is
   written in HTTP's chunked transfer coding, a chunk a row, so the rows, each ended by CR LF, are the bytes of a WARC 1.1
   file. Revisits have no body. An archive is one gzip file, which Spark reads in one task from start to end, and the
   number of archives grows with the bytes.
4. The reader takes the pieces between CR LFs, which are no longer than a chunk, through a parser that holds the state of
   one record, hashes the body as it comes and compares it with the header.

Defined results: a null payload is empty. A null page id is larger than any other, and a revisit of such a page refers to
null. Repeated rows are records of their own; of rows with one page id and payload one is the response. A null url
leaves out the target URI. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: bytes of a chunk
CHUNK = 1 << 16
#: payloads below so many bytes are always written out
LEAST = 100
#: payload bytes of an archive, about
ARCHIVE = 256 << 20
DATE = "2000-01-01T00:00:00Z"

END = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record long, page_id string, url string, chunk long, last boolean, bytes long, digest string, size int, data binary"
CODEC = "zstd"
RECORD = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def chunk_table(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", chunk: int = CHUNK) -> DataFrame:
    """The payloads in chunks, with the length and digest up to each."""
    rows = pages.select(F.monotonically_increasing_id().alias("record"), F.col(id_col).cast("string").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    last = F.greatest(F.ceil(F.length("payload") / chunk) - 1, F.lit(0)).cast("long")
    parts = (rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"))
             .select("record", "page_id", "url", "chunk", (F.col("chunk") == last).alias("last"),
                     F.expr(f"substring(payload, cast(chunk * {chunk} + 1 as int), {chunk})").alias("data")))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, size = hashlib.sha256(), 0
        codec = pa.Codec(CODEC)
        for batch in batches:
            ends, digests, sizes, packed = [], [], [], []
            for k, data in zip(batch.column("chunk").to_pylist(), batch.column("data")):
                if k == 0:
                    state, size = hashlib.sha256(), 0
                held = data.as_buffer()
                state.update(held)
                size += len(held)
                ends.append(size)
                digests.append(state.hexdigest())
                sizes.append(len(held))
                packed.append(codec.compress(held, asbytes=True))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(ends, pa.int64()), pa.array(digests, pa.string()), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())],
                ["record", "page_id", "url", "chunk", "last", "bytes", "digest", "size", "data"])

    return C.map_arrow(parts, digest, CHUNKS)


def decide(chunks: DataFrame, scratch: C.Scratch, kind: str = "string", least: int = LEAST) -> DataFrame:
    """record, page_id, url, bytes, digest, type, and of the response that a revisit refers to: page_id, url, record."""
    records = scratch.cut(chunks.where("last").select("record", "page_id", "url", "bytes", "digest"), "records")
    order = F.struct(F.col("page_id").isNull(), F.col("page_id").cast(kind), "record", "page_id", "url")
    shared = (records.where(F.col("bytes") >= least).groupBy("bytes", "digest").agg(F.count("*").alias("n"), F.min(order).alias("first"))
              .where("n > 1").select("bytes", "digest", F.col("first.record").alias("to_record"), F.col("first.page_id").alias("to_page"),
                                     F.col("first.url").alias("to_url")))
    shared = scratch.cut(shared, "shared")
    again = F.coalesce(F.col("record") != F.col("to_record"), F.lit(False))
    return (records.join(shared, ["bytes", "digest"], "left")
            .withColumn("type", F.when(again, "revisit").otherwise("response")))


def record_id(record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'record {record}')}>"


def chunked_size(size: int, chunk: int) -> int:
    """Bytes of a body in chunked transfer coding."""
    whole, rest = divmod(size, chunk)
    return whole * (len(f"{chunk:x}") + 4 + chunk) + (len(f"{rest:x}") + 4 + rest if rest else 0) + 5


def header(row: dict, chunk: int, date: str) -> str:
    """The lines of a record before its body; the last line's end is left to the writer."""
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    body = 0
    if row["type"] == "response":
        http.append("Transfer-Encoding: chunked")
        body = chunked_size(row["bytes"], chunk)
    else:
        http.append(f"Content-Length: {row['bytes']}")
    size = sum(len(line) + 2 for line in http) + 2 + body
    lines = ["WARC/1.1", f"WARC-Type: {row['type']}", f"WARC-Record-ID: {record_id(row['record'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + quote(row["url"], safe=":/?#[]@!$&'()*+,;=%"))
    lines.append(f"WARC-Payload-Digest: sha256:{row['digest']}")
    if row["type"] == "revisit":
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(row['to_record'])}"]
        if row["to_url"] is not None:
            lines.append("WARC-Refers-To-Target-URI: " + quote(row["to_url"], safe=":/?#[]@!$&'()*+,;=%"))
        if row["to_page"] is not None:
            lines.append("X-Refers-To-Page-ID: " + quote(row["to_page"]))
    if row["page_id"] is not None:
        lines.append("X-Page-ID: " + quote(row["page_id"]))
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}", "", *http]
    return END.join(lines) + END  # the writer's end closes the HTTP header


def write_archives(chunks: DataFrame, records: DataFrame, path: str, chunk: int = CHUNK, date: str = DATE, archive: int = ARCHIVE) -> None:
    """Write the archives of stored chunks and records as gzip files."""
    spark = chunks.sparkSession
    total = records.agg(F.sum("bytes")).head()[0] or 0
    archives = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // archive))
    heads = records.select("record", F.lit(-1).cast("long").alias("chunk"), F.struct(*records.columns).alias("head"),
                           F.lit(False).alias("last"), F.lit(0).alias("size"), F.lit(None).cast("binary").alias("data"))
    bodies = chunks.select("record", "chunk", F.lit(None).cast(heads.schema["head"].dataType).alias("head"), "last", "size", "data")
    dealt = heads.unionByName(bodies).repartition(archives, "record").sortWithinPartitions("record", "chunk")

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = opened = False
        codec = pa.Codec(CODEC)
        for batch in batches:
            out = []
            if not opened and len(batch):
                about = "software: arearisk\r\nformat: WARC File Format 1.1\r\n"
                out.append(END.join(["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(-1)}", f"WARC-Date: {date}",
                                     "Content-Type: application/warc-fields", f"Content-Length: {len(about)}", "", about, ""]).encode())
                opened = True
            for head, last, size, data in zip(batch.column("head"), batch.column("last").to_pylist(), batch.column("size").to_pylist(), batch.column("data")):
                if head.is_valid:
                    row = head.as_py()
                    written = row["type"] == "response"
                    out.append(header(row, chunk, date).encode())
                    if not written:
                        out.append(b"\r\n")
                elif written:
                    if size:
                        out.append(b"%x\r\n" % size + codec.decompress(data.as_buffer(), size, asbytes=True))
                    if last:
                        out.append(b"0\r\n\r\n\r\n")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = C.map_arrow(dealt, compose, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


class Parser:
    """Reads the pieces between CR LFs of archives, each with all of its records, and keeps the state of one record."""

    def __init__(self):
        self.step, self.found = self.between, []

    def between(self, piece: bytes) -> None:
        if piece.startswith(b"WARC/"):
            self.fields, self.step = {}, self.named
        elif piece:
            raise ValueError(f"no record starts with {piece[:40]!r}")

    def named(self, piece: bytes) -> None:
        if piece:
            name, _, value = piece.partition(b":")
            self.fields[name.strip().lower()] = value.strip().decode()
            return
        self.http, self.state, self.size = {}, hashlib.sha256(), 0
        self.left = int(self.fields[b"content-length"])
        self.step = self.status if self.fields[b"warc-type"] in ("response", "revisit") else self.other

    def other(self, piece: bytes) -> None:
        self.left -= len(piece) + 2
        if self.left <= 0:
            self.step = self.between

    def status(self, piece: bytes) -> None:
        if piece:
            name, _, value = piece.partition(b":")
            self.http[name.strip().lower()] = value.strip().decode()
        elif self.fields[b"warc-type"] == "revisit":
            self.size = int(self.http[b"content-length"])
            self.close(self.fields[b"warc-payload-digest"].partition(":")[2])
        else:
            self.step = self.length

    def length(self, piece: bytes) -> None:
        self.left = int(piece, 16)
        if self.left:
            self.size += self.left
            self.step = self.data
        else:
            digest = self.state.hexdigest()
            if f"sha256:{digest}" != self.fields[b"warc-payload-digest"]:
                raise ValueError(f"the payload of {self.fields[b'warc-record-id']} does not have its digest")
            self.close(digest)

    def data(self, piece: bytes) -> None:
        self.state.update(piece)
        self.left -= len(piece)
        if self.left == 0:
            self.step = self.length
        elif self.left < 2:
            raise ValueError(f"a chunk of {self.fields[b'warc-record-id']} ends early")
        else:
            self.state.update(b"\r\n")  # part of the payload
            self.left -= 2

    def close(self, digest: str) -> None:
        page, to = self.fields.get(b"x-page-id"), self.fields.get(b"x-refers-to-page-id")
        self.found.append((None if page is None else unquote(page), self.size, digest, self.fields[b"warc-type"], None if to is None else unquote(to)))
        self.step = self.between


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, from the archives' bytes."""

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            for piece in batch.column(0):
                parser.step(piece.as_buffer().to_pybytes())
            got, parser.found = parser.found, []
            columns = list(zip(*got)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                                             ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if parser.step != parser.between:
            raise ValueError("an archive ends inside a record")

    lines = spark.read.option("lineSep", END).schema("value string").text(path)
    return C.map_arrow(lines.select(F.col("value").cast("binary")), parse, RECORD)


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", chunk: int = CHUNK,
                  least: int = LEAST, date: str = DATE, archive: int = ARCHIVE) -> None:
    """Write one record per row of ``pages`` to archives under ``path``."""
    scratch = C.Scratch(pages.sparkSession)
    chunks = scratch.cut(chunk_table(pages, id_col, url_col, payload_col, chunk), "chunks")
    records = scratch.cut(decide(chunks, scratch, pages.schema[id_col].dataType.simpleString(), least), "decided")
    write_archives(chunks, records, path, chunk, date, archive)
    scratch.drop()


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.table(spark, sf_dir, "pages")
    path = C.fresh_path(spark, "warc")
    archive_pages(pages, path)
    kind = pages.schema["page_id"].dataType
    return read_archives(spark, path).withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


ORACLE_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_bytes, payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to FROM f
"""
