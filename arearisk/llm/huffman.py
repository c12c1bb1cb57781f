"""Token files: canonical length-limited Huffman codes of token ids from global counts.

Code lengths come from package-merge over the counts of the whole corpus and are limited to ``MAX_BITS``; canonical
codes follow from the lengths, so the code book file holds lengths only. Rows are dealt to ranges of the id, sorted,
and written as independent blocks: the ids of whole documents as one bit string, with the bit offset of every
``MARK``-th id (checkpoints). A reader decodes one block without any other; a table indexed by the next ``MAX_BITS``
bits gives symbol and length, and the checkpoints let it decode all stretches of a block side by side.

Files (written and read by Spark, so any store will do)::

    <path>/book    ids: one unsigned byte per id, its code length (0: id does not occur)
    <path>/blocks  part, block, first (ids of the part before the block), n_ids, doc_ids, counts, marks, payload

Defined results: a null or empty text is the end id alone; a null id sorts first. Rows of equal id are neighbours in
any order. An empty table gives files without blocks and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

MAX_BITS = 18
MARK = 128
BLOCK_IDS = 1 << 18
BLOCKS = "part int, block int, first long, n_ids long, doc_ids array<long>, counts array<long>, marks binary, payload binary"


# ---- codes -------------------------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        items = np.concatenate([weight, packages])
        by = np.argsort(items, kind="stable")
        levels.append(by < len(weight))
        items = items[by]
        half = len(items) // 2
        packages = items[:2 * half:2] + items[1:2 * half:2]
    lengths = np.zeros(len(order), np.int64)
    take = 2 * len(order) - 2
    for leaf in reversed(levels):
        n = int(leaf[:take].sum())
        lengths[:n] += 1
        take = 2 * (take - n)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code of each id: ids in order of (length, id) get consecutive codes."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    out = np.zeros(len(lengths), np.uint32)
    if len(ids):
        top = int(lengths.max())
        width = np.int64(1) << (top - lengths[ids].astype(np.int64))  # leaves below each code at the deepest level
        out[ids] = (np.cumsum(width) - width) >> (top - lengths[ids].astype(np.int64))
    return out


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """(payload, marks): codes side by side, most significant bit first, and the bits of each stretch of ``MARK`` ids."""
    if not len(ids):
        return b"", b""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    top = (codes.astype(np.uint64) << (64 - lengths.astype(np.uint64)) % np.uint64(64))[ids]  # codes from the highest bit on
    off = (at & 63).astype(np.uint64)
    word = at >> 6
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words = np.zeros(int(ends[-1] + 63 >> 6) + 1, np.uint64)
    words[word[first]] = np.bitwise_or.reduceat(top >> off, first)
    last = np.append(first[1:], len(ids)) - 1  # the last code of a word may reach into the next one
    last = last[off[last] + size[last].astype(np.uint64) > 64]
    words[word[last] + 1] |= top[last] << (np.uint64(64) - off[last])
    marks = np.diff(np.append(at[::MARK], ends[-1])).astype("<u2")
    return words.astype(">u8").tobytes()[:int(ends[-1] + 7 >> 3)], marks.tobytes()


class Decoder:
    """Table-driven decoding of blocks: the next bits index symbol and code length."""

    def __init__(self, lengths: np.ndarray):
        self.bits = max(1, int(lengths.max()) if len(lengths) else 1)
        if self.bits > 24 or len(lengths) > 1 << 27:
            raise ValueError("codes of at most 24 bits and 2^27 ids")
        self.table = np.ones(1 << self.bits, np.uint32)  # id * 32 + code length
        ids = np.flatnonzero(lengths)
        ids = ids[np.lexsort((ids, lengths[ids]))]
        width = np.int64(1) << (self.bits - lengths[ids].astype(np.int64))
        filled = int(width.sum())
        self.table[:filled] = np.repeat((ids << 5 | lengths[ids]).astype(np.uint32), width)

    def decode(self, payload: bytes, marks: bytes, n: int) -> np.ndarray:
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.zeros(len(payload) + 8 + MARK * 4, np.uint8)
        raw[:len(payload)] = np.frombuffer(payload, np.uint8)
        wide = raw.astype(np.uint32)
        window = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
        bits = np.frombuffer(marks, "<u2").astype(np.uint32)
        at = np.cumsum(bits, dtype=np.uint32) - bits
        out = np.empty((min(MARK, n), len(at)), np.uint32)
        down, low = np.uint32(32 - self.bits), np.uint32(31)
        for k in range(len(out)):  # the k-th id of every stretch; the last stretch may run on into the padding
            found = out[k]
            np.take(self.table, (window[at >> 3] << (at & 7)) >> down, out=found)
            at += found & low
        return (out.T.ravel() >> np.uint32(5))[:n]


# ---- files -------------------------------------------------------------------------------------------------------

def id_ranges(docs: DataFrame, id_col: str, parts: int) -> tuple[int, list[int]]:
    """(ranges for null ids, cuts between the ranges of the others). Quantiles are taken of the ids as doubles; where
    several fall on one double, which beyond 2^53 stands for many ids, they are taken again of the distance from it."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    rows, known = ids.agg(F.count("*"), F.count("id")).head()
    nulls = -(-parts * (rows - known) // rows) if rows > known else 0
    if parts < 2 or not known:
        return nulls, []
    number = F.col("id").cast("double")
    found = ids.select(number.alias("id")).approxQuantile("id", [k / parts for k in range(1, parts)], 0.2 / parts)
    cuts = []
    for value in sorted(set(found)):
        times = found.count(value)
        base = min(int(value), (1 << 63) - 1)
        if times > 1 and abs(base) > 1 << 53:
            near = ids.where(number == F.lit(value)).select((F.col("id") - F.lit(base)).cast("double").alias("d"))
            cuts += [base + int(d) for d in near.approxQuantile("d", [(k + 0.5) / times for k in range(times)], 0.1 / times)]
        else:
            cuts += [base] * times
    return nulls, sorted(cuts)


def tokenised(docs: DataFrame, id_col: str, text_col: str, nulls: int, bounds: list[int], tokenizer: str, end_id: int) -> DataFrame:
    """part (range of the id), doc_id, ids of every row."""
    cuts = np.array(bounds, np.int64)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = T.encoder(T.tokenizer_path(tokenizer))
        row = 0
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1)):
                ids, at = T.with_end(*enc.encode(data, offs), end_id)
                key = batch.column(0).slice(lo, hi - lo).cast(pa.int64())
                number = key.fill_null(0).to_numpy()
                low, high = np.searchsorted(cuts, number, side="left"), np.searchsorted(cuts, number, side="right")
                nth = row + np.arange(hi - lo)
                # rows of an id so frequent that several ranges begin with it are dealt over those ranges, null ids over theirs
                part = nulls + np.where(high > low + 1, low + 1 + nth % np.maximum(1, high - low), high)
                if key.null_count:
                    part = np.where(key.is_null().to_numpy(zero_copy_only=False), nth % max(1, nulls), part)
                row += hi - lo
                size = ids.dtype.itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), key,
                     pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer((at * size).astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())],
                    ["part", "doc_id", "ids"])
        enc.forget()

    return C.map_arrow(docs.select(id_col, text_col), read, "part int, doc_id long, ids binary")


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = T.TOKENIZER, end_id: int = T.END_ID, max_bits: int = MAX_BITS) -> None:
    """Write the token files of ``docs`` in ascending id order."""
    spark = docs.sparkSession
    enc = T.encoder(T.tokenizer_path(tokenizer))
    dtype, vocabulary = enc.dtype, max(enc.size, end_id + 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nulls, bounds = id_ranges(docs, id_col, parts)
    frame = tokenised(docs, id_col, text_col, nulls, bounds, tokenizer, end_id)
    # one tokenising pass: counting and encoding read the same shuffle files, which lineage can make anew
    ordered = frame.repartitionById(nulls + len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "doc_id").rdd

    def count(rows) -> Iterator[tuple[int, np.ndarray]]:
        counts = np.zeros(vocabulary, np.int64)
        for r in rows:
            counts += np.bincount(np.frombuffer(r.ids, dtype), minlength=vocabulary)
        used = np.flatnonzero(counts)
        for k in range(0, len(used), 4096):
            yield k // 4096, (used[k:k + 4096].astype(np.int32).tobytes(), counts[used[k:k + 4096]].tobytes())

    counts = np.zeros(vocabulary, np.int64)
    found = spark.createDataFrame(ordered.mapPartitions(count).flatMap(
        lambda x: zip(np.frombuffer(x[1][0], np.int32).tolist(), np.frombuffer(x[1][1], np.int64).tolist())), "id int, n long", verifySchema=False)
    for r in found.groupBy("id").agg(F.sum("n").alias("n")).collect():  # one row per id of the vocabulary
        counts[r.id] = r.n
    lengths = code_lengths(counts, max_bits)
    book = spark.sparkContext.broadcast((lengths, canonical(lengths)))

    def write(rows) -> Iterator[tuple]:
        lengths, codes = book.value
        part, number, first = None, 0, 0
        docs_in, ids_in, total = [], [], 0

        def block():
            payload, marks = encode(np.concatenate(ids_in) if ids_in else np.zeros(0, dtype), lengths, codes)
            return part, number, first, total, docs_in, [len(x) for x in ids_in], bytearray(marks), bytearray(payload)

        for r in rows:
            if docs_in and (r.part != part or total >= BLOCK_IDS):
                yield block()
                number, first = number + 1, first + total
                docs_in, ids_in, total = [], [], 0
            if r.part != part:
                part, number, first = r.part, 0, 0
            docs_in.append(r.doc_id)
            ids_in.append(np.frombuffer(r.ids, dtype))
            total += len(ids_in[-1])
        if docs_in:
            yield block()

    C.ship(spark)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/book")
    spark.createDataFrame(ordered.mapPartitions(write), BLOCKS, verifySchema=False).write.parquet(f"{path}/blocks")


def _lengths(spark: SparkSession, path: str) -> np.ndarray:
    return np.frombuffer(bytes(spark.read.parquet(f"{path}/book").head().lengths), np.uint8)


def _starts(blocks: DataFrame) -> DataFrame:
    """before: ids of all parts before each part. One row per part."""
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (array) of every document in the files."""
    book = spark.sparkContext.broadcast(_lengths(spark, path))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(book.value)
        for batch in batches:
            for r in batch.to_pylist():
                ids = decoder.decode(r["payload"], r["marks"], r["n_ids"])
                ends = np.cumsum(r["counts"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["before"] + r["first"] + ends - r["counts"]),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32)))],
                    ["doc_id", "start", "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return C.map_arrow(blocks.join(_starts(blocks.select("part", "n_ids")), "part"), read, "doc_id long, start long, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the decoded files."""
    book = spark.sparkContext.broadcast(_lengths(spark, path))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(book.value)
        for batch in batches:
            for r in batch.to_pylist():
                raw = memoryview(decoder.decode(r["payload"], r["marks"], r["n_ids"]).astype("<u4").tobytes())
                n = np.array(r["counts"], np.int64)
                ends = np.cumsum(n)
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["first"] + ends - n), pa.array(n), pa.array(crc, pa.int64()),
                     pa.array([r["part"]] * len(n), pa.int32())], ["doc_id", "start", "n_tokens", "ids_crc32", "part"])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    found = C.map_arrow(blocks, read, "doc_id long, start long, n_tokens long, ids_crc32 long, part int")
    return found.join(_starts(blocks.select("part", "n_ids")), "part").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.fresh_path(spark, "tokens")
    write_tokens(C.table(spark, sf_dir, "documents"), path)
    return read_digests(spark, path)
