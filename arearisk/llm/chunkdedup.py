"""Exact deduplication by content-defined chunk recipes.

A text without its white space is cut into chunks where a rolling hash of 32 bytes has ten zero bits, so equal
stretches give equal chunks wherever they stand. A text's recipe is its ordered list of chunk identifiers; equal
recipes mean equal texts once identifiers are verified. Verification moves each chunk, not each document: the chunks
of all rows are made distinct by (identifier, content) with map-side combining, and an identifier with two contents
makes the pass start again with wider identifiers. Long documents never move as one value, and copies of a chunk
leave a map task once.

Of equal texts the row with the most code points stays, then the smallest id, then the earliest row. A group of any
size is folded by a partial aggregate; the result is joined back from a stored table, which adaptive execution
splits when one group is hot.

Defined results: null counts as empty; all empty texts are one group. A null id loses against any id. Repeated rows
form a group of which one row stays. An empty table gives an empty result. Other columns are carried when asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SMALLEST, LARGEST = 256, 8192
_GEAR = (C.symbol_table(21) >> np.uint64(31)).astype(np.uint32)
_KEPT = np.array([not (b == 0x20 or 9 <= b <= 13) for b in range(256)])


def normalised(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts without white space."""
    kept = _KEPT[data]
    return data[kept], np.concatenate(([0], np.cumsum(kept)))[offs]


def chunk_ends(data: np.ndarray, offs: np.ndarray) -> list[list[int]]:
    """Ends of each text's chunks. The hash of a place covers 32 bytes and no place lies within ``SMALLEST`` bytes of
    a chunk's start, so neighbours in the block have no influence."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    places = np.flatnonzero((h >> np.uint32(22)) == 0) + 1
    out = []
    for a, b, first, last in zip(offs[:-1].tolist(), offs[1:].tolist(), np.searchsorted(places, offs[:-1]).tolist(),
                                 np.searchsorted(places, offs[1:], side="right").tolist()):
        ends, at = [], a
        for p in places[first:last].tolist():
            while p - at > LARGEST:
                at += LARGEST
                ends.append(at)
            if p - at >= SMALLEST and p <= b:
                at = p
                ends.append(p)
        while b - at > LARGEST:
            at += LARGEST
            ends.append(at)
        if b > at:
            ends.append(b)
        out.append(ends)
    return out


def identifier(chunk, bits: int) -> bytes:
    """``bits`` of a 128-bit hash, seeded by the width so that a wider pass is a new one."""
    return xxhash.xxh3_128_digest(chunk, seed=bits)[:bits // 8]


def recipes(docs: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """row, doc_id, text_hash, points, text_sha256, recipe (identifiers side by side) of every row."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1)):
                points = C.code_points(data, offs)
                data, offs = normalised(data, offs)
                raw = memoryview(data.tobytes())
                made, shas = [], []
                for a, b, ends in zip(offs[:-1].tolist(), offs[1:].tolist(), chunk_ends(data, offs)):
                    shas.append(hashlib.sha256(raw[a:b]).hexdigest())
                    made.append(b"".join([identifier(raw[x:y], bits) for x, y in zip([a, *ends], ends)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + hi - lo)), batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array(points), pa.array(shas, pa.string()), pa.array(made, pa.binary())],
                    ["row", "doc_id", "text_hash", "points", "text_sha256", "recipe"])
                row += hi - lo

    kind = docs.schema[id_col].dataType.simpleString()
    return C.map_arrow(docs.select(id_col, text_col, C.text_hash(text_col)), read,
                       f"row long, doc_id {kind}, text_hash long, points long, text_sha256 string, recipe binary")


def chunks(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """identifier, content of every chunk, once for each task's block."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in C.blocks(batch.column(0)):
                data, offs = normalised(data, offs)
                raw = data.tobytes()
                found = {raw[x:y] for a, ends in zip(offs[:-1].tolist(), chunk_ends(data, offs)) for x, y in zip([a, *ends], ends)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([identifier(c, bits) for c in found], pa.binary()), pa.array(list(found), pa.binary())],
                    ["identifier", "content"])

    return C.map_arrow(docs.select(text_col), read, "identifier binary, content binary")


def ambiguous(docs: DataFrame, text_col: str, bits: int) -> bool:
    """Whether one identifier stands for two contents."""
    distinct = chunks(docs, text_col, bits).distinct()
    return not distinct.groupBy("identifier").count().where("count > 1").isEmpty()


def group_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """One row per input row: row, doc_id, keep_id, group_size, kept, text_sha256, and a hash of the text as it is."""
    while ambiguous(docs, text_col, bits):
        if bits >= 128:
            raise ValueError("two chunks with equal 128-bit identifiers")
        bits = min(128, 2 * bits)
    made = C.cut_lineage(recipes(docs, id_col, text_col, bits), "recipes")
    best = F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "row")
    groups = C.cut_lineage(made.groupBy("recipe").agg(F.count("*").alias("group_size"), F.min(best).alias("best"))
                           .where("group_size > 1")
                           .select("recipe", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")),
                           "copies")
    single = F.col("keep_row").isNull()
    return made.join(groups, "recipe", "left").select(
        "row", "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("keep_row") == F.col("row"))).alias("kept"), "text_sha256", "text_hash")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay."""
    return C.without(docs, group_copies(docs, id_col, text_col).where("group_size > 1"), id_col, text_col)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_copies(C.table(spark, sf_dir, "documents")).drop("row", "text_hash")


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, row_number() OVER () AS nth,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id, nth) AS place,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY place) AS keep_id, group_size,
       place = 1 AS kept, text_sha256
FROM r
"""
