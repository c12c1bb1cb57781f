"""Best-fit packing by minimum bin slack.

Pieces of at most ``capacity`` tokens are packed by their lengths alone. For the longest length left, a dynamic
programme over a bitset of reachable sums (one bit per fill) finds the fullest combination of lengths still
available; that pattern is taken as often as the counts allow and its pieces are removed. The work depends on
``capacity`` only: the counts per length are at most ``capacity`` numbers, whatever the corpus holds.

Spark does the rest: tokenising, cutting, counting, and giving each piece its rank among the pieces of its length,
from which place and sequence follow by arithmetic. A length is split over a lane for every ``LANE_ROWS`` pieces, so no
task holds it whole; a full piece is a sequence of its own and needs no rank.

Defined results: a null or empty text is one piece holding the end id. Repeated rows are packed each for itself.
An empty table gives an empty result. Columns besides ``id_col`` and ``text_col`` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

CAPACITY = 1024
#: pieces of a length that one task ranks
LANE_ROWS = 1 << 20


def fullest(counts: np.ndarray, target: int) -> list[tuple[int, int]]:
    """(length, copies) of a combination whose sum comes nearest to ``target`` from below.

    Lengths enter from the longest to the shortest, so the combination prefers long ones, which are the hardest to
    place; it stops at the first length that makes a perfect fit possible.
    """
    if target <= 0:
        return []
    limit = (1 << (target + 1)) - 1
    reach, seen = 1, []
    for length in np.flatnonzero(counts[:target + 1])[::-1].tolist():
        if not length:
            continue
        seen.append((length, reach))
        left, step = int(min(counts[length], target // length)), 1
        while left > 0:  # copies by binary parts
            step = min(step, left)
            reach |= (reach << (length * step)) & limit
            left -= step
            step *= 2
        if reach >> target & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, before in reversed(seen):
        copies = 0
        while not before >> total & 1:
            total -= length
            copies += 1
        if copies:
            out.append((length, copies))
    return out


def patterns(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, copies), ...]) that use up ``counts`` (index: length), by minimum bin slack."""
    counts = counts.astype(np.int64).copy()
    out = []
    for longest in range(capacity, 0, -1):
        while counts[longest] > 0:
            counts[longest] -= 1
            combo = dict(fullest(counts, capacity - longest))
            counts[longest] += 1
            combo[longest] = combo.get(longest, 0) + 1
            times = min(int(counts[k]) // v for k, v in combo.items())
            for k, v in combo.items():
                counts[k] -= v * times
            out.append((times, sorted(combo.items(), reverse=True)))
    return out


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           tokenizer: str = T.TOKENIZER, end_id: int = T.END_ID) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and a number of its own, to be stored with it. A long text's
    first piece takes the remainder."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = T.encoder(T.tokenizer_path(tokenizer))
        nth = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1)):
                ids, bounds = T.with_end(*enc.encode(data, offs), end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                sizes = np.diff(bounds)
                many = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                head = (sizes - (many - 1) * capacity)[doc]
                start = np.where(piece > 0, head + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head)
                at = bounds[doc] + start
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(nth + np.arange(len(doc)), pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "nth"])
                nth += len(doc)
        enc.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    return C.map_arrow(docs.select(id_col, text_col), cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, nth long")


def pack(cut: DataFrame, capacity: int = CAPACITY, lane_rows: int = LANE_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces (it is read more than once)."""
    spark = cut.sparkSession
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = cut.where(F.col("length") == capacity).select(*columns, (-1 - F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    cut = cut.where(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # capacity rows at most
        counts[r.length] = r.n
    lanes = spark.createDataFrame([(k, 1 + int(n) // lane_rows) for k, n in enumerate(counts)], "length long, lanes long")
    cut = cut.join(F.broadcast(lanes), "length").withColumn("lane", F.pmod(F.xxhash64("nth"), "lanes"))
    before, seen = [], np.zeros(capacity + 1, np.int64)
    for length, lane, n in sorted(tuple(r) for r in cut.groupBy("length", "lane").agg(F.count("*").alias("n")).collect()):  # and a row for lane_rows pieces
        before.append((length, lane, int(seen[length])))
        seen[length] += n
    found = patterns(counts, capacity)

    # rules: ranks [first, first + copies * times) of a length go to sequences base .. base + times, copies in each
    rules: dict[int, list] = {}
    used, base = np.zeros(capacity + 1, np.int64), 0
    for times, combo in found:
        offset = 0
        for length, copies in combo:
            rules.setdefault(length, []).append((int(used[length]), copies, base, offset))
            used[length] += copies * times
            offset += copies * length
        base += times

    starts = spark.createDataFrame(before or [(0, 0, 0)], "length long, lane long, before long")
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("length", "lane").orderBy("nth")) - 1).join(starts, ["length", "lane"])
    rules_bc = spark.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in rules.items()})  # grows with capacity only

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = rules_bc.value
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length).tolist():
                rows = np.flatnonzero(length == value)
                rule = rules[value]
                rule = rule[np.searchsorted(rule[:, 0], rank[rows], side="right") - 1]
                nth = rank[rows] - rule[:, 0]
                seq[rows] = rule[:, 2] + nth // rule[:, 1]
                off[rows] = rule[:, 3] + nth % rule[:, 1] * value
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(5)], pa.array(seq), pa.array(off)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    ranked = ranked.select(*columns, (F.col("before") + F.col("rank")).alias("rank"))
    return C.map_arrow(ranked, place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").unionByName(full)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   tokenizer: str = T.TOKENIZER, end_id: int = T.END_ID) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and place."""
    return pack(C.cut_lineage(pieces(docs, id_col, text_col, capacity, tokenizer, end_id), "pieces"), capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(C.table(spark, sf_dir, "documents"))
