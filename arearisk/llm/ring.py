"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

Every shard has ``vnodes`` places on a ring of 2^32 hash values. A row's key hash falls into the arc of the next
place clockwise. A shard takes rows up to its bound; rows of an arc whose shard is full continue clockwise to the
next place of a shard with room. The bounds are the floor or the ceiling of rows / shards, so counts differ by one
at most, and only overflowing rows leave the shard that plain consistent hashing gives them.

Rows are counted per arc, and the overflow is settled on those counts, which gives each arc a short list of (first rank,
shard, first slot); a row's rank within its arc picks the entry. An arc has a lane for every ``LANE_ROWS`` rows, dealt by
row number, and ranks are taken per (arc, lane), so copies of one key spread over lanes and no window holds an arc, or a
key, whole. The driver holds a count for each arc and lane: ``shards * vnodes`` and one for ``LANE_ROWS`` rows.

Defined results: a null key hashes as empty text, a null text has size 1 and the crc32 of no bytes. Repeated rows
are placed each for itself. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

VNODES = 128
#: rows that one task ranks
LANE_ROWS = 1 << 20
RING = 1 << 32


def ring_places(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(place, shard) around the ring. A shard's places depend on its number alone, so shards can be added."""
    found: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            place = int.from_bytes(hashlib.sha256(f"shard {shard} node {v}".encode()).digest()[:4], "big")
            found.setdefault(place, shard)
    return sorted(found.items())


def settle(counts: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """Per arc, (first rank, shard, first slot, arc that took them) of its rows, bounds kept.

    First each shard takes rows of its own arcs, in ring order, up to its bound. Then the rest of every arc moves
    clockwise to the next places whose shards have room.
    """
    used = np.zeros(len(bounds), np.int64)
    out: list[list] = [[] for _ in counts]
    rest = np.zeros(len(counts), np.int64)
    for arc, (n, shard) in enumerate(zip(counts.tolist(), owner.tolist())):
        stay = int(min(n, bounds[shard] - used[shard]))
        if stay:
            out[arc].append((0, shard, int(used[shard]), arc))
            used[shard] += stay
        rest[arc] = n - stay
    for arc in np.flatnonzero(rest).tolist():
        left, at = int(rest[arc]), arc
        while left:
            at = (at + 1) % len(counts)
            shard = int(owner[at])
            go = int(min(left, bounds[shard] - used[shard]))
            if go:
                out[arc].append((int(counts[arc]) - left, shard, int(used[shard]), at))
                used[shard] += go
                left -= go
    return out


def shard_rows(rows: DataFrame, key: str, shards: int, vnodes: int = VNODES, lane_rows: int = LANE_ROWS) -> DataFrame:
    """Add ``shard``, ``slot`` and ``home_shard`` (before any overflow) to a table of narrow rows; its columns pass."""
    spark = rows.sparkSession
    places = ring_places(shards, vnodes)
    owner = np.array([s for _, s in places])
    mine = [c for c in rows.columns if c not in ("shard", "slot", "home_shard")]
    # the first place at or after the hash; past the last place the ring begins anew
    hashed = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(RING))
    cell = RING // 4096  # equal cells of the ring find the arc by an equi-join, then by the bounds of the arc
    cells = []
    for i, (p, _) in enumerate(places):
        lo = places[i - 1][0] + 1 if i else 0
        cells += [(c, i, lo, p) for c in range(lo // cell, p // cell + 1)]
    lo = places[-1][0] + 1
    cells += [(c, 0, lo, RING - 1) for c in range(lo // cell, 4096)]
    arcs = spark.createDataFrame(cells, "_cell int, _arc int, _lo long, _hi long")
    rows = (rows.select(F.struct(*mine).alias("_row"), hashed.alias("_hash"), F.monotonically_increasing_id().alias("_nth"))
            .withColumn("_cell", F.floor(F.col("_hash") / cell).cast("int"))
            .join(F.broadcast(arcs), "_cell")  # 4096 + shards * vnodes rows
            .where("_hash BETWEEN _lo AND _hi").select("_row", "_hash", "_nth", "_arc"))
    rows = C.cut_lineage(rows, "ring")  # row numbers must not change when a task runs again
    counts = np.zeros(len(places), np.int64)
    for r in rows.groupBy("_arc").agg(F.count("*").alias("n")).collect():  # shards * vnodes rows at most
        counts[r._arc] = r.n
    lanes = spark.createDataFrame([(arc, 1 + n // lane_rows) for arc, n in enumerate(counts.tolist())], "_arc int, _lanes long")
    rows = rows.join(F.broadcast(lanes), "_arc").withColumn("_lane", F.pmod(F.xxhash64("_nth"), "_lanes")).drop("_lanes")
    before, seen = [], np.zeros(len(places), np.int64)
    for arc, lane, n in sorted(tuple(r) for r in rows.groupBy("_arc", "_lane").agg(F.count("*").alias("n")).collect()):
        before.append((arc, lane, int(seen[arc])))
        seen[arc] += n
    total = int(counts.sum())
    bounds = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    rules = []
    for arc, parts in enumerate(settle(counts, owner, bounds)):
        ends = [p[0] for p in parts[1:]] + [int(counts[arc])]
        rules += [(arc, first, end, shard, slot, int(owner[arc])) for (first, shard, slot, _), end in zip(parts, ends)]
    before_df = spark.createDataFrame(before or [(0, 0, 0)], "_arc int, _lane long, _before long")
    rules_df = spark.createDataFrame(rules or [(0, 0, 0, 0, 0, 0)], "_arc int, _first long, _last long, shard int, _slot long, home_shard int")
    return (rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_arc", "_lane").orderBy("_hash", "_nth")) - 1)
            .join(before_df, ["_arc", "_lane"])
            .withColumn("_rank", F.col("_before") + F.col("_rank"))
            .join(F.broadcast(rules_df), "_arc")  # a few rows an arc: an overflow goes to few shards
            .where("_rank >= _first AND _rank < _last")
            .select("_row.*", "shard", (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot"), "home_shard"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = C.table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return shard_rows(rows, "doc_id", 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard")
