"""Exact Jaccard join of shingle sets by universe partition and pigeonhole, and its connected components.

``segments`` says which segment signatures a set is indexed under. The join:

1. One narrow row per document: size and hash of its shingle set. Documents with equal sets are one class; only one
   copy of a set per task goes on.
2. Signatures leave a task packed per bucket. A bucket is sorted in arrays; a signature that few sets share gives
   pairs (kept if they share as many segments as a linked pair must), one that many share a row per set (a frequent segment).
3. A set may leave out ``slack`` - 1 segments; it leaves out its most frequent ones. The order by frequency is the
   same for all sets, so the rarest segment that a linked pair shares is kept on both sides.
4. Frequent segments left over (large groups of near copies) are compared with one member first, the set with the
   most frequent segments. Links make components; only members of different components are compared further.
5. Those are split by a second, finer partition of the universe, of which each may leave out its most frequent two thirds:
   sets that have a passage in common meet in the first partition, and part here unless they may be linked. Members
   that still share a segment are compared in blocks, with parity bitmaps as an exact lower bound of the difference
   before the sets themselves.
6. Every pair is verified on the shingle sets of its texts, whose words are compared byte by byte. Sets are told apart,
   and their sizes counted, by 64-bit hashes with a seed drawn for the run.

No pairs of a large group are emitted: links go between the components found so far, blocks carry texts and give links
that join components. Texts move only for sets that have a candidate partner. A task holds the members of one signature,
about 40 bytes each, and any number of them. Stored tables that only lead to the result are deleted on the way.

Defined results: a null text or one without words has an empty set and is linked with nothing; one with fewer than
five words is one shingle. Repeated rows and equal texts are linked. A null id is never the smallest unless all are.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import segments as S
from .components import components

#: a signature shared by more sets counts as frequent
PAIRED = 4
#: shingles whose signatures make a bucket, about: a set has an entry in each bucket that one of its signatures falls into,
#: so few large buckets are less to shuffle
BUCKET = 4_000_000
#: signatures of a bucket that are sorted at a time
SORTED = 1 << 19
#: sets of a bucket whose numbers fit beside a signature's 40 bits; more are sorted by both
OWNERS = 1 << 24
#: sets in a block of a large group
BLOCK = 256
READ_BYTES = 1 << 20
#: bits of the map that keeps texts without a candidate partner out of a shuffle (4 MB)
FILTER_BITS = 1 << 25


def new_seed() -> int:
    """Of the word hashes of one run: no text can be written so that its words collide."""
    return secrets.randbits(63)


def doc_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (64-bit hash of the set; null if empty) of every row."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1), READ_BYTES):
                sets, bounds = S.shingle_sets(data, offs, seed)
                n = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                     pa.array(S.set_hashes(sets, bounds)[0].view(np.int64), mask=n == 0)], ["doc_id", "text_hash", "n_shingles", "node"])

    kind = docs.schema[id_col].dataType.simpleString()
    return C.map_arrow(docs.select(id_col, text_col, C.text_hash(text_col)), read, f"doc_id {kind}, text_hash long, n_shingles long, node long")


# ---- signatures ----------------------------------------------------------------------------------------------------

_ENTRY = np.dtype([("node", "<u8"), ("n", "<u4"), ("slack", "<i2"), ("count", "<u2"), ("band", "u1")])


def _columns(rec: np.ndarray) -> bytes:
    """The entries field by field, and these byte by byte: most high bytes are 0, which the shuffle's compression likes."""
    return b"".join(np.ascontiguousarray(rec[f]).view(np.uint8).reshape(len(rec), -1).T.tobytes() for f in _ENTRY.names)


def _entries(raw: bytes) -> np.ndarray:
    n, at = len(raw) // _ENTRY.itemsize, 0
    rec = np.empty(n, _ENTRY)
    for f in _ENTRY.names:
        kind = _ENTRY[f]
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        rec[f] = np.ascontiguousarray(planes.T).view(kind).ravel()
        at += n * kind.itemsize
    return rec


def bucket_count(shingles: int, cores: int) -> int:
    """Two buckets for each core as long as they are not tiny, and more where these would be large."""
    return max(1, -(-shingles // BUCKET), min(2 * cores, -(-shingles // SORTED)))


def packed_signatures(docs: DataFrame, text_col: str, buckets: int, seed: int = 0) -> DataFrame:
    """bucket, entries, keys: the signatures of a block of texts that fall into a bucket, packed."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offs in C.blocks(batch.column(0), READ_BYTES):
                sets, bounds = S.shingle_sets(data, offs, seed)
                node = S.set_hashes(sets, bounds)[0]
                _, once = np.unique(node, return_index=True)
                fresh = [i for i in np.sort(once).tolist() if bounds[i + 1] > bounds[i] and int(node[i]) not in seen]
                if len(seen) > 500_000:
                    seen.clear()  # a set that comes again is only sent again
                seen.update(node[fresh].tolist())
                if not fresh:
                    continue
                node = node[fresh]
                size = np.diff(bounds)[fresh]
                sets = np.concatenate([sets[bounds[i]:bounds[i + 1]] for i in fresh])
                bounds = np.append(0, np.cumsum(size))
                entry, band, slack, first, made = S.signatures(sets, bounds)
                bucket = (made % np.uint64(buckets)).astype(np.int64)
                owner = np.repeat(np.arange(len(entry)), np.diff(first))
                order = np.lexsort((owner, bucket))
                bucket, owner, key = bucket[order], owner[order], (made // np.uint64(buckets))[order]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2))
                out_bucket, out_entry, out_key = [], [], []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    who, at, count = np.unique(owner[a:b], return_index=True, return_counts=True)
                    rec = np.zeros(len(who), _ENTRY)
                    rec["node"], rec["n"], rec["count"], rec["band"] = node[entry[who]], size[entry[who]], np.minimum(count, 65535), band[who]
                    rec["slack"] = np.clip(slack[who], 0, 32767)
                    if count.max() > 65535:
                        rec = np.repeat(rec, -(-count // 65535))
                        rec["count"] = np.concatenate([[65535] * (c // 65535) + [c % 65535] * (c % 65535 > 0) for c in count.tolist()])
                    out_bucket.append(int(bucket[a]))
                    out_entry.append(_columns(rec))
                    low = key[a:b] & np.uint64((1 << 40) - 1)
                    out_key.append(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int32()), pa.array(out_entry, pa.binary()), pa.array(out_key, pa.binary())],
                                                 ["bucket", "entries", "keys"])

    return C.map_arrow(docs.select(text_col), read, "bucket int, entries binary, keys binary")


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= S.SIMILARITY * np.maximum(a, b)


def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the signatures of each bucket: the members of frequent signatures, and pairs (run null; slack then holds the
    segments that a linked pair must share, members those found here). A bucket is held as it came, packed, and sorted in
    ranges of its signatures, of which all copies are in one."""
    buckets: dict[int, list] = {}
    for batch in batches:
        for bucket, entries, keys in zip(*(c.to_pylist() for c in batch.columns)):
            buckets.setdefault(bucket, []).append((entries, keys))
    for bucket in list(buckets):
        parts = buckets.pop(bucket)
        rec = np.concatenate([_entries(e) for e, _ in parts])
        packed = np.frombuffer(b"".join(k for _, k in parts), np.uint8).reshape(-1, 5)
        del parts
        # entries of one set and segmentation, which several tasks may have sent, count as the last of them
        order = np.lexsort((rec["band"], rec["node"]))
        last = np.append((np.diff(rec["node"][order]) != 0) | (np.diff(rec["band"][order]) != 0), True)
        back, member = order[last].astype(np.int32), np.empty(len(rec), np.int32)
        member[order] = np.cumsum(last) - last
        del order, last
        owner = np.repeat(member, rec["count"])
        ranges = min(-(-len(packed) // SORTED), 256)
        part = (packed[:, 0].astype(np.uint16) * ranges >> 8).astype(np.uint8)
        for r in range(ranges):
            at = np.flatnonzero(part == r)
            if len(at):
                yield _match_range(bucket, rec, back, owner[at], packed[at])


def _match_range(bucket: int, rec: np.ndarray, back: np.ndarray, owner: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
    """``match`` of the signatures ``packed`` of the sets ``owner``; ``back``: the entry of each set."""
    wide = np.zeros((len(packed), 8), np.uint8)
    wide[:, :5] = packed
    key = wide.view("<u8").ravel()
    if len(back) <= OWNERS:  # key and set in one number
        both = np.unique(key << np.uint64(24) | owner.astype(np.uint64))
        key, owner = both >> np.uint64(24), back[(both & np.uint64((1 << 24) - 1)).astype(np.int64)]
    else:
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        fresh = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))
        key, owner = key[fresh], back[owner[fresh]]
    first = np.flatnonzero(np.diff(key, prepend=key[0] ^ np.uint64(1)))
    size = np.diff(np.append(first, len(key)))
    pairs = []
    for c in range(2, PAIRED + 1):
        run = first[size == c]
        pairs += [np.stack([owner[run + i], owner[run + j]]) for i in range(c) for j in range(i)]
    a, b = np.concatenate(pairs, axis=1) if pairs else (np.zeros(0, int), np.zeros(0, int))
    node, n = rec["node"].view(np.int64), rec["n"].astype(np.int64)
    good = _near(n[a], n[b]) & (node[a] != node[b])
    a, b = a[good], b[good]
    a, b = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
    ab, at, shared = np.unique(np.stack([node[a], node[b], rec["band"][a].astype(np.int64)], axis=1), axis=0, return_index=True, return_counts=True)
    need = S.least_shared(rec[a[at]], rec[b[at]])
    many = np.repeat(size, size)
    at_hot = np.flatnonzero(many > PAIRED)
    hot = owner[at_hot]
    none = len(ab)

    def both_kinds(x, y, kind):
        return pa.concat_arrays([x, y]).cast(kind)

    return pa.RecordBatch.from_arrays([
        both_kinds(pa.nulls(none, pa.int64()), pa.array(C.mix(key[at_hot] * np.uint64(1 << 20) + np.uint64(bucket)).view(np.int64)), pa.int64()),
        both_kinds(pa.array(ab[:, 0]), pa.array(node[hot]), pa.int64()),
        both_kinds(pa.array(ab[:, 1]), pa.nulls(len(hot), pa.int64()), pa.int64()),
        both_kinds(pa.array(ab[:, 2].astype(np.int32)), pa.array(rec["band"][hot].astype(np.int32)), pa.int32()),
        both_kinds(pa.nulls(none, pa.int64()), pa.array(n[hot]), pa.int64()),
        both_kinds(pa.array(need.astype(np.int32)), pa.array(rec["slack"][hot].astype(np.int32)), pa.int32()),
        both_kinds(pa.array(shared.astype(np.int64)), pa.array(many[at_hot].astype(np.int64)), pa.int64())],
        ["run", "a", "b", "band", "n", "slack", "members"])


# ---- verification --------------------------------------------------------------------------------------------------

def verify_pairs(pairs: DataFrame, texts: DataFrame, seed: int = 0) -> DataFrame:
    """The linked ones of (a, b), by the texts (node, text)."""
    rows = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                n = part.num_rows
                sets, at = S.exact_sets(*C.text_buffers(pa.concat_arrays([part.column(2), part.column(3)])), seed)
                good = [S.linked(sets[at[i]:at[i + 1]], sets[at[n + i]:at[n + i + 1]]) for i in range(n)]
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return C.map_arrow(rows, check, "a long, b long")


def link_block(part: pd.DataFrame, seed: int = 0) -> pd.DataFrame:
    """Links that join different components inside a pair of blocks."""
    part = part.drop_duplicates("node").reset_index(drop=True)
    sets, bounds = S.exact_sets(*C.text_buffers(pa.array(part["text"], pa.string())), seed)
    n, node = np.diff(bounds), part["node"].to_numpy()
    group = {c: c for c in part["component"]}

    def top(c):
        while group[c] != c:
            group[c] = group[group[c]]
            c = group[c]
        return c

    bits = 1 << int(max(512, 2 * int(n.max(initial=1)))).bit_length()
    maps = S.parity_maps(sets, bounds, min(bits, 1 << 15))
    blocks, label = part["block"].to_numpy(), part["component"].to_numpy()
    one, other = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks == blocks.max())
    out = []
    for i in one.tolist():
        to = other[other > i] if blocks.min() == blocks.max() else other
        to = to[_near(n[to], n[i]) & (label[to] != label[i])]
        if len(to):
            apart = np.bitwise_count(maps[to] ^ maps[i]).sum(axis=1)
            to = to[apart * 9 <= n[to] + n[i]]
        for j in to.tolist():
            x, y = top(label[i]), top(label[j])
            if x != y and S.linked(sets[bounds[i]:bounds[i + 1]], sets[bounds[j]:bounds[j + 1]]):
                group[max(x, y)] = min(x, y)
                out.append((min(node[i], node[j]), max(node[i], node[j])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def open_runs(runs: DataFrame, found: DataFrame, scratch: C.Scratch) -> tuple[DataFrame, DataFrame]:
    """Members (a, component) of frequent signatures that more than one component shares, and edges (a, b) between the
    components of each, from its smallest: members that are linked already are one end of an edge, however many."""
    named = runs.select("run", "a").join(found.withColumnRenamed("node", "a"), "a", "left").select(
        "run", "a", F.coalesce("component", "a").alias("component"))
    named = scratch.cut(named, "runs")
    opened = scratch.cut(named.groupBy("run").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("run", "lo"), "runs")
    members = scratch.cut(named.join(opened, "run").select("a", "component", "lo").distinct(), "runs")
    edges = members.where("component <> lo").select(F.col("lo").alias("a"), F.col("component").alias("b")).distinct()
    return members.select("a", "component").distinct(), edges


def fine_runs(members: DataFrame, texts: DataFrame, seed: int, scratch: C.Scratch) -> DataFrame:
    """Stored (run, a): the segments of the second partition that ``members`` share and do not leave out."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1), READ_BYTES // 4):
                sets, bounds = S.shingle_sets(data, offs, seed)
                which, band, slack, made = S.fine_signatures(sets, bounds)
                node = batch.column(0).slice(lo, hi - lo).take(pa.array(which))
                yield pa.RecordBatch.from_arrays([pa.array(made.view(np.int64)), node, pa.array(band.astype(np.int32)), pa.array(slack.astype(np.int32))],
                                                 ["run", "a", "band", "slack"])

    rows = texts.join(members.select(F.col("a").alias("node")).distinct(), "node").select("node", "text")
    rows = scratch.cut(C.map_arrow(rows, read, "run long, a long, band int, slack int"), "fine")
    shared = scratch.cut(rows.groupBy("run").agg(F.count("*").alias("members")).where("members > 1"), "fine")
    place = F.row_number().over(Window.partitionBy("a", "band").orderBy(F.desc("members"), "run"))
    return scratch.cut(rows.join(shared, "run").withColumn("place", place).where("place >= slack").select("run", "a"), "fine")


def link_groups(runs: DataFrame, found: DataFrame, texts: DataFrame, seed: int = 0) -> DataFrame:
    """Stored links between members of one frequent signature that lie in different components so far."""
    scratch = C.Scratch(runs.sparkSession)
    members, _ = open_runs(runs, found, scratch)
    members, edges = open_runs(fine_runs(members, texts, seed, scratch), found, scratch)
    # signatures that share components are handled together, so a pair is compared once
    group = components(edges)
    sized = scratch.cut(members.join(group.select(F.col("node").alias("component"), F.col("component").alias("group")), "component"), "groups")
    blocks = scratch.cut(sized.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "groups")
    dealt = (sized.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                     F.col("a").alias("node"), "component")
             .join(texts, "node"))
    C.ship(runs.sparkSession)

    def link(part: pd.DataFrame) -> pd.DataFrame:
        return link_block(part, seed)

    out = C.cut_lineage(dealt.groupBy("group", "i", "j").applyInPandas(link, "a long, b long"), "links")
    scratch.drop()
    return out


def near_links(docs: DataFrame, sets: DataFrame, text_col: str = "text", seed: int = 0) -> DataFrame:
    """Links (a, b) between sets that, taken together, connect exactly the linked ones, in stored tables."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark)
    total = sets.agg(F.sum("n_shingles")).head()[0] or 0
    buckets = bucket_count(total, spark.sparkContext.defaultParallelism)
    packed = packed_signatures(docs, text_col, buckets, seed).repartitionById(buckets, F.col("bucket"))
    matched = scratch.cut(C.map_arrow(packed, match, "run long, a long, b long, band int, n long, slack int, members long"), "matched")

    mine = Window.partitionBy("a", "band")
    runs = (matched.where("run IS NOT NULL")
            .withColumn("place", F.row_number().over(mine.orderBy(F.desc("members"), "run")))
            .withColumn("frequent", F.count("*").over(mine))
            .where("place >= slack").select("run", "a", "n", "frequent"))
    runs = scratch.cut(runs, "runs")
    hubs = scratch.cut(runs.groupBy("run").agg(F.max(F.struct("frequent", "a", "n")).alias("top"))
                       .select("run", F.col("top.a").alias("hub"), F.col("top.n").alias("hub_n")), "hubs")
    star = runs.join(hubs, "run").where(f"a <> hub AND 100 * least(n, hub_n) >= {S.SIMILARITY} * greatest(n, hub_n)")
    # a linked pair shares many segments: those found as pairs, frequent ones, or empty ones (taken off already)
    often = scratch.cut(matched.where("run IS NOT NULL").groupBy("a", "band").agg(F.count("*").alias("often")), "often")
    paired = scratch.cut(matched.where("run IS NULL").groupBy("a", "b", "band", "slack").agg(F.sum("members").alias("shared")), "pairs")
    paired = (paired.join(often.withColumnRenamed("often", "often_a"), ["a", "band"], "left")
              .join(often.select(F.col("a").alias("b"), "band", F.col("often").alias("often_b")), ["b", "band"], "left")
              .where("shared + least(coalesce(often_a, 0), coalesce(often_b, 0)) >= slack"))
    pairs = (paired.select("a", "b")
             .unionByName(star.select(F.least("a", "hub").alias("a"), F.greatest("a", "hub").alias("b"))).distinct())
    pairs = scratch.cut(pairs, "pairs")

    wanted = (pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
              .unionByName(runs.select(F.col("a").alias("node"))).distinct())
    wanted = scratch.cut(sets.where("node IS NOT NULL").groupBy("node").agg(F.min("text_hash").alias("text_hash")).join(wanted, "node"), "wanted")
    texts = texts_of(docs, wanted, text_col, seed, scratch)

    links = C.cut_lineage(verify_pairs(pairs, texts, seed), "links")
    more = link_groups(runs, components(links), texts, seed)
    scratch.drop()
    return links.unionByName(more)


def hash_map(wanted: DataFrame) -> np.ndarray:
    """Bitmap of ``FILTER_BITS`` bits over the column text_hash, made in parts; its size does not depend on the data."""
    part = 1 << 16  # bytes

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            at = _place(batch.column(0).to_numpy(zero_copy_only=False))
            for k in np.unique(at >> 19).tolist():
                bits = at[at >> 19 == k] & ((1 << 19) - 1)
                np.bitwise_or.at(found.setdefault(k, np.zeros(part, np.uint8)), bits >> 3, (1 << (bits & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["part", "bits"])

    def either(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows["bits"]])
        return pd.DataFrame({"part": [key[0]], "bits": [bits.tobytes()]})

    out = np.zeros(FILTER_BITS // 8, np.uint8)
    marked = C.map_arrow(wanted.select("text_hash"), mark, "part int, bits binary")
    for r in marked.groupBy("part").applyInPandas(either, "part int, bits binary").collect():  # FILTER_BITS at most
        out[r.part * part:(r.part + 1) * part] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _place(hashes: np.ndarray) -> np.ndarray:
    return (C.mix(hashes.view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def texts_of(docs: DataFrame, wanted: DataFrame, text_col: str, seed: int, scratch: C.Scratch) -> DataFrame:
    """Stored (node, text) for each row of the stored table ``wanted`` (node, text_hash).

    A broadcast bitmap of fixed size keeps most other texts out of the join's shuffle; the join decides. With many
    more candidates than the bitmap has bits it lets everything through, and the texts are shuffled once.
    """
    bits = docs.sparkSession.sparkContext.broadcast(hash_map(wanted))

    def maybe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bits.value
        for batch in batches:
            at = _place(batch.column(0).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array((marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0))

    def same(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1), READ_BYTES):
                node = S.set_hashes(*S.shingle_sets(data, offs, seed))[0].view(np.int64)
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(node == part.column(0).to_numpy(zero_copy_only=False)))

    some = C.map_arrow(docs.select(C.text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text")), maybe, "text_hash long, text string")
    named = some.join(wanted, "text_hash").select("node", "text")
    out = scratch.cut(C.map_arrow(named, same, "node long, text string").dropDuplicates(["node"]), "texts")
    bits.unpersist()
    return out


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component (null for an empty set), component_id of every row."""
    seed = new_seed()
    sets = C.cut_lineage(doc_sets(docs, id_col, text_col, seed), "sets")
    joined = components(near_links(docs, sets, text_col, seed))
    named = (sets.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
             .join(joined, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component")))
    named = C.cut_lineage(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = C.cut_lineage(named.join(least, "component").select("node", "component", "component_id"), "named")
    return sets.join(named, "node", "left").select("doc_id", "text_hash", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: of every component the row with the smallest id (then text hash) stays."""
    found = C.cut_lineage(near_components(docs, id_col, text_col).where("component IS NOT NULL"), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = C.cut_lineage(found.groupBy("component").agg(F.count("*").alias("rows"), F.min(order).alias("first")).where("rows > 1")
                          .select("component", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash")), "first")
    decided = found.join(first, "component").select(
        "doc_id", "text_hash", (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))).alias("kept"))
    return C.without(docs, decided, id_col, text_col)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(C.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + 4), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS pos FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 80 * (p.n + q.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT DISTINCT x AS doc_id, x AS reached FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reached = e.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.least, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT doc_id, min(reached) AS least FROM r GROUP BY doc_id) c ON c.doc_id = w.doc_id
"""
