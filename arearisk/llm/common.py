"""Shared helpers: reading tables, the shared folder, and numpy views of Arrow text columns.

Python tasks read text through Arrow buffers: a block of texts is one ``uint8`` array plus offsets, so words,
hashes and chunks are found with array operations and no per-word Python objects.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arearisk.session import cut_lineage, fresh_path  # noqa: F401  (re-exported for the operators)

BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: rows of an Arrow batch, where the session has Spark's own default: texts are long, and a batch is held several times
BATCH_ROWS = 1000
#: bytes of an Arrow batch, where the session states none: rows may be long
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where their path does not hold it (as ``--py-files`` does), and keep
    Arrow batches of long texts small."""
    import os
    import tempfile
    import zipfile
    from pathlib import Path

    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    home = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    if str(home) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_arearisk_shipped", False):
        return
    to = Path(tempfile.mkdtemp(prefix="arearisk-")) / "arearisk.zip"  # read by the driver, which sends it to the executors
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted((home / "arearisk").rglob("*.py")):
            z.write(p, p.relative_to(home))
    sc.addPyFile(str(to))
    sc._arearisk_shipped = True


class Scratch:
    """Stored tables of an operator's own, deleted when its result does not read them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        df.write.parquet(path)
        out = self.spark.read.parquet(path)
        self.paths[path] = out
        return out

    def drop(self, *keep: DataFrame) -> None:
        """Delete the tables but those in ``keep`` (frames that ``cut`` returned)."""
        for path, df in list(self.paths.items()):
            if not any(df is k for k in keep):
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
                del self.paths[path]


def give_back() -> None:
    """Return the memory that a worker has freed to the system: workers are kept for later tasks, beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def id_hash(col: str = "doc_id"):
    """crc32 of the id written as text (the fold rule of the contracts); null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def text_hash(col: str):
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def without(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs``, all columns, less the dropped rows of groups. ``decided``: doc_id, text_hash, kept of every row that is
    in a group. Of rows with equal id and text of which one is kept, one stays."""
    verdict = cut_lineage(decided.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), F.count("*").alias("copies"))
                          .withColumnRenamed("doc_id", "_id"), "verdict")
    same = docs[id_col].eqNullSafe(verdict["_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == verdict["text_hash"])
    names = [docs[c] for c in docs.columns]
    repeated = verdict.where("kept AND copies > 1")
    kept = docs.join(verdict.where("NOT kept OR copies > 1"), same, "left_anti").select(*names)
    if repeated.isEmpty():
        return kept
    return kept.unionByName(docs.join(repeated, same, "left_semi").select(*names).dropDuplicates([id_col, text_col]))


def first_of_keys(rows: DataFrame, keys: list[str], read, schema: str) -> DataFrame:
    """``read`` of one row for each value of ``keys``, the one whose text has the smallest hash, however many rows have it.
    ``rows``: the keys and text. ``read`` makes a batch with a row for each of its rows and the columns of ``schema``.
    A task passes a row on only if its hash is below that of the rows with its key so far, so copies meet nowhere."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, int] = {}
        for batch in batches:
            key = list(zip(*(batch.column(k).to_pylist() for k in range(len(keys)))))
            at: dict[tuple, int] = {}
            for i, (k, h) in enumerate(zip(key, batch.column(len(keys) + 1).to_pylist())):
                if k not in known or h < known[k]:
                    known[k] = h
                    at[k] = i
            few = batch.take(pa.array(sorted(at.values()), pa.int64()))
            hashes, done = few.column(len(keys) + 1), 0
            for out in read([few]) if len(few) else ():
                yield pa.RecordBatch.from_arrays([*out.columns, hashes.slice(done, len(out))], [*out.schema.names, "_hash"])
                done += len(out)

    found = map_arrow(rows.select(*keys, "text", F.xxhash64("text").alias("_hash")), least, schema + ", _hash long")
    rest = [c for c in found.columns if c not in (*keys, "_hash")]
    return found.groupBy(*keys).agg(F.min_by(F.struct(*rest), "_hash").alias("_row")).select(*keys, "_row.*")


# ---- text blocks -----------------------------------------------------------------------------------------

def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = int(offs[0]) if len(offs) else 0
    hi = int(offs[-1]) if len(offs) else 0
    return data[lo:hi], offs - lo


def blocks(col: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into row ranges of about ``max_bytes``; a longer text is a block of its own."""
    data, offs = text_buffers(col)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


# ---- words and hashes --------------------------------------------------------------------------------------

def word_bounds(kept: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes inside each text, and each text's first word index."""
    n = len(kept)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = kept[:-1]
    before[edge[:-1]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = kept[1:]
    after[edge[1:]] = False
    starts = np.flatnonzero(kept & ~before)
    ends = np.flatnonzero(kept & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


_POWERS: list[np.ndarray] = []
#: positions whose powers a worker keeps
KEPT_POWERS = 1 << 20


def _powers(length: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for at least ``length`` positions. Those of an ordinary block
    are kept for the next, those of a longer text are not."""
    if length > KEPT_POWERS:
        return [_power_table(base, length) for base in (_BASE, _INVERSE)]
    if not _POWERS:
        _POWERS[:] = [_power_table(base, KEPT_POWERS) for base in (_BASE, _INVERSE)]
    return _POWERS


def _power_table(base: int, length: int) -> np.ndarray:
    p = np.ones(length, np.uint64)
    k, step = 1, base
    while k < length:  # p[k:2k] = p[:k] * base^k
        p[k:2 * k] = p[:min(k, length - k)] * np.uint64(step)
        k, step = 2 * k, step * step % (1 << 64)
    return p


def symbol_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def span_hashes(data: np.ndarray, starts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """64-bit hash of each span [start, next start); bytes whose symbol is 0 do not count."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    first = int(starts[0])
    sums = np.add.reduceat(symbols[data[first:]] * up[first:len(data)], starts - first)
    return mix(sums * down[starts])


_LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: words above this many bytes are hashed one by one
LONG_WORD = 64


def _lanes(low: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers."""
    return np.ndarray(len(low) + 1, "<u8", np.concatenate([low, np.zeros(8, np.uint8)]), strides=(1,))


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes, eight at a time; every byte value counts. Words of up to eight bytes and one
    length differ in it surely, others but for an accident: with a seed drawn for the run no text can provoke one."""
    size = ends - starts
    if not len(size):
        return np.zeros(0, np.uint64)
    lanes = _lanes(low)
    out = mix(size.astype(np.uint64) * np.uint64(_BASE) + np.uint64(seed))
    out = mix(out ^ (lanes[starts] & _LANE[np.minimum(size, 8)]))
    for k in range(8, LONG_WORD, 8):
        at = np.flatnonzero((size > k) & (size <= LONG_WORD))
        if not len(at):
            break
        out[at] = mix(out[at] ^ (lanes[starts[at] + k] & _LANE[np.minimum(size[at] - k, 8)]))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(low[starts[i]:ends[i]].tobytes(), seed)
    return out


def same_spans(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each span of ``low`` has the bytes of the span of ``other`` at its side."""
    size = ends - starts
    same = size == other_ends - other_starts
    mine, theirs = _lanes(low), _lanes(other)
    for k in range(0, LONG_WORD, 8):
        at = np.flatnonzero(same & (size > k))
        if not len(at):
            break
        mask = _LANE[np.minimum(size[at] - k, 8)]
        same[at] = (mine[starts[at] + k] & mask) == (theirs[other_starts[at] + k] & mask)
    for x in np.flatnonzero(same & (size > LONG_WORD)).tolist():
        same[x] = low[starts[x]:ends[x]].tobytes() == other[other_starts[x]:other_ends[x]].tobytes()
    return same


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(values, first)


def code_points(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of code points of each text."""
    seen = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return np.diff(seen[offs])


def lower_az(keep) -> np.ndarray:
    """Byte table: A-Z to a-z, other kept bytes as they are, dropped bytes 0."""
    t = np.zeros(256, np.uint8)
    for b in range(256):
        if keep(b):
            t[b] = b + 32 if 65 <= b <= 90 else b
    return t


#: A-Z to a-z, all other bytes as they are
LOWER = lower_az(lambda b: True)
#: which bytes are in words of the near-duplicate contract: all but space, tab, line ends and form feeds
SPACED = np.array([b != 0x20 and not 9 <= b <= 13 for b in range(256)])
#: words of the decontamination contract: digits, letters and all non-ASCII characters
WORDS = lower_az(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
