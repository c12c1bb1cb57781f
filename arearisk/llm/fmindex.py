"""Benchmark decontamination with an FM-index per training shard.

A phrase is a window of ``width`` consecutive words of a benchmark item (a shorter item is one phrase). Each task cuts
its documents into shards and indexes every shard: suffix array by prefix doubling, Burrows-Wheeler transform, a
wavelet matrix for rank queries, and suffix positions sampled at every eighth word. All phrases are searched
backwards side by side; each occurrence is located by walking to a sampled position, and the words it covers are
merged into removal spans.

Before indexing a shard is cut at words and at neighbouring word pairs that no phrase contains. No occurrence can
cross such a place, so this loses nothing and keeps the index small for clean text; text made of benchmark passages
is indexed whole.

The benchmark is the stated query set. Its distinct items are dealt by id and text to groups of about ``GROUP_BYTES`` bytes
of text (and one item more). A benchmark of one group is broadcast and searched in the pass that gives the result. A
larger one takes a pass for each group, of which one is alive at a time, that stores the places found; they are joined
to the documents by id and text. So memory grows neither with the corpus nor with the benchmark.

Defined results: a null or empty text has no words, a null item no phrases, a null item id the name "". Repeated rows
are each scanned; items are counted by id. An empty benchmark marks nothing. Words are found by a 64-bit hash with a
seed drawn for the run, and those that may be part of an occurrence are then compared byte by byte with the benchmark's.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WIDTH = 10
GROUP_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
SAMPLE = 8


@dataclass
class Words:
    low: np.ndarray  # lower-cased bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # each text's first word
    hashes: np.ndarray


def words(data: np.ndarray, offs: np.ndarray, seed: int = 0) -> Words:
    low = C.WORDS[data]
    starts, ends, first = C.word_bounds(low != 0, offs)
    return Words(low, starts, ends, first, C.word_hashes(low, starts, ends, seed))


# ---- phrases -----------------------------------------------------------------------------------------------------

@dataclass
class Phrases:
    seed: int
    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place + 1
    low: np.ndarray  # bytes of these words, and where each ends
    ends: np.ndarray
    pairs: np.ndarray  # sorted numbers of neighbouring words, first * (size + 1) + second
    by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # word numbers, first entry and entries of the items
    items: list[str]


def phrases(rows: list[tuple[str, str]], width: int = WIDTH, seed: int = 0) -> Phrases | None:
    """Distinct phrases of (item id, text) rows, by a hash that tells all their words apart."""
    col = pa.array([t for _, t in rows], pa.string())
    data, offs = C.text_buffers(col)
    while True:
        w = words(data, offs, seed)
        vocabulary, one, ids = np.unique(w.hashes, return_index=True, return_inverse=True)
        if C.same_spans(w.low, w.starts, w.ends, w.low, w.starts[one][ids], w.ends[one][ids]).all():
            break
        seed += 1
    names = sorted({i for i, _ in rows})
    number = {n: k for k, n in enumerate(names)}
    ids, first = ids + 1, w.first
    made: dict[int, dict[bytes, set]] = {}
    pairs = []
    for (name, _), a, b in zip(rows, first[:-1].tolist(), first[1:].tolist()):
        if a == b:
            continue
        seq = ids[a:b].astype(np.int64)
        pairs.append(seq[:-1] * (len(vocabulary) + 1) + seq[1:])
        k = min(width, b - a)
        for window in np.lib.stride_tricks.sliding_window_view(seq, k):
            made.setdefault(k, {}).setdefault(window.tobytes(), set()).add(number[name])
    if not made:
        return None
    by_length = []
    for k, found in sorted(made.items()):
        owners = [sorted(x) for x in found.values()]
        ends = np.cumsum([len(x) for x in owners])
        by_length.append((np.frombuffer(b"".join(found), np.int64).reshape(-1, k), np.append(0, ends),
                          np.array([i for x in owners for i in x], np.int64)))
    size = w.ends[one] - w.starts[one]
    ends = np.cumsum(size)
    low = w.low[np.repeat(w.starts[one] - (ends - size), size) + np.arange(int(ends[-1]))]
    return Phrases(seed, vocabulary, low, ends, np.unique(np.concatenate(pairs)), by_length, names)


def phrase_groups(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> tuple[int, Iterator[Phrases]]:
    """(number of groups, phrases of one group after the other; groups without any are left out)."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    seed = secrets.randbits(62)

    def made() -> Iterator[Phrases]:
        for g in range(groups):
            part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == g) if groups > 1 else rows
            found = phrases([(r.id, r.text) for r in part.collect()], width, seed)  # about GROUP_BYTES
            if found:
                yield found

    return groups, made()


# ---- index -------------------------------------------------------------------------------------------------------

def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes of distinct-ended sequences (every 0 counts as smaller than words and unlike other 0s)."""
    n = len(seq)
    ends = np.flatnonzero(seq == 0)
    rank = seq.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        ranked = rank[order]
        fresh = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        rank, step = key, 2 * step
        order = np.argsort(rank, kind="stable")


class FMIndex:
    """Counts and locates word sequences in a shard of pieces that each end with 0."""

    def __init__(self, seq: np.ndarray, size: int):
        self.levels = max(1, int(size).bit_length())
        order = suffix_array(seq)
        bwt = seq[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=size + 1))))  # suffixes below each word
        self.ones, self.zeros = [], []
        level = bwt
        for bit in reversed(range(self.levels)):  # wavelet matrix: stable partition by each bit
            one = (level >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(one))))
            self.zeros.append(len(level) - int(self.ones[-1][-1]))
            level = np.concatenate([level[one == 0], level[one == 1]])
        inside = np.arange(len(seq)) - np.concatenate(([0], np.flatnonzero(seq == 0) + 1))[np.concatenate(([0], np.cumsum(seq == 0)[:-1]))]
        self.sampled = np.where(inside[order] % SAMPLE == 0, order, -1)  # piece starts are always sampled
        self.bwt = bwt
        self.base = self._walk(np.arange(size + 1), np.zeros(size + 1, np.int64))

    def _walk(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, bit in enumerate(reversed(range(self.levels))):
            one = self.ones[k][at]
            at = np.where((word >> bit) & 1, self.zeros[k] + one, at - one)
        return at

    def step(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows below ``at`` whose preceding word is ``word``, counted from that word's first row."""
        return self.before[word] + self._walk(word, at) - self.base[word]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, last row) of the patterns that occur."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.bwt), np.int64)
        for k in reversed(range(patterns.shape[1])):
            word = patterns[which, k]
            low, high = self.step(word, low), self.step(word, high)
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows."""
        out, at, back = np.full(len(rows), -1, np.int64), rows.copy(), 0
        left = np.arange(len(rows))
        while len(left):
            hit = self.sampled[at] >= 0
            out[left[hit]] = self.sampled[at[hit]] + back
            left, at = left[~hit], at[~hit]
            at = self.step(self.bwt[at], at)
            back += 1
        return out


def joined(w: Words, ids: np.ndarray, what: Phrases) -> np.ndarray:
    """Which words stand behind a word that a phrase has before them."""
    out = np.zeros(len(ids), bool)
    if len(what.pairs) and len(ids) > 1:
        key = ids[:-1] * (len(what.vocabulary) + 1) + ids[1:]
        at = np.minimum(np.searchsorted(what.pairs, key), len(what.pairs) - 1)
        out[1:] = (what.pairs[at] == key) & (ids[:-1] > 0) & (ids[1:] > 0)
    opens = np.zeros(len(ids) + 1, bool)
    opens[w.first] = True  # documents
    return out & ~opens[:-1]


def candidates(w: Words, ids: np.ndarray, what: Phrases) -> np.ndarray:
    """Words in runs of joined words that are as long as the shortest phrase."""
    heads = (ids > 0) & ~joined(w, ids, what)
    run = np.cumsum(heads) - 1
    sizes = np.bincount(run[ids > 0], minlength=1)
    return np.flatnonzero((ids > 0) & (sizes[np.maximum(run, 0)] >= what.by_length[0][0].shape[1]))


def occurrences(w: Words, what: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, int, tuple]]:
    """(word positions, phrase numbers, phrase length, its table) for every phrase length with hits in a shard."""
    if not len(w.hashes):
        return
    place = np.minimum(np.searchsorted(what.vocabulary, w.hashes), len(what.vocabulary) - 1)
    ids = np.where(what.vocabulary[place] == w.hashes, place + 1, 0)
    kept = candidates(w, ids, what)
    wrong = kept[~C.same_spans(w.low, w.starts[kept], w.ends[kept], what.low, np.append(0, what.ends)[ids[kept] - 1], what.ends[ids[kept] - 1])]
    if len(wrong):
        ids[wrong] = 0
        kept = candidates(w, ids, what)
    if not len(kept):
        return
    apart = np.ones(len(kept), bool)  # from the word before
    apart[1:] = (kept[1:] != kept[:-1] + 1) | ~joined(w, ids, what)[kept[1:]]
    piece = np.cumsum(apart) - 1
    where = np.arange(len(kept)) + piece  # a 0 follows every piece
    seq = np.zeros(len(kept) + int(piece[-1]) + 1, np.int64)
    seq[where] = ids[kept]
    origin = np.full(len(seq), -1, np.int64)
    origin[where] = kept
    index = FMIndex(seq, len(what.vocabulary))
    for entry in what.by_length:
        which, low, high = index.search(entry[0])
        many = high - low
        if not many.sum():
            continue
        rows = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        yield origin[index.locate(rows)], np.repeat(which, many), entry[0].shape[1], entry


def scan(data: np.ndarray, offs: np.ndarray, what: Phrases | None) -> tuple:
    """(hit mask of the words, word starts, ends, first words, item names of each text) of a shard of texts."""
    w = words(data, offs, what.seed if what else 0)
    edge = np.zeros(len(w.hashes) + 1, np.int64)
    items: list[set] = [set() for _ in range(len(offs) - 1)]
    for at, phrase, length, (_, cut, owner) in occurrences(w, what) if what else ():
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        doc = np.searchsorted(w.first, at, side="right") - 1
        for d, p in set(zip(doc.tolist(), phrase.tolist())):
            items[d].update(what.items[i] for i in owner[cut[p]:cut[p + 1]].tolist())
    return np.cumsum(edge[:-1]) > 0, w.starts, w.ends, w.first, items


def known(data: np.ndarray, offs: np.ndarray, ranges: list, items: list) -> tuple:
    """As ``scan``, from the word ranges and item names that earlier passes stored for each text."""
    w = words(data, offs)
    edge = np.zeros(len(w.hashes) + 1, np.int64)
    for start, found in zip(w.first.tolist(), ranges):
        for a, b in found or ():
            edge[start + a] += 1
            edge[start + b] -= 1
    return np.cumsum(edge[:-1]) > 0, w.starts, w.ends, w.first, [set(x or ()) for x in items]


# ---- operators ---------------------------------------------------------------------------------------------------

MARKS = ("_hit_ranges", "_hit_items")


def marked(docs: DataFrame, groups: Iterator[Phrases], id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the columns ``MARKS``: word ranges and item names found by one pass a group, each stored."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    found = []
    for what in groups:
        held = spark.sparkContext.broadcast(what)

        def read(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, data, offs in C.blocks(batch.column(1), SHARD_BYTES):
                    hit, _, _, first, items = scan(data, offs, held.value)
                    some = [k for k, x in enumerate(items) if x]
                    part = batch.slice(lo, hi - lo).take(pa.array(some, pa.int64()))
                    ranges = [runs_of(hit[first[k]:first[k + 1]]) for k in some]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(ranges, pa.list_(pa.list_(pa.int64()))),
                                                      pa.array([sorted(items[k]) for k in some], pa.list_(pa.string()))], ["id", "text_hash", "ranges", "items"])

        found.append(scratch.cut(C.map_arrow(docs.select(id_col, text_col, C.text_hash(text_col)), read,
                                             f"id {kind}, text_hash long, ranges array<array<long>>, items array<string>"), "hits"))
        held.unpersist()
    if not found:
        empty = spark.createDataFrame([], f"id {kind}, text_hash long, ranges array<array<long>>, items array<string>")
        found.append(empty)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # rows of one id and text have the same places
    each = C.cut_lineage(every.groupBy("id", "text_hash").agg(F.flatten(F.collect_set("ranges")).alias(MARKS[0]), F.array_distinct(F.flatten(F.collect_set("items"))).alias(MARKS[1])), "hits")
    scratch.drop()
    same = docs[id_col].eqNullSafe(each["id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == each["text_hash"])
    return docs.join(each, same, "left").select(*[docs[c] for c in docs.columns], *MARKS)


def runs_of(hit: np.ndarray) -> list[list[int]]:
    """First word and end of every run of hit words."""
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return [[int(a), int(b)] for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))]


def prepared(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, width: int) -> tuple:
    """(``docs``, with ``MARKS`` where the benchmark has several groups; a function that gives what ``scan`` does for rows of a batch)."""
    groups, made = phrase_groups(benchmark, width=width)
    if groups > 1:
        rows = marked(docs, made, id_col, text_col)
        return rows, lambda batch, lo, hi, data, offs: known(data, offs, *(batch.column(c).slice(lo, hi - lo).to_pylist() for c in MARKS))
    held = docs.sparkSession.sparkContext.broadcast(next(made, None))
    return docs, lambda batch, lo, hi, data, offs: scan(data, offs, held.value)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the removal spans (bytes of the UTF-8 text)."""
    rows, found = prepared(docs.select(id_col, text_col), benchmark, id_col, text_col, width)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1), SHARD_BYTES):
                hit, starts, ends, first, items = found(batch, lo, hi, data, offs)
                n_hit = np.diff(np.concatenate(([0], np.cumsum(hit)))[first])
                spans = [merged(hit[a:b], starts[a:b] - o, ends[a:b] - o) if n else []
                         for a, b, o, n in zip(first[:-1].tolist(), first[1:].tolist(), offs.tolist(), n_hit.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first).astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                     pa.array([len(x) for x in items], pa.int64()),
                     pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
                     pa.array(n_hit > 0), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return C.map_arrow(rows, read, f"doc_id {kind}, n_words long, n_hit long, n_items long, "
                       "items_sha256 string, contaminated boolean, spans array<array<long>>")


def merged(hit: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Spans from the first to the last word of every run of hit words."""
    return [[int(starts[a]), int(ends[b - 1])] for a, b in runs_of(hit)]


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars",
                 width: int = WIDTH) -> DataFrame:
    """``docs`` with the same columns, every removal span cut out of the text (a line end stands in its place) and the
    size column counted anew for changed texts. Texts without a hit pass unchanged; a text of nothing else goes."""
    rows, found = prepared(docs, benchmark, id_col, text_col, width)
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None
    names = docs.columns

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(at), np.ones(batch.num_rows, bool)
            changed: dict[int, str] = {}
            for lo, hi, data, offs in C.blocks(texts, SHARD_BYTES):
                hit, starts, ends, first, _ = found(batch, lo, hi, data, offs)
                raw = data.tobytes()
                for k in np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(hit)))[first])).tolist():
                    a, b, cur, parts = first[k], first[k + 1], int(offs[k]), []
                    for x, y in merged(hit[a:b], starts[a:b], ends[a:b]):
                        parts.append(raw[cur:x])
                        cur = y
                    parts.append(raw[cur:int(offs[k + 1])])
                    changed[lo + k] = b"\n".join(parts).decode("utf-8", "replace")
                    keep[lo + k] = not hit[a:b].all()
            columns = list(batch.columns[:len(names)])
            if changed:
                new = texts.to_pylist()
                for k, t in changed.items():
                    new[k] = t
                columns[at] = pa.array(new, texts.type)
                if size_at is not None:
                    size = columns[size_at].to_pylist()
                    for k, t in changed.items():
                        size[k] = len(t)
                    columns[size_at] = pa.array(size, columns[size_at].type)
            out = pa.RecordBatch.from_arrays(columns, names=names)
            yield out if keep.all() else out.filter(pa.array(keep))

    return C.map_arrow(rows, clean, docs.schema)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark")).drop("spans")


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS nth,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(list_slice(words, pos, pos + least(10, len(words)) - 1), ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos FROM b WHERE len(words) > 0)),
s AS (SELECT DISTINCT size FROM p),
d AS (
  SELECT nth, pos, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS phrase
  FROM (SELECT nth, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM w, s)),
o AS (SELECT d.nth, d.pos, d.size, p.item_id FROM d JOIN p USING (size, phrase)),
h AS (SELECT nth, count(DISTINCT word) AS n_hit FROM (SELECT nth, unnest(range(pos, pos + size)) AS word FROM o) GROUP BY nth),
i AS (SELECT nth, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
      FROM (SELECT DISTINCT nth, item_id FROM o) GROUP BY nth)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (nth) LEFT JOIN i USING (nth)
"""
