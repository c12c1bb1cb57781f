"""Phrase collocation mining: contiguous phrases that come together far more often than their parts would by chance.

Counting is by HAT-tries over word numbers that a task gives out. The shallow levels, words and pairs of words, are
sorted arrays of node keys with counts, to which each block of text adds its own. Longer phrases are endings in hash
containers under the trie; a container that grows beyond ``BURST`` endings bursts into one for each next word. A trie beyond
``HELD`` nodes (``ENDINGS`` endings) sends out its largest subtrees whole, those under one first word, as sorted runs, until
half is left. A run is cut by prefix partition, the hash of a phrase's first ``PREFIX`` words, and its sorted phrases and
counts are compressed; a prefix partition merges the runs that reach it and keeps what is frequent. Their number grows
with the bytes of text.

Levels. All parts of a phrase are at least as frequent as the phrase, so words are counted first, then pairs of words
that are frequent, then phrases of three to five words of which all neighbouring pairs are frequent. What is frequent is
told to the next level by a bitmap of ``BITS_EACH`` bits an entry, at most ``MOST_BITS``; a wrong yes only counts a phrase
that is left out by its exact count afterwards, so a full bitmap costs work and changes nothing.

Scores. Every cut of every candidate meets the counts of its two sides in two joins that adaptive execution may split,
and is scored in decimals of 38 digits. A candidate is contained in a longer one of the same count exactly if it is the
longer one's first or last words at some step, and all steps between have that count too, so candidates look one word
further only.

What is held: a trie of ``HELD`` nodes or ``ENDINGS`` endings, ``WORDS`` word numbers, a block of text; a prefix
partition's phrases, from about ``PARTITION`` bytes of text. Nothing is held per language but its
total. A hot language, word or pair is spread over the phrases and counted inside tasks before.

Defined results: a null text has no words, a null language is 'und'. Repeated rows count again. A language without
candidates has no rows. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

LONGEST = 5
#: a candidate occurs so often
OFTEN = 100
#: phrases of a language in the result
BEST = 2000
#: words of the prefix by which runs meet, and bytes of text for each partition of it
PREFIX = 3
PARTITION = 8 << 20
#: endings of a container before it bursts
BURST = 4096
#: nodes of the shallow levels, and endings, in a task's trie
HELD = 1_500_000
ENDINGS = 300_000
#: word numbers in a task
WORDS = 600_000
#: words of a block
BLOCK = 400_000
BITS_EACH = 16
MOST_BITS = 1 << 27

#: A-Z in lower case, a tab as a space, and all that ends a piece as a colon
LETTERS = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 58 if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256))
RUNS = "partition int, lang string, phrases binary, counts binary"
COUNTS = "lang string, phrase binary, words int, n long"


class Trie:
    """Counts of word-number tuples: hash containers under a trie of word numbers."""

    def __init__(self, burst: int = BURST):
        self.root: dict = {}
        self.burst, self.size = burst, 0

    def add(self, phrase: tuple, n: int) -> None:
        at, k = self.root, 0
        while True:  # a node has int keys, a container has tuples
            word = phrase[k]
            below = at.get(word)
            k += 1
            if below is None:
                below = at[word] = {}
            if below.get(None) is None:  # a container
                end = phrase[k:]
                if end in below:
                    below[end] += n
                else:
                    below[end] = n
                    self.size += 1
                    if len(below) > self.burst:
                        at[word] = self.split(below)
                return
            if k == len(phrase):
                below[()] = below.get((), 0) + n
                self.size += below[()] == n
                return
            at = below

    def split(self, container: dict) -> dict:
        """The node for a full container: its own count, and a container for each next word."""
        node: dict = {None: True}
        for end, n in container.items():
            if end:
                node.setdefault(end[0], {})[end[1:]] = n
            else:
                node[()] = n
        return node

    def walk(self, at: dict, path: tuple) -> Iterator[tuple[tuple, int]]:
        for word, below in at.items():
            if word is None:
                continue
            if word == ():
                yield path, below
            elif isinstance(word, tuple):
                yield path + word, below
            else:
                yield from self.walk(below, (*path, word))

    def take(self, words: Iterable[int]) -> Iterator[tuple[tuple, int]]:
        """The phrases of whole subtrees, which go."""
        for word in words:
            for phrase, n in self.walk(self.root.pop(word), (word,)):
                self.size -= 1
                yield phrase, n

    def largest(self, leave: int) -> list[int]:
        """First words of the largest subtrees, so many that at most ``leave`` phrases stay."""
        size = sorted(((sum(1 for _ in self.walk(below, ())), word) for word, below in self.root.items()), reverse=True)
        out, left = [], self.size
        for n, word in size:
            if left <= leave:
                break
            out.append(word)
            left -= n
        return out


class Shallow:
    """Counts of the nodes of one of the first two levels: keys (word, or first << 32 | second) in a sorted array."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[tuple] = []
        self.waiting = 0

    @property
    def size(self) -> int:
        return len(self.keys) + self.waiting

    def add(self, keys: np.ndarray) -> None:
        each, n = np.unique(keys, return_counts=True)
        self.new.append((each, n))
        self.waiting += len(each)
        if self.waiting > max(BLOCK, len(self.keys) // 2):
            self.settle()

    def settle(self) -> None:
        self.keys, self.counts = C.summed(*(np.concatenate(x) for x in zip((self.keys, self.counts), *self.new)))
        self.new, self.waiting = [], 0

    def take(self, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the largest subtrees of a first word, so many that at most ``leave`` nodes stay; they go."""
        self.settle()
        first = self.keys >> 32
        word, back, size = np.unique(first, return_inverse=True, return_counts=True)
        order = np.argsort(-size, kind="stable")
        before = np.cumsum(size[order]) - size[order]
        goes = np.zeros(len(word), bool)
        goes[order[len(first) - before > leave]] = True
        goes = goes[back]
        out = self.keys[goes], self.counts[goes]
        self.keys, self.counts = self.keys[~goes], self.counts[~goes]
        return out


class Words(dict):
    """Numbers of words from 1, and 0 for those that are not wanted."""

    def __init__(self, lang: str, wanted: np.ndarray | None):
        self.names, self.hashes = [b""], [0]
        self.seed, self.wanted = xxhash.xxh64_intdigest(lang.encode(), 42), wanted
        self[b":"] = 0

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)  # Spark's xxhash64(lang, word)
        k = 0 if self.wanted is None else h & (8 * len(self.wanted) - 1)
        n = 0
        if self.wanted is None or self.wanted[k >> 3] >> (k & 7) & 1:
            n = len(self.names)
            self.names.append(word)
            self.hashes.append(h)
        self[word] = n
        return n

    def shrink(self) -> None:
        """Forget which words are not wanted."""
        for word in [w for w, n in self.items() if not n and w != b":"]:
            del self[word]


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first ^ (second << np.uint64(17) | second >> np.uint64(47))


#: SQL: the hash of a word, and of a pair of words, in column phrase
HASH = {1: "xxhash64(lang, phrase)",
        2: "xxhash64(lang, split(phrase, ' ')[0]) ^ (shiftleft(xxhash64(lang, split(phrase, ' ')[1]), 17) | shiftrightunsigned(xxhash64(lang, split(phrase, ' ')[1]), 47))"}


def bitmap(frequent: DataFrame, words: int) -> np.ndarray:
    """Marks of (lang, phrase) rows of one or two words; its size is set by their number and bounded."""
    rows = frequent.count()
    bits = min(MOST_BITS, max(1 << 19, 1 << int(max(rows, 1) * BITS_EACH - 1).bit_length()))

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            for k in np.unique(at >> 19).tolist():
                bit = at[at >> 19 == k] & ((1 << 19) - 1)
                np.bitwise_or.at(found.setdefault(k, np.zeros(1 << 16, np.uint8)), bit >> 3, (1 << (bit & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["part", "bits"])

    def either(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "bits": [np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in parts["bits"]]).tobytes()]})

    place = F.expr(f"({HASH[words]}) & {bits - 1}L")
    out = np.zeros(bits // 8, np.uint8)
    marked = C.map_arrow(frequent.withColumn("phrase", F.col("phrase").cast("string")).select(place), mark, "part long, bits binary").groupBy("part").applyInPandas(either, "part long, bits binary")
    for r in marked.collect():  # the bitmap, MOST_BITS at most
        out[r.part << 16:(r.part + 1) << 16] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def runs(docs: DataFrame, longest: int, partitions: int, seen=None, held: int = HELD, endings: int = ENDINGS, burst: int = BURST, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """Sorted runs of the words (``longest`` 1), pairs (2) or longer phrases, as each task sends them out. ``seen``:
    broadcast bitmap of the frequent words (for pairs) or pairs (for longer phrases)."""

    def run_of(lang: str, partition: np.ndarray, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A sorted run, cut and compressed by partition; every phrase ends with a line end, which is in no word."""
        packer = zstandard.ZstdCompressor()
        offs = np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset:phrases.offset + len(phrases) + 1]
        data = memoryview(phrases.buffers()[2])
        cuts = np.append(np.flatnonzero(np.diff(partition, prepend=-1)), len(partition)).tolist()
        for k in range(0, len(cuts) - 1, 500):
            part = list(zip(cuts[k:k + 500], cuts[k + 1:k + 501]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(partition[a]) for a, _ in part], pa.int32()), pa.array([lang] * len(part), pa.string()),
                 pa.array([packer.compress(data[offs[a]:offs[b]]) for a, b in part], pa.binary()),
                 pa.array([packer.compress(counts[a:b].astype("<i8").tobytes()) for a, b in part], pa.binary())], ["partition", "lang", "phrases", "counts"])

    def send_nodes(lang: str, number: Words, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Nodes of a shallow level."""
        if not len(keys):
            return
        h, first, last = np.array(number.hashes, np.uint64), keys >> 32, keys & 0xFFFFFFFF
        rank = np.empty(len(number.names), np.int64)
        rank[np.array(pc.sort_indices(pa.array(number.names, pa.binary())))] = np.arange(len(rank))
        place = (C.mix(pair_hash(h[first], h[last]) if longest == 2 else h[last]) % np.uint64(partitions)).astype(np.int64)
        order = np.lexsort((rank[last], rank[first], place))
        phrases = pa.array([n + b"\n" for n in number.names], pa.binary()).take(pa.array(last[order]))
        if longest == 2:
            phrases = pc.binary_join_element_wise(pa.array(number.names, pa.binary()).take(pa.array(first[order])), phrases, b" ")
        yield from run_of(lang, place[order], phrases, counts[order])

    def send_endings(lang: str, number: Words, found: Iterable[tuple[tuple, int]]) -> Iterator[pa.RecordBatch]:
        found = list(found)
        if not found:
            return
        h, names = np.array(number.hashes, np.uint64), number.names
        prefix = np.array([p[:PREFIX] for p, _ in found], np.int64)
        place = np.zeros(len(found), np.uint64)
        for k in range(PREFIX):
            place = C.mix(place ^ h[prefix[:, k]])
        rows = pa.table({"place": (place % np.uint64(partitions)).astype(np.int64), "n": np.array([n for _, n in found], np.int64),
                         "phrase": pa.array([b" ".join([names[w] for w in p]) + b"\n" for p, _ in found], pa.binary())})
        rows = rows.sort_by([("place", "ascending"), ("phrase", "ascending")]).combine_chunks()
        yield from run_of(lang, rows["place"].to_numpy(), rows["phrase"].chunk(0), rows["n"].to_numpy())

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if seen is None else seen.value
        numbers: dict[str, Words] = {}
        tries: dict[str, Shallow | Trie] = {}
        flats: dict[str, list[int]] = {}

        def count(lang: str, ids: np.ndarray) -> None:
            if lang not in tries:
                tries[lang] = Trie(burst) if longest > 2 else Shallow()
            trie = tries[lang]
            if longest == 1:
                trie.add(ids[ids > 0])
                return
            both = (ids[:-1] > 0) & (ids[1:] > 0)
            if longest == 2:
                trie.add((ids[:-1] << 32 | ids[1:])[both])
                return
            h = np.array(numbers[lang].hashes, np.uint64)[ids]
            at = (pair_hash(h[:-1], h[1:]) & np.uint64(8 * len(marks) - 1)).astype(np.int64)
            good = both & (marks[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0)
            for size in range(3, longest + 1):
                if len(ids) < size:
                    break
                at = np.flatnonzero(np.logical_and.reduce([good[k:len(good) - size + 2 + k] for k in range(size - 1)]))
                for phrase, n in Counter(zip(*(ids[at + k].tolist() for k in range(size)))).items():
                    trie.add(phrase, n)

        def some(lang: str, leave: int) -> Iterator[pa.RecordBatch]:
            trie = tries[lang]
            if longest > 2:
                yield from send_endings(lang, numbers[lang], trie.take(trie.largest(leave)))
            else:
                yield from send_nodes(lang, numbers[lang], *trie.take(leave))

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            for lang, flat in flats.items():
                if len(flat) > 1:
                    count(lang, np.array(flat, np.int64))
            flats.clear()
            most = endings if longest > 2 else held
            while not last and sum(t.size for t in tries.values()) > most:
                lang = max(tries, key=lambda x: tries[x].size)
                yield from some(lang, tries[lang].size // 2)
            if sum(map(len, numbers.values())) > words:
                for number in numbers.values():
                    number.shrink()
            if last or sum(map(len, numbers.values())) > words:
                for lang in tries:
                    yield from some(lang, 0)
                tries.clear()
                numbers.clear()

        waiting = 0
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                if lang not in numbers:
                    numbers[lang] = Words(lang, marks if longest == 2 else None)
                number = numbers[lang]
                flat = flats.setdefault(lang, [])
                before = len(flat)
                flat.append(0)
                flat += [number[w] for w in text.translate(LETTERS).replace(b":", b" : ").split(b" ") if w]
                waiting += len(flat) - before
                if waiting > block:
                    yield from flush(False)
                    waiting = 0
        yield from flush(True)

    rows = docs.select(F.coalesce("text", F.lit("")).cast("binary"), F.coalesce("lang", F.lit("und")))
    return C.map_arrow(rows, read, RUNS)


def merge(found: DataFrame, partitions: int, often: int, totals: bool = False) -> DataFrame:
    """lang, phrase, words, n of the phrases that occur ``often``: the runs merged per prefix partition. ``totals``: also a row
    without a phrase for each language, the sum of all counts in the partition."""

    def summed(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
        rows = pa.table({"phrase": pa.chunked_array([p for p, _ in parts]), "n": np.concatenate([n for _, n in parts])})
        rows = rows.group_by("phrase", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
        return (rows["phrase"].chunk(0) if len(rows) else pa.array([], pa.binary())), rows["n_sum"].to_numpy()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        held: dict[str, list] = {}
        waiting = {}
        total: dict[str, int] = {}
        for batch in batches:
            for lang, phrases, counts in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrases", "counts"))):
                n = np.frombuffer(unpacker.decompress(counts), "<i8")
                held.setdefault(lang, []).append((pa.array(unpacker.decompress(phrases)[:-1].split(b"\n"), pa.binary()), n))
                total[lang] = total.get(lang, 0) + int(n.sum())
                waiting[lang] = waiting.get(lang, 0) + len(n)
                if waiting[lang] > 500_000 and waiting[lang] > 2 * len(held[lang][0][1]):
                    held[lang], waiting[lang] = [summed(held[lang])], 0
        for lang, parts in held.items():
            phrase, n = summed(parts)
            kept = np.flatnonzero(n >= often)
            phrase, n = phrase.take(pa.array(kept)), n[kept]
            words = pc.add(pc.count_substring(phrase, " "), 1).cast(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), phrase, words, pa.array(n)], ["lang", "phrase", "words", "n"])
            if totals:
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.binary()), pa.array([0], pa.int32()), pa.array([total[lang]])],
                                                 ["lang", "phrase", "words", "n"])

    return C.map_arrow(found.repartitionById(partitions, F.col("partition")), read, COUNTS)


def phrase_counts(docs: DataFrame, scratch: C.Scratch, often: int = OFTEN, **limits: int) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, phrase, words, n) of the phrases of one to five words that occur ``often``, and (lang, n) of all words."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION))
    single = scratch.cut(merge(runs(docs, 1, partitions, None, **limits), partitions, often, totals=True), "words")
    totals = scratch.cut(single.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    level = single.where("phrase IS NOT NULL")
    levels = [level]
    for words, longest in ((1, 2), (2, LONGEST)):
        seen = spark.sparkContext.broadcast(bitmap(level, words))
        level = scratch.cut(merge(runs(docs, longest, partitions, seen, **limits), partitions, often), "frequent")
        seen.unpersist()
        levels.append(level)
    return levels[0].unionByName(levels[1]).unionByName(levels[2]), totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", often: int = OFTEN, best: int = BEST,
                 **limits: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``best`` phrases of two to five words.
    ``limits``: what tasks hold, as for ``runs``."""
    texts = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    scratch = C.Scratch(docs.sparkSession)
    frequent, totals = phrase_counts(texts, scratch, often, **limits)
    frequent = frequent.withColumn("phrase", F.col("phrase").cast("string"))
    longer = frequent.where("words > 2").withColumn("word", F.split("phrase", " "))
    parts = F.explode(F.array(F.array_join(F.slice("word", 1, F.size("word") - 1), " "), F.array_join(F.slice("word", F.lit(2), F.size("word") - 1), " ")))
    inside = longer.select("lang", parts.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    candidates = scratch.cut(frequent.where("words > 1").join(inside, ["lang", "phrase"], "left")
                               .where("around IS NULL OR 100 * around < 100 * n").select("lang", "phrase", F.col("n").alias("a")), "candidates")

    cuts = (candidates.withColumn("word", F.split("phrase", " "))
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("word") - 1)))
            .select("lang", "phrase", "a", "k", F.array_join(F.slice("word", F.lit(1), F.col("k")), " ").alias("left"),
                    F.array_join(F.slice("word", F.col("k") + 1, F.size("word") - F.col("k")), " ").alias("right")))
    scored = (cuts.join(frequent.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
              .join(frequent.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
              .join(totals, "lang")
              .withColumn("score", F.expr("(1000 * cast(a AS decimal(15, 0)) * cast(n AS decimal(17, 0))) div (cast(l AS decimal(18, 0)) * cast(r AS decimal(18, 0)))")))
    least = C.cut_lineage(scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")), "scores")
    scratch.drop()
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (least.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
            .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(C.table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
             string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
s AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM g, range(1, 6) AS t(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM s GROUP BY ALL),
t AS (SELECT lang, sum(n)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 100),
i AS (SELECT c.lang, array_to_string(list_slice(c.w, x, x + y - 1), ' ') AS phrase, max(c.a) AS around
      FROM c, range(1, 5) AS u(x), range(2, 5) AS v(y) WHERE y < c.k AND x + y - 1 <= c.k GROUP BY ALL),
e AS (SELECT c.* FROM c LEFT JOIN i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.around IS NULL OR 100 * i.around < 100 * c.a),
cuts AS (SELECT e.lang, e.phrase, e.a, j, array_to_string(list_slice(e.w, 1, j), ' ') AS x, array_to_string(list_slice(e.w, j + 1, e.k), ' ') AS y
         FROM e, range(1, 5) AS o(j) WHERE j < e.k),
z AS (SELECT cuts.lang, cuts.phrase, cuts.a, l.n AS l, r.n AS r, t.n AS n, j, (1000::HUGEINT * a * t.n) // (l.n::HUGEINT * r.n) AS score
      FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y JOIN t ON t.lang = cuts.lang),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM z),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM o WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM q WHERE rank <= 2000
"""
