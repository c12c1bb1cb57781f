"""Source divergence audit: how far the word use of each source stands from the other sources of its language.

In-mapper stripes. A task folds whole documents into hash stripes, one a (lang, term): the document frequency and the
occurrences per source. A hash table numbers the terms; the stripes are cells (number, source) of one sorted array, to
which each block of documents adds its own. A task sends its stripes out whenever there are ``CELLS`` cells or ``HELD``
terms, and at the end; a shuffle by (lang, term) merges them. Merged stripes of the kept terms are stored; the totals come from them, and each stripe
then gives its share of every divergence directly, all sources at once, as one row of a term by source matrix.

Arithmetic is exact: 1 + floor(10^9 (count + 1) / (N + V)) by long division in int64 for N + V below 9 * 10^15.

What is held: ``CELLS`` cells, ``HELD`` terms and a block of words in the folding task, a batch of stripes in the merging
one, and a matrix of ``MATRIX`` counts. The list of a language's sources and totals goes with its stripes by a join; the result has a row
for every pair of its sources anyway. A hot language or source is spread over the terms; a hot term has one stripe a
spill.

Defined results: null text, lang and source are ''. A group without terms has pairs only, of value 0 if the language
keeps no term. Repeated rows and ids are documents of their own. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: a kept term is in so many documents of its language
DOCUMENTS = 3
#: ranks of a group's terms
TERMS = 200
SCALE = 1_000_000_000
#: cells and terms held by a folding task before it sends its stripes out, and words of a block
CELLS = 1_500_000
HELD = 400_000
BLOCK = 300_000
#: counts in a matrix of terms by sources
MATRIX = 1 << 19

#: letters of ASCII in lower case and all bytes of other characters; the rest is space
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

STRIPE = "lang string, term binary, documents long, sources array<string>, counts array<long>"


NAMES = ["lang", "term", "documents", "sources", "counts"]


class Numbers(dict):
    """Numbers of the terms met, from 0."""

    def __init__(self):
        self.names: list[bytes] = []

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self.names)
        self.names.append(term)
        return n


class Stripes:
    """The stripes of one language in a task. Cell (number << 24) counts documents, (number << 24 | source + 1) occurrences."""

    def __init__(self):
        self.number, self.source = Numbers(), {}
        self.cells = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words: list[int] = []
        self.sizes: list[int] = []
        self.of: list[int] = []

    def read(self, text: bytes, source: str) -> int:
        number = self.number
        ids = [number[w] for w in text.translate(LETTERS).split()]
        self.words += ids
        self.sizes.append(len(ids))
        self.of.append(self.source.setdefault(source, len(self.source)))
        return len(ids)

    def add(self) -> None:
        """The cells of the documents read since."""
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        each, n = np.unique(doc << 32 | np.array(self.words, np.int64), return_counts=True)
        term, source = each & 0xFFFFFFFF, np.array(self.of, np.int64)[each >> 32]
        one = C.summed(np.concatenate([term << 24, term << 24 | source + 1]), np.concatenate([np.ones(len(term), np.int64), n]))
        self.cells = C.summed(*(np.concatenate(x) for x in zip(self.cells, one)))
        self.words, self.sizes, self.of = [], [], []

    def send(self, lang: str, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        """All stripes, and one without a term that holds the sources."""
        sources = pa.array(self.source, pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.binary()), pa.array([0]), pa.array([list(self.source)], pa.list_(pa.string())),
                                          pa.array([[0] * len(self.source)], pa.list_(pa.int64()))], NAMES)
        keys, values = self.cells
        heads = np.flatnonzero(keys & 0xFFFFFF == 0)  # one a term, in order of the numbers
        ends = np.append(heads[1:], len(keys))
        for k in range(0, len(heads), rows):
            head, last = heads[k:k + rows], int(ends[min(k + rows, len(heads)) - 1])
            inside = np.ones(last - int(head[0]), bool)
            inside[head - head[0]] = False
            at = np.flatnonzero(inside) + head[0]
            bounds = pa.array(np.append(0, np.cumsum(ends[k:k + rows] - head - 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(head), pa.string()), pa.array(self.number.names[k:k + len(head)], pa.binary()), pa.array(values[head]),
                 pa.ListArray.from_arrays(bounds, sources.take(pa.array((keys[at] & 0xFFFFFF) - 1))),
                 pa.ListArray.from_arrays(bounds, pa.array(values[at]))], NAMES)


def fold(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cells: int = CELLS, held: int = HELD,
         block: int = BLOCK) -> DataFrame:
    """Stripes of each task, and for each language one without a term that holds the sources that occur."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, Stripes] = {}
        waiting = 0
        for batch in batches:
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns)):
                if lang not in of:
                    of[lang] = Stripes()
                waiting += 1 + of[lang].read(text, source)
                if waiting > block:
                    for stripes in of.values():
                        stripes.add()
                    waiting = 0
                    if sum(len(s.cells[0]) for s in of.values()) > cells or sum(len(s.number) for s in of.values()) > held:
                        for name, stripes in of.items():
                            yield from stripes.send(name)
                        of.clear()
        for name, stripes in of.items():
            stripes.add()
            yield from stripes.send(name)

    words = docs.select(F.coalesce(text_col, F.lit("")).cast("binary"), F.coalesce(lang_col, F.lit("")), F.coalesce(source_col, F.lit("")))
    return C.map_arrow(words, read, STRIPE)


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One stripe for each run of stripes with the same language and term."""
    n = batch.num_rows
    lang, term = batch.column(0), batch.column(1)
    same = pc.and_(pc.equal(lang.slice(1), lang.slice(0, n - 1)), pc.or_(
        pc.fill_null(pc.equal(term.slice(1), term.slice(0, n - 1)), False), pc.and_(pc.is_null(term.slice(1)), pc.is_null(term.slice(0, n - 1)))))
    first = np.flatnonzero(np.append(True, ~same.to_numpy(zero_copy_only=False)))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    row = np.repeat(group, pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False))
    source = pc.dictionary_encode(batch.column(3).flatten())
    keys, values = C.summed(row << 32 | source.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                          batch.column(4).flatten().to_numpy(zero_copy_only=False))
    bounds = pa.array(np.searchsorted(keys >> 32, np.arange(len(first) + 1)), pa.int32())
    at = pa.array(first)
    return pa.RecordBatch.from_arrays(
        [lang.take(at), term.take(at), pa.array(np.add.reduceat(batch.column(2).to_numpy(zero_copy_only=False), first)),
         pa.ListArray.from_arrays(bounds, source.dictionary.take(pa.array(keys & 0xFFFFFFFF))), pa.ListArray.from_arrays(bounds, pa.array(values))], NAMES)


def merge(stripes: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """One stripe a (lang, term) that is in enough documents, and each language's stripe without a term."""

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pc.or_(pc.is_null(batch.column(1)), pc.greater_equal(batch.column(2), documents)))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the stripe that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays(batch.columns, NAMES)
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            batch = _merged(batch)
            last = batch.slice(batch.num_rows - 1)
            yield kept(batch.slice(0, batch.num_rows - 1))
        if last is not None:
            yield kept(last)

    return C.map_arrow(stripes.repartition("lang", "term").sortWithinPartitions("lang", "term"), read, STRIPE)


def scaled(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """floor(10^9 * count / total) for count <= total < 9 * 10^15."""
    out, rest = np.zeros_like(count), count
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out


def _rows(lang: str, source: list[str], part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(source, pa.string()), pa.array([part] * n, pa.string()),
                                       item, pa.array(value, pa.int64())], ["lang", "source", "part", "item", "value"])


def shares(stripes: DataFrame, totals: DataFrame, terms: int = TERMS) -> DataFrame:
    """lang, source, part, item, value: each block of stripes adds its sums to the pairs, and gives the terms of each group
    that may be among its first ``terms``."""

    def block(lang: str, names: list[str], group: np.ndarray, kept: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = part.column("sources")
        count = np.zeros((part.num_rows, len(names)), np.int64)
        row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
        column = pc.index_in(lists.flatten(), value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False)
        count[row, column] = part.column("counts").flatten().to_numpy(zero_copy_only=False)
        p = 1 + scaled(count + 1, group + kept)
        q = 1 + scaled(count.sum(axis=1) + 1, int(group.sum()) + kept)
        items = pa.array(names, pa.string())
        for k, name in enumerate(names):
            d = p[:, [k]] - p
            value = (d * d // p).sum(axis=0)
            other = np.arange(len(names)) != k
            yield _rows(lang, [name] * (len(names) - 1), "pair", items.filter(pa.array(other)), value[other])
            at = np.flatnonzero((count[:, k] > 0) & (p[:, k] > q))
            value = (p[at, k] - q[at]) ** 2 // q[at]
            if len(at) > terms:  # ties with the last are decided later
                near = value >= np.partition(value, len(at) - terms)[len(at) - terms]
                at, value = at[near], value[near]
            yield _rows(lang, [name] * len(at), "term", part.column("term").take(pa.array(at)), value)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch.column("lang").unique():
                part = batch.filter(pc.equal(batch.column("lang"), lang))
                groups = part.column("groups")[0].as_py()
                names = [g["source"] for g in groups]
                group = np.array([g["n"] for g in groups], np.int64)
                bare = part.filter(pc.is_null(part.column("term")))
                if len(bare):  # every pair of sources has a row
                    for name in names:
                        rest = [s for s in names if s != name]
                        yield _rows(lang.as_py(), [name] * len(rest), "pair", pa.array(rest, pa.string()), np.zeros(len(rest), np.int64))
                part = part.filter(pc.is_valid(part.column("term")))
                step = max(1, MATRIX // len(names))
                for k in range(0, len(part), step):
                    yield from block(lang.as_py(), names, group, part.column("terms")[0].as_py(), part.slice(k, step))

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in read(batches):
            yield b.set_column(3, "item", b.column(3).cast(pa.binary()))

    rows = stripes.join(totals, "lang").select("lang", "term", "sources", "counts", "groups", "terms")
    return C.map_arrow(rows, texts, "lang string, source string, part string, item binary, value long").withColumn("item", F.col("item").cast("string"))


def divergences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", documents: int = DOCUMENTS,
                terms: int = TERMS, cells: int = CELLS, held: int = HELD, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of each (lang, source) from the other sources of the language
    (part pair, all ranks), and the terms that set it apart from the language (part term, the first ``terms``)."""
    stripes = C.cut_lineage(merge(fold(docs, text_col, lang_col, source_col, cells, held, block), documents), "stripes")
    groups = (stripes.select("lang", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", F.col("sources").alias("source"))
              .agg(F.sum("counts").alias("n")))
    totals = C.cut_lineage(groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"))
                           .join(stripes.groupBy("lang").agg(F.count("term").alias("terms")), "lang"), "totals")
    found = C.cut_lineage(shares(stripes, totals, terms), "shares")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best).select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(C.table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + v.v) AS p
      FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT c.lang, c.term, 1 + (1000000000::HUGEINT * (sum(c.n) + 1)) // (any_value(t.n) + any_value(v.v)) AS q
      FROM c JOIN (SELECT lang, sum(n) AS n FROM g GROUP BY lang) t USING (lang) JOIN v USING (lang) GROUP BY c.lang, c.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C")::INTEGER AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
