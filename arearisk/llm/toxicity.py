"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or, trained from document labels.

A document is a bag of sentences. A sentence's probability is a logistic function of its words and of their first
four, five and six bytes (so unseen forms of a known stem count); a document is toxic if any sentence is: 1 - product of (1 - p). Only document labels are known, so the gradient of a document's loss is
shared among its sentences by their own probabilities, and the trained sentence scores locate the offending ones.

The model is fitted on the driver from a bounded sample: the ``sample`` labelled ids of the training folds with the
smallest hash, of each (id, label) one row, that with the smallest text hash; rows of an id are reduced inside Spark. Executors turn them into word hashes; those in fewer than ``MIN_DOCS`` sampled documents, or in
many of label 0, are left out. The fitted table holds at most the sample's vocabulary and is broadcast. Scoring reads every whole text.

Defined results: a null text or one without words scores 0. A repeated row is scored each time and learned once; labels without
a document, or null, are ignored. Without any label all scores are 0. Other columns pass through where a caller asks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 6000
MIN_DOCS = 3
#: features in more than this share of the sampled documents of label 0 say nothing and are left out
MAX_SHARE = 0.2
ROUNDS = 100
THRESHOLD = 0.3
#: documents whose crc32(id) leaves this remainder modulo 4 are held out
FOLDS, HELD_OUT = 4, 2

_SYMBOLS = C.symbol_table(51)
_SYMBOLS[0] = 0
#: bytes of the word beginnings that are features besides the word
HEADS = (4, 5, 6)
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x0D, 0x21, 0x2E, 0x3F]] = True  # line ends, exclamation mark, full stop, question mark


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float


def features(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row for each word: 32-bit hashes of the word and of its beginnings (0 where it is not longer)."""
    out = np.empty((len(starts), 1 + len(HEADS)), np.uint32)
    out[:, 0] = C.span_hashes(low, starts, _SYMBOLS) >> np.uint64(32)
    h = np.zeros(len(starts), np.uint64)
    for k in range(max(HEADS)):
        at = np.minimum(starts + k, max(0, len(low) - 1))
        h = np.where(starts + k < ends, h * np.uint64(0x9E3779B97F4A7C15) + _SYMBOLS[low[at]], h)
        if k + 1 in HEADS:
            out[:, 1 + HEADS.index(k + 1)] = np.where(starts + k + 1 < ends, C.mix(h ^ np.uint64(k + 1)) >> np.uint64(32), 0)
    return out


def sentences(data: np.ndarray, offs: np.ndarray) -> tuple:
    """(features of each word, sentence of each word, first sentence of each text, sentence starts, sentence ends)."""
    low = C.WORDS[data]
    starts, ends, first = C.word_bounds(low != 0, offs)
    stops = np.concatenate(([0], np.cumsum(_STOP[data])))[starts] if len(starts) else starts
    opens = np.zeros(len(starts) + 1, bool)
    opens[first] = True
    opens = opens[:-1]
    if len(starts):
        opens[0] = True
        opens[1:] |= stops[1:] != stops[:-1]
    head = np.flatnonzero(opens)
    tail = np.append(head[1:], len(starts)) - 1
    return (features(low, starts, ends), np.cumsum(opens) - 1, np.searchsorted(head, first),
            starts[head] if len(head) else head, ends[tail] if len(head) else head)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def bag_sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(x)))
    return total[bounds[1:]] - total[bounds[:-1]]


def score_block(data: np.ndarray, offs: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document score, sentence score, first sentence of each text, sentence starts, sentence ends)."""
    words, sentence, bounds, starts, ends = sentences(data, offs)
    z = np.full(len(starts), model.bias)
    if len(words) and len(model.words):
        at = np.minimum(np.searchsorted(model.words, words), len(model.words) - 1)
        z += np.bincount(sentence, np.where(model.words[at] == words, model.weights[at], 0).sum(axis=1), minlength=len(starts))
    z = z.clip(-40, 40)
    return 1 - np.exp(-bag_sums(softplus(z), bounds)), 1 / (1 + np.exp(-z)), bounds, starts, ends


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = ROUNDS, decay: float = 5e-3) -> Model:
    """Noisy-or logistic model of bags (word hashes, sentence lengths), by Adam on all bags at once."""
    empty = Model(np.zeros(0, np.uint32), np.zeros(0), -30.0)
    if not len(bags) or not labels.any():
        return empty
    per_doc = [np.unique(w) for w, _ in bags]
    kept, seen = np.unique(np.concatenate(per_doc), return_counts=True)
    clean = np.concatenate([x for x, label in zip(per_doc, labels) if not label] or [kept[:0]])
    common, times = np.unique(clean, return_counts=True)
    common = common[times > MAX_SHARE * max(1, len(labels) - int(np.sum(labels)))]
    del per_doc, clean
    use = kept[(seen >= MIN_DOCS) & (kept > 0) & ~np.isin(kept, common)]
    if not len(use):
        return empty
    feature, sentence, before = [], [], 0  # of the occurrences that are kept
    for w, n in bags:
        at = np.minimum(np.searchsorted(use, w), len(use) - 1)
        good = use[at] == w
        feature.append(at[good])
        sentence.append(before + np.repeat(np.arange(len(n)), n)[good])
        before += len(n)
    feature, sentence = np.concatenate(feature), np.concatenate(sentence)
    lengths = np.concatenate([n for _, n in bags])
    bounds = np.concatenate(([0], np.cumsum([len(n) for _, n in bags])))
    owner = np.repeat(np.arange(len(bags)), np.diff(bounds))
    w, bias = np.zeros(len(use) + 1), -5.0  # the last weight is the bias' change
    m, v = np.zeros_like(w), np.zeros_like(w)
    y = labels.astype(bool)
    for t in range(1, rounds + 1):
        z = np.bincount(sentence, w[feature], minlength=len(lengths)) + bias + w[-1]
        z = z.clip(-40, 40)
        p = 1 / (1 + np.exp(-z))
        loss = np.maximum(bag_sums(softplus(z), bounds), 1e-9)
        share = np.where(y, -1 / np.expm1(np.minimum(loss, 50)), 1.0)[owner] * p  # d(-log likelihood) / dz
        g = np.empty_like(w)
        g[:-1] = np.bincount(feature, share[sentence], minlength=len(use)) + decay * len(bags) ** 0.5 * np.sign(w[:-1])
        g[-1] = share.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    strong = np.abs(w[:-1]) > 0.3
    return Model(use[strong], w[:-1][strong], bias + float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most ``sample`` labelled documents of the training folds."""
    picked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.pmod(C.id_hash(id_col), F.lit(FOLDS)) != HELD_OUT))
              .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
              .orderBy(F.xxhash64("id"), "id", "label").limit(sample))  # a bounded sample, by hash
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(2)):
                words, sentence, bounds, starts, _ = sentences(data, offs)
                n = np.bincount(sentence, (words > 0).sum(axis=1), minlength=len(starts)).astype(int) if len(starts) else np.zeros(0, int)
                words = words[words > 0]
                first = np.concatenate(([0], np.cumsum(n)))[bounds]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.string()), batch.column(1).slice(lo, hi - lo),
                     pa.array([words[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
                     pa.array([n[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    ["id", "label", "words", "lengths"])

    got = C.first_of_keys(rows, ["id", "label"], read, "id string, label int, words binary, lengths binary").collect()  # the sample
    got.sort(key=lambda r: (r.id or "", r.label, bytes(r.words)))
    return fit([(np.frombuffer(r.words, np.uint32), np.frombuffer(r.lengths, np.int32)) for r in got], np.array([r.label for r in got]))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, and the offending sentences (bytes of the UTF-8 text) with a score of a half or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1)):
                score, each, bounds, starts, ends = score_block(data, offs, shared.value)
                spans: list[list] = [[] for _ in range(hi - lo)]
                for s in np.flatnonzero(each >= 0.5).tolist():
                    d = int(np.searchsorted(bounds, s, side="right")) - 1
                    spans[d].append([int(starts[s] - offs[d]), int(ends[s] - offs[d])])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score.clip(0, 1)),
                                                  pa.array(spans, pa.list_(pa.list_(pa.int64())))], ["doc_id", "score", "offending"])

    kind = docs.schema[id_col].dataType.simpleString()
    return C.map_arrow(docs.select(id_col, text_col), read, f"doc_id {kind}, score double, offending array<array<long>>")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [score_block(data, offs, shared.value)[0] for _, _, data, offs in C.blocks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(score) < threshold)) if score else batch

    return C.map_arrow(docs, read, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    found = scores(docs, train(docs, C.table(spark, sf_dir, "labels")))
    return found.select("doc_id", (F.pmod(C.id_hash(), F.lit(FOLDS)) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
