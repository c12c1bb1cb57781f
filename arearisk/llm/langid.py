"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

A text's features are its byte trigrams and 4-grams after lower-casing, hashed to ``BUCKETS`` rows of a table; the
mean of the rows goes through a linear softmax over the learned languages. Because the layers are linear, a fitted
model folds into one table of scores per feature, which is broadcast (a fixed size times the number of languages).

Fitted on the driver from a bounded sample: of each language the ``PER_LANGUAGE`` training ids with the smallest hash, of
each one row, that with the smallest text hash; rows of an id are reduced inside Spark. A fifth of the sample is kept for calibration: a temperature for the probabilities, and the
probability below which a prediction is marked ``rejected``, so that accepted ones are right in ``TRUST`` of cases.

Defined results: ``und`` with score 0 if the text is null or has no letter, or nothing was learned. Null languages
are not learned. Repeated rows are predicted each time and learned once. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 1 << 16
WIDTH = 12
PER_LANGUAGE = 500
EPOCHS = 6
RATE = 0.5
TRUST = 0.99
#: documents whose crc32(id) leaves this remainder modulo 3 are held out
FOLDS, HELD_OUT = 3, 1
#: ASCII signs and digits are like spaces, so features hold letters and word edges
_LOW = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    accept: float


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, features before each text). Grams of spaces alone do not count."""
    low = _LOW[data]
    which = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    buckets, owners = [], []
    for size in (3, 4):
        n = len(low) - size + 1
        if n <= 0:
            continue
        h, letters = np.full(n, size, np.uint32), np.zeros(n, bool)
        for k in range(size):
            part = low[k:k + n]
            h = (h ^ part) * np.uint32(0x01000193) + (h >> np.uint32(15))
            letters |= part != 32
        good = np.flatnonzero(letters & (which[:n] == which[size - 1:]))
        buckets.append((h[good] >> np.uint32(8)) % np.uint32(BUCKETS))
        owners.append(which[good])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(offs) - 1))))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 7) -> Model:
    """Train on (bucket, share of the text's features, language); every fifth row calibrates."""
    languages = sorted({lang for *_, lang in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    number = {lang: k for k, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    out, bias = np.zeros((len(languages), WIDTH)), np.zeros(len(languages))
    learn = [i for i in range(len(rows)) if i % 5] or list(range(len(rows)))
    held = [i for i in range(len(rows)) if i % 5 == 0]
    steps, done = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            bucket, share, lang = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(bucket):
                continue
            x = share @ emb[bucket]
            g = softmax(out @ x + bias)
            g[number[lang]] -= 1
            back = out.T @ g
            out -= rate * np.outer(g, x)
            bias -= rate * 0.1 * g
            emb[bucket] -= rate * share[:, None] * len(bucket) ** 0.5 * back  # shares are small: a step per feature
    table = emb @ out.T
    z = np.array([rows[i][1] @ table[rows[i][0]] + bias for i in held]).reshape(-1, len(languages))
    truth = np.array([number[rows[i][2]] for i in held], int)
    temperature, accept = 1.0, 0.0
    if len(held):
        grid = np.geomspace(0.05, 5, 40)
        loss = [-np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / temperature)
        top, right = p.max(axis=1), p.argmax(axis=1) == truth
        order = np.argsort(-top)
        share_right = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share_right >= TRUST)
        accept = float(top[order[good[-1]]]) if len(good) else 1.0
    return Model(languages, table.astype(np.float32), bias, temperature, accept)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.pmod(C.id_hash(id_col), F.lit(FOLDS)) != HELD_OUT))
    drawn = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).distinct().withColumn("draw", F.pmod(F.xxhash64("id"), F.lit(1_000_000)))
    # the share of each language's ids that holds about twice its bound, so that few of a language meet in its window
    shares = drawn.groupBy("lang").agg((F.lit(2_000_000.0 * per_language) / F.count("*")).alias("limit"))
    picked = (drawn.join(F.broadcast(shares), "lang").where("draw < limit")  # one row per language
              .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id")))
              .where(F.col("place") <= per_language).select("id", "lang"))
    sample = (rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
              .join(F.broadcast(picked), ["id", "lang"]))  # per_language ids a language

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(2)):
                bucket, bounds = features(data, offs)
                out = []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    u, n = np.unique(bucket[a:b], return_counts=True)
                    out.append((u.astype("<u4").tobytes(), (n / max(1, b - a)).astype("<f4").tobytes()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.string()), batch.column(1).slice(lo, hi - lo),
                                                  pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())],
                                                 ["id", "lang", "buckets", "shares"])

    got = C.first_of_keys(sample, ["id", "lang"], read, "id string, lang string, buckets binary, shares binary").collect()  # the sample
    got.sort(key=lambda r: (hash_order(r.id), r.lang, bytes(r.buckets)))
    return fit([(np.frombuffer(r.buckets, "<u4").astype(np.int64), np.frombuffer(r.shares, "<f4").astype(float), r.lang) for r in got])


def hash_order(text: str | None) -> int:
    import zlib

    return zlib.crc32(b"order " + (text or "").encode())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            for lo, hi, data, offs in C.blocks(batch.column(1)):
                bucket, bounds = features(data, offs)
                n = np.diff(bounds)
                z = np.zeros((hi - lo, max(1, len(model.languages))))
                for k in range(len(model.languages)):
                    total = np.concatenate(([0.0], np.cumsum(model.table[bucket, k], dtype=np.float64)))
                    z[:, k] = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(n, 1) + model.bias[k]
                p = softmax(z / model.temperature)
                top, best = p.max(axis=1), p.argmax(axis=1)
                letter = np.concatenate(([0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))))[offs]
                bare = np.diff(letter) == 0
                for i in np.flatnonzero(bare & (np.diff(offs) > 0)).tolist():  # no ASCII letter: other letters decide
                    bare[i] = not any(ch.isalpha() for ch in data[offs[i]:offs[i + 1]].tobytes().decode("utf-8", "replace"))
                if not model.languages:
                    bare[:] = True
                best = np.where(bare, len(model.languages), best)
                top = np.where(bare, 0.0, top)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(names[best], pa.string()), pa.array(top),
                                                  pa.array(bare | (top < model.accept))], ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return C.map_arrow(docs.select(id_col, text_col), read, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).select("doc_id", (F.pmod(C.id_hash(), F.lit(FOLDS)) == HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")
