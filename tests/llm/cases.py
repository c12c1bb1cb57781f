"""Small awkward tables: nulls in every column, empty and long texts, repeated rows, clashing column names."""

import random

from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, kept boolean, node long, "
          "component long, shard int, rank long, text_hash long, length long, _id long, label int")
EXTRA = (7, None, 3, None, 5, None, 1, None, 9, None)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words))


def texts() -> list:
    base = prose(1, 300).split()
    near = base[:]
    near[150] = "changed"
    far = base[:120] + prose(2, 200).split()
    return [
        (1, " ".join(base)), (2, " ".join(base)), (3, "  ".join(base) + " \t\n"), (4, " ".join(near)), (5, " ".join(far)),
        (6, None), (7, ""), (8, " \n\t "), (9, "one two"), (10, "one two"), (11, "ONE two"), (12, prose(3, 30_000)),
        (13, prose(4, 60)), (13, prose(4, 60)), (13, prose(5, 60)), (None, prose(6, 50)), (None, None),
        (14, "日本語 テキスト ß É é <|endoftext|> a  b   c d don't"), (15, "x" * 5000), (16, "\x00 \x1c ok"), (17, "a b c d e"),
        (18, prose(4, 60).upper()),
    ]


def docs(spark, rows=None):
    data = [(i, t, None if i == 3 else "en", "s", None if t is None else len(t), *EXTRA) for i, t in (texts() if rows is None else rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3, F.rand(1)) if data else spark.createDataFrame([], SCHEMA)


def folder(spark, path, documents, **tables) -> str:
    """A data directory of Parquet tables."""
    documents.write.parquet(f"{path}/documents.parquet")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)
