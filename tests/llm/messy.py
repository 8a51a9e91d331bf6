"""Documents with every awkward case, and what the tables are called."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside, or return.
        T.StructField("score", T.StringType()),
        T.StructField("stats", T.IntegerType()),
        T.StructField("id", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("shard", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("odd name`d", T.StringType()),
    ]
)
VOWELS = "ba de fi go lu mer tan sol rik".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(VOWELS, k=rng.randint(1, 3))) for _ in range(words))


TEXTS = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, prose(4, 60)),
    (5, prose(4, 60)),
    (6, prose(4, 60).upper()),
    (7, "word"),
    (8, prose(8, 3)),
    (9, "ünï çødé 漢字 ́👩‍👩 " + prose(9, 40)),
    (10, prose(10, 20_000)),
    (11, "a" * 30_000),
    (12, "password: hunter22 " + prose(12, 10)),
    (12, prose(13, 30)),
    (14, prose(14, 30)),
    (14, prose(14, 30)),
    (None, prose(15, 30)),
    (None, None),
    (-7, "!!! ???"),
    (1 << 40, "<|endoftext|> <|im_end|>"),
]


def documents(spark, rows=TEXTS):
    data = [
        (i, t, None, None if t is None else len(t), "s", 1, "x", "y", i, "z", "w", "v", "u")
        for i, t in rows
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def labels(spark, rows=()):
    return spark.createDataFrame([*rows], "doc_id long, quality int, toxic int, text string")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
