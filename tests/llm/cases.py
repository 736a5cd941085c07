"""Rows that every operator of the subpackage has to cope with."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use themselves.
CLASHING = ["node", "digest", "size", "copies", "target", "kept", "score", "spans", "value", "start", "rank", "key", "n", "row", "of",
            "_id", "_node", "_runs", "_key", "_said", "_source", "_copy", "_blank", "_row", "_clean", "_lower", "_digest"]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))) for _ in range(n))


def hard_rows() -> list[tuple]:
    long = prose(60_000, 1)
    return [(1, None, "en", "a", None), (2, "", "en", "b", 0), (3, " \n\t ", None, None, 4), (4, "word", "en", None, 4),
            (None, prose(80, 2), "en", "a", 9), (None, prose(80, 2), None, "a", 9), (None, None, None, None, None),
            (5, long, "en", "a", len(long)), (6, long, "de", "b", len(long)), (7, prose(120, 3), "fr", "b", 1), (7, prose(120, 3), "fr", "b", 1),
            (8, prose(90, 4), "en", "ü", 1), (8, prose(90, 5), "en", "z", 1), (9, "\0 ÄÖ ſ é 漢字 \U00020000 \u00a0x", "en", "a", 1),
            (10, "12 34 ... !!", "en", "a", 1), (11, "x" * 200_000, "en", "a", 1), (12, "a " * 50_000, "en", "a", 1)]


def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA)


def clashing(spark):
    df = hard(spark)
    for c in CLASHING:
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
