"""Small frames with the awkward rows that every operator has to take."""

import random

DOCS = "doc_id long, text string, extra string"


def awkward_docs(spark, more=()):
    rows = [
        (1, None, "a"), (2, "", None), (3, " \n\t\n ", "c"), (4, "one line", "d"), (4, "one line", "d"),
        (5, "one line", "e"), (None, "one line", "f"), (None, None, "g"), (6, "naïve café 漢字 \U0001f600", "h"),
        (7, "x" * 50_000, "i"), (8, "word " * 9_000, "j"), (8, "other text of the same id", "k"),
    ]
    return spark.createDataFrame([*rows, *more], DOCS).withColumnRenamed("extra", "row")


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 9))) for _ in range(n)]
