"""Small fixtures shared by the tests of this folder."""

import random

ID_TEXT = "doc_id bigint, text string"
VOCAB = [f"w{i}" for i in range(400)]


def words(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(VOCAB) for _ in range(n)]


def edge_rows() -> list[tuple]:
    """Null ids and texts, empty and blank texts, one long text, repeats."""
    long = " ".join(words(random.Random(5), 30_000))
    return [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three"), (6, long), (7, long),
            (None, "a text without an id goes on here"), (8, "Ça va? Übung, ñandú. 日本語 \U0001F600"), (9, "same row"),
            (9, "same row"), (10, "SAME ROW")]


def frame(spark, rows, schema=ID_TEXT):
    return spark.createDataFrame(rows, schema)
