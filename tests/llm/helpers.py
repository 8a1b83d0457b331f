"""Small inputs shared by the operator tests."""

import random

SCHEMA = "doc_id long, text string"
WORDS = [a + b for a in ("al", "be", "cor", "de", "fi", "gra") for b in ("na", "to", "ris", "mel", "ück", "sé")]


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Null, empty, repeated, very long and hard-to-cut texts, null and repeated ids."""
    long = prose(1, 9000)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "two words"), (None, None),
        (5, long), (6, long), (7, long[:20000] + " changed here " + long[20000:]), (8, "x" * 30000),
        (9, "漢字かな" * 3000), (10, "it's we're they'll " * 400), (11, "a<|endoftext|>b  \n c"),
        (12, prose(2, 60)), (13, prose(2, 60)), (14, prose(2, 59) + " end"), (15, "\n".join([prose(3, 8)] * 4)),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def with_extras(docs):
    """The same documents with columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    names = ["k", "w", "row", "n", "_words", "_hits", "_text_key", "_drop", "_row_key", "_toxicity", "score", "fp",
             "r", "f", "h", "gram", "pos", "len", "x", "at", "leaf", "exact", "drop", "entity", "term", "spans", "w_"]
    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
