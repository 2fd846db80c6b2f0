import random

import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside; a table may have them too.
CLASHING = ("row", "id", "size", "digest", "digest2", "part", "place", "block", "bucket", "kept", "score", "piece", "length", "node", "comp", "rank", "words", "text_sha256", "held_out")


@pytest.fixture(scope="session")
def rows():
    """Documents with everything that may trip an operator: (doc_id, text, source)."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(120), text(40)
    near = [" ".join(w if draw.random() > 0.01 * (i % 4) else word() for w in base.split(" ")) for i in range(12)]
    texts = [base, base, base.upper(), base.replace(" ", "\n"), None, "", " \t\r\n\x0b\x0c", "one", "one two", "ONE  two", text(20_000), "x" * 70_000, "ÀÉ " * 30, "…" * 60]
    texts += near + [text(30) + " " + passage + " " + text(30) for _ in range(6)] + [passage, text(60), text(61), "nul\x00 byte\x1c here", "\\b #h <l :c"]
    found = [(i, t, ("a", "b", None, "a")[i % 4]) for i, t in enumerate(texts)]
    return [*found, (None, base, "b"), (None, None, None), (7, "one", None), (7, "one", None), (900, near[3], "a"), (900, near[3], "a")]


@pytest.fixture(scope="session")
def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return df.select("*", F.lit("en").alias("lang"), F.length("text").cast("long").alias("n_chars"), *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("false")
