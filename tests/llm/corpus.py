"""Small documents for the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names the operators use inside; a table may have them too.
CLASHING = ("_row", "key", "n", "fp", "block", "part", "label", "length", "rank", "size")


def words(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    long = words(rng, 60_000)
    plain = words(rng, 120)
    return [(1, plain, "en", "s1", 1), (2, plain, "en", "s1", 1), (2, plain, "en", "s1", 1), (3, None, "en", "s2", None), (4, "", None, None, 0),
            (5, " \t\n ", "de", "s2", 4), (6, long, "en", "s1", len(long)), (7, long + " x", "en", None, len(long)), (None, plain + " tail", "en", "s3", 1),
            (None, None, None, None, None), (8, "é" * 700 + " ß", "fr", "s3", 700), (9, "one", "en", "s2", 3), (10, "12345 678", "en", "s2", 9),
            (11, "x" * 5000, "en", "s4", 5000)]


def edge_docs(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    return docs.withColumns({c: F.lit(f"user {c}") for c in CLASHING})


def edge_labels(spark, column, extra=()):
    rows = [(1, 1), (2, 1), (3, 0), (5, 0), (8, 1), (9, 0), (9, 1), (None, 1), (10, None), (77, 1), (11, 0), *extra]
    return spark.createDataFrame(rows, f"doc_id long, {column} int")


def many(spark, n=400, seed=3):
    """Documents with exact copies, near copies and shared passages; a third of them from one source."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 260)) for _ in range(n // 2)]
    passage = words(rng, 110)
    rows = []
    for i in range(n):
        text = rng.choice(base)
        kind = rng.random()
        if kind < 0.2:
            text = text.replace("a", "A", 1) + "\n"
        elif kind < 0.5:
            parts = text.split()
            parts[rng.randrange(len(parts))] = "edited"
            text = " ".join(parts)
        elif kind < 0.6:
            text = words(rng, 40) + " " + passage + " " + words(rng, 30)
        rows.append((i, text, rng.choice(("en", "de")), "s0" if rng.random() < 0.35 else f"s{rng.randint(1, 12)}", len(text)))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)
