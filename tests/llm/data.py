"""Small tables for the tests of the training-data operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(n, seed, vocabulary=400):
    rng = random.Random(seed)
    words = [
        "".join(rng.choice(["ka", "lo", "mi", "ren", "tu", "sa", "vor", "é"]) for _ in range(1 + i % 3))
        for i in range(vocabulary)
    ]
    return " ".join(rng.choice(words) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank, short, very long and repeated texts."""
    twin = prose(120, 5)
    return [
        (None, prose(80, 1), "en", "a", 1),
        (None, None, None, None, None),
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", None, "b", 7),
        (4, "one", "de", None, 3),
        (5, twin, "en", "a", len(twin)),
        (6, twin, "en", "b", len(twin)),
        (6, twin, "en", "b", len(twin)),
        (7, twin + " tail", "en", "b", len(twin) + 5),
        (8, "x" * 60_000, "en", "a", 60_000),
        (9, prose(9_000, 2), "en", "a", None),
        (10, "żółw 𝄞 \x00 \x85 ﬁ İ <|endoftext|> it's", "pl", "c", 30),
        (-11, prose(60, 3) + "\n" + prose(60, 3), "en", "a", 5),
    ]


def odd(spark, **extra):
    """The odd rows, with extra columns of these names."""
    from pyspark.sql import functions as F

    table = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    return table.withColumns({name: F.lit(value) for name, value in extra.items()})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
