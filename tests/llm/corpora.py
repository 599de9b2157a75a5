"""Small tables with the awkward rows that every operator must bear."""

import random

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, h int, words int, rep int, g int, row int, size string, copies int"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x{r.randrange(3)}" for _ in range(n))


def awkward(spark, texts=()):
    """Nulls in each column, empty and blank texts, a long one, repeated rows, clashing names."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (None, prose(1, 80), "en", None, 9),
        (None, None, None, None, None),
        (5, prose(2, 30_000, 9_000), "en", "b", 1),
        (6, prose(3, 90), "de", "b", 1),
        (6, prose(3, 90), "de", "b", 1),
        (7, "one", "fr", "", 3),
    ]
    rows += [(100 + i, t, "en", "c", len(t)) for i, t in enumerate(texts)]
    clash = ("x", "y", 1, 2, 3, 4, 5, "z", 6)
    return spark.createDataFrame([(*r, *clash) for r in rows], SHAPE)


def empty(spark):
    return spark.createDataFrame([], SHAPE)
