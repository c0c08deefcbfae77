"""Small documents for the training-data tests, with the odd cases every operator must take."""

import random

SF = "/root/testdata/sf0.001"
WORDS = ("river stone lamp garden window paper engine cloud copper field ladder violet anchor bridge "
         "candle forest harbor island jacket kettle mirror needle orange pillow rocket saddle tunnel").split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", ","]) for _ in range(n))


def frame(spark, rows, shape="doc_id long, text string, lang string, source string, score string, key string, rep string, root string, spans string"):
    width = len(shape.split(","))
    return spark.createDataFrame([tuple(r) + ("x",) * (width - len(r)) for r in rows], shape)


def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, repeated rows and ids."""
    return [
        (1, None, None, None), (2, "", "en", "b"), (3, " \n\t ", None, "a"), (4, "one", "en", None),
        (5, prose(5, 60), "en", "a"), (5, prose(5, 60), "en", "a"), (6, prose(6, 60), "fr", "b"),
        (6, prose(66, 40), "fr", "b"), (None, prose(7, 30), "en", "a"), (None, None, None, None),
        (8, prose(8, 20000), "en", "c"), (9, "Ünïcode  ÄÖ ß 12,5 — “ok”\n\nend ", "de", "a"), (10, "12 34 !!", "en", "a"),
        (2**60 + 1, prose(5, 60), "en", "b"),
    ]
