"""Small inputs with all that may be odd about a table, shared by the tests."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "taken long, label string, row string, key string, size long, class string"
)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice("abdefgilnorstu") for _ in range(r.randint(2, 9))) for _ in range(400)]
    return " ".join(r.choice(words) + r.choice(["", "", "", ".", ",\n"]) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows; other columns clash."""
    long, base = prose(1, 6000), prose(2, 120)
    near = base.replace(base.split(" ")[60], "zzz", 1)
    secret = "x password = abcdef1 token:abc AKIA" + "A1" * 9 + " " + "0f" * 13 + "\nsecret=token: abcdefgh é😀 API_KEY=\"q1w2e3r4"
    texts = [
        (1, long, "a"), (2, base, "a"), (3, near, "b"), (4, base, None), (5, "", "b"), (6, None, "b"),
        (None, base, "c"), (None, None, None), (7, secret, "c"), (7, secret, "c"), (7, "other words here", "c"),
        (8, "😀é 　x", "d"), (9, " \n\t ", "d"), (10, "one", "d"), (11, "!!! ??? ...", "é"), (12, long + " end", "é"),
        (13, "a" * 700, "e"), (14, "Released under the MIT License. " + base[:50], "e"), (15, "b" + base + base, "e"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), 1, "l", "r", "k", 9, "c") for i, t, s in texts]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
