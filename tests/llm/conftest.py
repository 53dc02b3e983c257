import random

import pytest

#: Texts that every operator must take: null, empty, blank, short, very long, ties, repeats.
_rng = random.Random(11)
WORDS = ["alpha", "beta", "Gamma", "delta", "été", "zug", "ñandú", "mit", "the", "license", "under", "of", "x9", "it's", "don't"]


def prose(n, rng=_rng):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def make_rows():
    rng = random.Random(5)
    base = [prose(rng.randint(60, 120), rng) for _ in range(25)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None])) for i, t in enumerate(base)]
    n = len(rows)
    for i in range(10):  # exact copies and near copies
        rows.append((n + 2 * i, base[i % 3], "en", "a"))
        words = base[3 + i].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((n + 2 * i + 1, " ".join(words), "fr", "b"))
    rows += [
        (900, None, "en", "a"),
        (901, "", None, None),
        (902, "  \n\t ", "en", "b"),
        (903, "one two", "en", "b"),
        (904, "One TWO", "en", "b"),
        (905, prose(30000, rng), "en", "a"),
        (906, "ab" * 3000, "en", "a"),
        (907, "Under the MIT License.\nCC BY-NC\nLicensed under the Apache License, Version 2.0.", "en", "a"),
        (908, "permission is granted, all rights\nreserved? This work is licensed under the GNU General Public License, version 3.", "en", "a"),
        (909, "日本語 のテキスト\x1c😀 — '", None, "c"),
        (910, "#### $$$ |a| <b> %%% &&& ** ## word " * 20, "en", "a"),
        (911, "same line here\n" * 40, "en", "a"),
        (None, "a row without an id " * 5, "en", "a"),
        (0, base[0], "en", "a"),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with further columns whose names clash with outputs."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({"n_words": F.lit("clash"), "kept": F.lit(7), "shard": F.lit("x"), "size": F.lit(None).cast("string")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
