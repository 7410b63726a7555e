import random

import pytest

WORDS = "the of and to in that was with on be at by this from or one had all were when we there can an your said each which she do how their if will up other about out many then them these so some her would make like him into time has look two more write go see number no way could people my than first water been call who oil its now find long down day did get come made may part".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) * (rng.random() < 0.6) for _ in range(n))


def odd_texts() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empties, ties, repeated rows, copies, near copies, a long text."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (0, base, "en", "a"), (1, base, "en", "a"), (2, near, "en", "b"), (3, base.upper(), "en", None), (4, None, "en", "a"),
        (5, "", None, "a"), (6, " \t\n ", "en", "b"), (7, "one two", "en", "b"), (8, "ONE\x0btwo", "de", "b"), (9, prose(2, 3000), "en", "a"),
        (9, prose(2, 3000), "en", "a"), (10, "a b c a b c a b c\nx y\nx y\n\n", "fr", "c"), (11, "café über \U0001f600 naïve " * 30, "fr", "c"),
        (12, prose(3, 60) + "\n" + prose(4, 80), "en", "a"), (13, prose(5, 70) + "\n" + prose(4, 80), "es", "a"), (14, "#" * 200, "en", "a"),
        (15, "x" * 300, "en", "a"), (16, "x" * 300, "en", "c"),
    ]
    return rows + [(100 + i, prose(50 + i, 40 + i), "en" if i % 2 else "de", "abc"[i % 3]) for i in range(12)]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), "clash") for r in odd_texts()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark, odd):
    return spark.createDataFrame([], odd.schema)
