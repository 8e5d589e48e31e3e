import random

import pytest

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


@pytest.fixture()
def words():
    rng = random.Random(5)
    return lambda n: ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in each column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i * 7919 % 3001}" for i in range(60_000))
    rows = [(1, "a b c d e f\nline two here is it\n\n a b  c d e f "), (2, None), (None, "a b c d e f"), (3, ""), (4, " \t\n "), (5, long), (6, long), (7, "password=12345678 é漢字😀 \x1f&amp;"), (7, "password=12345678 é漢字😀 \x1f&amp;"), (None, None), (8, "one"), (9, "one")]
    return spark.createDataFrame([(i, t, None, "s" if i else None, None, i, "x", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, id long, batch string, __text int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
