"""Small tables with the cases every operator has to stand: nulls, empty and long texts, ties, repeats, clashing names."""

import random

import pytest

from carelake.llm import queries
from carelake.llm.common import Scratch

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, host string, key long, a long"


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def odd_documents():
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (1, base, "en", "s1"), (2, base, "en", "s1"), (3, near, "de", "s2"), (4, None, None, None), (5, "", "en", "s1"),
        (6, " \t\n ", "en", None), (7, "one", "fr", "s2"), (8, prose(2, 30_000), "en", "s1"), (None, base, "en", "s1"),
        (9, prose(3, 80) + " " + " ".join(words[20:90]) + " " + prose(4, 80), "en", "s2"), (10, prose(5, 300), None, "s3"),
        (11, "two words", "en", "s3"), (11, "two words", "en", "s3"), (12, "퟿ é 漢字   x y", "en", "s4"),
    ]
    return [(*r, len(r[1] or ""), 0.5, "h", 7, 8) for r in rows]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_documents(), DOCUMENTS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.fixture(scope="session")
def small(spark):
    return lambda name: queries.table(spark, SMALL, name)
