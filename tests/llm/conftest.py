import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "Erin", "onthe", "tion,", "leaux", "é", "shan.", "ndwh", "12", "it's"]) + rng.choice(["", "a", "en", "ouv"]) for _ in range(n))


def corpus(n=120):
    rng = random.Random(7)
    texts = [words(rng, rng.choice([1, 3, 20, 80, 300])) for _ in range(n)]
    texts[5] = texts[4]
    for i in range(40, 80):
        texts[i] = texts[40]  # a third of all rows
    texts[81] = texts[80] + " tail"
    texts[82] = None
    texts[83] = ""
    texts[84] = " \n\t "
    texts[85] = words(rng, 9000)
    texts[86] = "x" * 30000
    texts[87] = texts[85][2000:]
    rows = [(i, t, "en", "src0", len(t or ""), "e") for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[6], None, None, None, None), (1000, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
