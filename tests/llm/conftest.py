import random

import pytest


@pytest.fixture(scope="session")
def texts():
    """Small documents with shared passages, copies, near copies and odd cases."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def line(n=12):
        return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."

    passage = "\n".join(line(20) for _ in range(4))
    base = [line(15) for _ in range(6)]
    out = ["\n".join(line() for _ in range(rng.randint(1, 9))) for _ in range(40)]
    out += [f"{line()}\n{passage}\n{line()}" for _ in range(8)]
    out += ["\n".join(base)] * 5
    for _ in range(8):
        part = " ".join(base).split(" ")
        part[rng.randrange(len(part))] = "changed"
        out.append(" ".join(part))
    out += [None, "", "   \n\t ", "x", "a " * 3000, "é" * 900 + " ü", "日本語 " * 80, line(3), line(3) + "\n\n\n", passage]
    out += ["z" * 5000, "ab" * 1500, "\n".join([line(5)] * 30)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Two ids repeat: one with an equal text, one with another; and a null id."""
    rows = [(i, t, "en", "s", 1, 2.0) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "s", 1, 2.0), (6, texts[45], "en", "s", 1, 2.0), (None, texts[4], None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n int, rank double").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
