import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, score string, size string"


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Copies, near copies, nulls, empty texts, repeated rows, a long text, columns with clashing names."""
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(20, 200)) for _ in range(40)]
    near = texts[0].split()
    chain = [near]
    for i in range(4):
        near = [*near]
        near[10 + 20 * i if 10 + 20 * i < len(near) else 3] = f"new{i}"
        chain.append(near)
    texts += [" ".join(c) for c in chain] + [texts[1], texts[1] + " \n", "  " + texts[1], texts[2].upper(), "one two", "One  two", "", " \n\t", None]
    texts.append(words(rng, 30_000))
    out = [(i, t, rng.choice(["en", "de", None]), f"s{i % 3}" if i % 7 else None, "x", None) for i, t in enumerate(texts)]
    return [*out, out[3], (None, "null id text that is long enough", None, "s0", None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
