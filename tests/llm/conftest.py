import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_words", T.LongType())])


def prose(rng, n, lines=10, vocabulary=400):
    words = [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]
    return "\n".join(" ".join(words[i:i + lines]) for i in range(0, n, lines))


@pytest.fixture(scope="session")
def texts():
    """Plain texts, copies, near copies, nulls, blanks, one long text, odd characters; ids in no order."""
    rng = random.Random(5)
    out = [prose(rng, rng.randrange(1, 300)) for _ in range(40)]
    base = prose(rng, 150)
    out += [base, base, base + " more"] + [" ".join("changed" if rng.random() < 0.02 else w for w in base.split(" ")) for _ in range(8)]
    out += [None, "", " \n\t ", "one two three", "one two three", "É école don't  x\x1c y <|endoftext|>", prose(rng, 6000), base + "\n" + prose(rng, 60)]
    rng.shuffle(out)
    return {i * 3 + 1: t for i, t in enumerate(out)}


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", i) for i, t in texts.items()], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
