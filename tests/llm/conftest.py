import random

import pytest

from jobledger.llm.queries import ship

#: Nulls, empty and blank texts, ties, repeated rows, ids that are missing or shared.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog again and again"),
    (2, "the quick brown fox jumps over the lazy dog again and again"),
    (3, None), (4, ""), (5, " \n\t "), (None, "without an id"), (None, "without an id"), (None, None),
    (6, "one id two texts"), (6, "the other text"), (7, "repeated row"), (7, "repeated row"), (8, "word"),
]


@pytest.fixture(autouse=True)
def library_on_workers(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """``docs(rows)``: a table of documents whose other columns have the operators' own names."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, source string, _h string, kept int, size string, label string"
        full = [(i, t, f"s{(i or 0) % 3}", "x", 1, "y", "z") for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def prose():
    """Random sentences of a small vocabulary."""

    def make(words, seed):
        random_ = random.Random(seed)
        return " ".join(f"w{random_.randrange(3000)}" for _ in range(words))

    return make
