from __future__ import annotations

import random

import pytest


@pytest.fixture(autouse=True, scope="package")
def few_partitions(spark):
    """Small fixtures: few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def words(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, ties, repeated rows, a
    very long text, one long word, and rows of equal id."""
    base = words(1, 120)
    near = base[:60] + ["changed"] + base[61:]
    return [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (3, " ".join(base)),
        (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one"), (9, "ONE two"),
        (10, "x" * 30_000), (11, "\n".join(" ".join(words(k, 40)) for k in range(100, 300))),
        (12, "Ärger ﬁ 漢字 😀\x00 a\x0bb"), (12, "another text under this id"), (None, " ".join(base)), (None, None),
        (13, "\n".join([" ".join(words(5, 30))] * 3)),
    ]


@pytest.fixture
def odd_docs(spark, odd_rows):
    """The odd rows, with columns whose names the operators use themselves."""
    rows = [(i, t, "row", 7, "n", "value", 1.5) for i, t in odd_rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, row string, node bigint, t string, value string, n double").repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, node string")
