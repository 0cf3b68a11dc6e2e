import random

import pytest


@pytest.fixture()
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) rows, with columns whose names the operators use inside."""

    def make(rows, partitions=2):
        full = [(i, t, "x", 1, 2, 3, "y") for i, t in rows]
        schema = "doc_id bigint, text string, piece string, key int, pos int, gram int, hash string"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from".split()


def prose(rng, words):
    """Words with capitals, punctuation and line breaks."""
    out = []
    for _ in range(words):
        w = rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "ly", "é"])
        out.append(rng.choice([w, w, w.title(), w + ",", w + ".\n"]))
    return " ".join(out)


# Texts that every operator has to survive.
ODD = [None, "", " ", "\n\n\n", "\t", "a", "A", "é", "á", "中文", "1 2 3", "!!!", "<|endoftext|>", "\x00", "x" * 3000]
