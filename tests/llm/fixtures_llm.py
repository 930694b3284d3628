"""Small document tables for the pipeline operators."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first_id=0, lang="en"):
    """One document for each text; every third has no source."""
    rows = [
        (first_id + i, t, lang, None if i % 3 == 2 else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def prose(seed: int, n: int, vocabulary: int = 5000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


ODD_TEXTS = [None, "", " \n\t ", "one", "one", "déjà vu — naïve\x0bß 日本語 \U0001f600", "a b c d", "x" * 5000]
