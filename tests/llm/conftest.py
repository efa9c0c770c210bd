import random

import pytest


@pytest.fixture
def prose():
    """Texts of invented words; the same seed gives the same text."""

    def make(n_words, seed, vocabulary=400):
        draw = random.Random(seed)
        words = ["".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 7))) for _ in range(vocabulary)]
        draw = random.Random(f"text {seed}")
        return " ".join(draw.choice(words) for _ in range(n_words))

    return make


@pytest.fixture
def documents(spark):
    """A table of documents; rows are (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(*row, "en", "s0", 0)[:5] if len(row) == 2 else (*row, 0) for row in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
