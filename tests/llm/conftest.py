from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as further columns of the input.
CLASHES = (
    "row", "size", "rank", "block", "cell", "n", "h", "text_key", "_cut", "_size", "target", "component_id", "k1",
    "score", "held_out", "part", "positive", "n_bytes", "one", "key",
)


@pytest.fixture(scope="session")
def prose():
    """Text of n invented words, the same for the same seed."""

    def build(n: int, seed: int, vocabulary: int = 3000) -> str:
        rng = random.Random(seed)
        syllables = ["ba", "ro", "ti", "len", "sa", "mo", "ek", "du"]
        return " ".join(
            "".join(syllables[int(d)] for d in f"{rng.randrange(vocabulary) + 8:o}") + rng.choice(["", "", "", ".", ","])
            for _ in range(n)
        )

    return build


@pytest.fixture(scope="session")
def edge_docs(spark, prose):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows, and
    further columns with clashing names."""
    long_text = prose(60_000, 1)
    rows = [
        (1, prose(120, 2), "en", "b", 5),
        (2, prose(120, 2), "en", "b", 5),
        (3, prose(120, 3), None, None, None),
        (3, prose(120, 3), None, None, None),
        (4, None, "en", "a", 0),
        (5, "", "en", "a", 0),
        (6, " \n\t ", None, "a", 4),
        (None, prose(80, 4), "en", "a", 1),
        (None, None, None, None, None),
        (7, long_text, "de", "c", 9),
        (8, "one", "en", "", 3),
        (9, "one two\none two\n\none two", "en", "é", 3),
        (-5, prose(90, 5) + " <|endoftext|> naïve ４２  x", "fr", "b", 7),
    ]
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
