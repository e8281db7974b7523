from __future__ import annotations

import pytest

#: Nulls in every column, empty, blank and repeated rows, and a long text.
ROWS = [
    (1, "one two three four five six seven", "en", "a", 3),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "de", "b", 4),
    (None, "no id here, but some words", "en", None, 26),
    (5, "said twice said twice", "en", "a", 21),
    (5, "said twice said twice", "en", "a", 21),
    (6, "1234 5678 !?", None, "c", 12),
    (7, " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000)), "en", "a", 1),
]
CLASHES = ["m_key", "m_hash", "r_rest", "r_text", "n_rest", "n_words", "n_removed", "g_id", "f_id", "l_id", "u_id", "ids", "kept", "lid", "position"]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with further columns named like the operators' own."""
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return frame.withColumns({c: F.lit("theirs") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
