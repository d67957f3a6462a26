"""Small tables that hold the hard cases every operator must handle."""

from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, shard string, part string, place string, sequence_id string"


def doc_frame(spark, texts, first=0):
    """Documents with columns whose names clash with those operators make."""
    rows = [(first + i, t, "en", None, None, "x", "y", "z", "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture
def hard_texts():
    long = " ".join(f"word{i % 977} Straße{i % 31}," for i in range(60_000))
    return [None, "", " ", "\n", "a  b \n\tc", "tie tie tie", "tie tie tie", long, "İstanbul é 日本語 😀", "x" * 5000]
