"""Documents that every operator must take: nulls, empty and very long texts, repeats, odd columns."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_texts import prose  # noqa: E402

@pytest.fixture
def odd_documents(spark):
    """Rows with every oddity, and columns whose names clash with what operators use inside."""
    rows = [
        (1, prose(1, 60), "a", "en", 1), (1, prose(1, 60), "a", "en", 1), (2, "", "b", "en", 0), (3, None, None, None, None), (None, prose(1, 60), "a", "en", 1),
        (4, "   \n\t ", "b", "en", 5), (5, "x" * 300_000, "a", "en", 300_000), (6, prose(7, 20_000), None, "en", 9), (7, "one", "a", "en", 3), (8, "one", "b", "en", 3), (9, "two words", "c", "en", 9), (-4, "ÀÉ ção 你好 \U0001f600.\nB", "ü", "en", 9),
    ]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "1 as key", "2 as h1", "'x' as site", "3 as n", "0 as rep", "1 as pos", "5 as copies", "array(1) as bands", "2 as size", "7 as target")


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")
