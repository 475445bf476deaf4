from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def awkward(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, columns that clash with helper names."""
    long = "lorem ipsum dolor " * 4000
    rows = [
        (1, "one two three four five"), (2, None), (3, ""), (None, "one two three four five"), (None, None), (4, "   \n\t "),
        (5, long), (5, long), (6, long), (7, "été 漢字 \U0001f600 naïve"), (8, "one two three four five"), (8, "another text of the same id"), (9, "x" * 30000),
    ]
    return spark.createDataFrame([(i, t, "key", 1, 2.0, None, "n") for i, t in rows], "doc_id long, text string, key string, no long, digest double, kind string, component_id string")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, extra string")
