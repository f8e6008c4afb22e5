import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from conftest_llm import frame, words  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rng = random.Random(3)
    long_text = " ".join(words(rng, 30_000))
    rows = [
        (1, "one two three four five six"),
        (1, "one two three four five six"),
        (2, None),
        (3, ""),
        (4, " \t\n\n "),
        (None, "one two three four five six"),
        (None, None),
        (5, long_text),
        (6, "Ünï códe \U0001f600 text\nwith lines"),
        (1, "another text of the same id"),
    ]
    return (
        frame(spark, rows)
        .withColumn("score", F.lit("clash"))
        .withColumn("n_lines", F.lit(7))
        .withColumn("items", F.lit(None).cast("string"))
        .withColumn("kept", F.lit(False))
        .withColumn("predicted", F.lit(1.5))
        .withColumn("label", F.lit(0))
        .withColumn("n_words", F.array(F.lit(1)))
        .withColumn("c0", F.lit("c"))
        .withColumn("row", F.struct(F.lit(1).alias("x")))
        .withColumn("sp ace.d", F.lit(1))
    )
