"""Helpers of the tests in this folder."""

import os
import random

import pytest

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")

SYLLABLES = ["ka", "lo", "mi", "ru", "sen", "tor", "ve", "wi", "xa", "yon"]


def words(rng, count):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(count)]


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def collected(result):
    return sorted(map(tuple, result.collect()), key=repr)
