"""Rows and fixtures shared by these tests; the session is the suite's own."""

import os
import random
import sys

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"

# names that the operators use inside, as extra columns
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("g", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("norm", T.StringType())])


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "i", "n")


def edge_rows():
    """Nulls, empty, blank, very long, equal, nearly equal and repeated rows."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(300)]
    prose = [" ".join(rnd.choices(words, k=rnd.randint(55, 120))) for _ in range(12)]
    rows = [row(i, p, "en", "ab"[i % 2]) for i, p in enumerate(prose)]
    rows += [row(20, None), row(21, ""), row(22, " \n\t "), row(23, "", None, None), row(24, None, None, None)]
    rows += [row(25, prose[0].replace(" ", "\n")), row(26, prose[0]), row(26, prose[0]), row(27, prose[1].upper())]
    rows += [row(28, prose[2] + " tail"), row(29, "x " + prose[3]), row(30, prose[4][30:] + prose[5][:200])]
    rows += [row(31, " ".join(rnd.choices(words, k=20_000)), "de", "c"), row(32, "ab" * 400), row(33, "é" * 100 + " ü"),
             row(34, "same line\n" * 60), row(35, "one two"), row(None, prose[6]), row(None, "lonely words without an id")]
    return rows


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
