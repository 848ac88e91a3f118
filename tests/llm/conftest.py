import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from churnlens.session import get_spark
    yield get_spark("local[4]", shuffle_partitions=8)


LONG = "word another thing of the and passage number ".replace(" ", "  ") * 400
PASSAGE = "this passage of more than fifty bytes stands in several of the documents here, word by word"
#: Nulls in every column, empty and very long texts, repeated rows and ids, ties.
ODD = [
    (1, "Hello  world, the same text of it", "en", "a", 1),
    (2, "Hello world,\tthe same text of it", "en", "a", 2),
    (2, "Hello world,\tthe same text of it", "en", "a", 2),
    (3, None, None, None, None),
    (4, "", "en", None, 0),
    (5, " \n\t ", None, "b", 0),
    (6, LONG, "en", "a", 3),
    (7, LONG + "end", "en", "a", 3),
    (None, "a row without an id " + PASSAGE, "en", "c", 4),
    (None, None, None, None, None),
    (8, "ein anderes " + PASSAGE + " und Ende", "de", "c", 4),
    (9, "zéro " + PASSAGE + " fin 日本語 🎉", "fr", "c", 4),
    (9, "the id again with another text " + PASSAGE, "fr", "d", 4),
    (10, PASSAGE, "en", "d", 4),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clash(odd):
    """The same rows with columns named like internal ones."""
    from pyspark.sql import functions as F
    names = ["key", "digest", "__digest", "__kept", "kept", "fp", "bucket", "words", "rate", "copies", "ids", "__ids", "spans", "n", "__row_key", "__salt", "DIGEST_"]
    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
