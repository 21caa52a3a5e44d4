import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()


@pytest.fixture
def result(spark):
    """Result of a registered query over the smallest tables."""
    from tabsync.llm.queries import QUERIES
    return lambda name: QUERIES[name](spark, SMALL).toPandas()


#: Texts that every operator has to bear: null, empty, one word, white space, repeated rows, not ASCII, a very long one.
ODD = [(1, None), (2, ""), (3, "word"), (4, " \n\t "), (5, "same text here now again"), (5, "same text here now again"), (None, "no id at all"),
       (6, "Ünï çödé ﬁ 　 中文字 😀"), (7, "long words " * 20_000), (8, "a" * 5_000)]


@pytest.fixture
def odd(spark):
    """The texts above with columns whose names operators use themselves."""
    rows = [(i, t, "x", 1, b"z", "en") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, shard string, ids int, key binary, lang string")


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")
