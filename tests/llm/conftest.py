import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def sf_dir():
    assert os.path.isdir(SF)
    return SF


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows], DOC)
    return make


#: Nulls, empty and blank texts, repeated rows, ties, a long text without blanks and a long one with.
TROUBLE = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"),
           (6, "x" * 20000), (7, "lorem ipsum dolor " * 3000), (8, "one"), (9, "é 日本 <|endoftext|> zz\x1c\x85 q")]


@pytest.fixture(scope="session")
def trouble(make_docs):
    return make_docs(TROUBLE)


@pytest.fixture(scope="session")
def clashing(trouble):
    """The troublesome rows with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F
    names = ["id", "fp", "root", "component_id", "size", "taken", "key", "score", "n_tokens", "words", "h", "_text",
             "text_hash", "s", "bucket", "n_words", "kept", "host", "path", "rule", "y", "block", "_r"]
    return trouble.select("*", *[F.lit("clash").alias(n) for n in names])
