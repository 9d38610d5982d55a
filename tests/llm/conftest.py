import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

os.environ["TOKENIZERS_PARALLELISM"] = "false"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """The documents of the smallest tables as a list of (doc_id, text)."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, ties and columns with clashing names."""
    rows = [
        (1, "alpha beta " * 3000, "en", "x", 1),
        (2, None, None, None, None),
        (3, "", "en", "x", 1),
        (4, "  \n ", "en", "x", 1),
        (None, "word", "en", "x", 1),
        (5, "Ünïcode TEXT ñandú — ж 中文", "es", "x", 1),
        (6, "same text twice over and over again in here ok", "en", "x", 1),
        (6, "same text twice over and over again in here ok", "en", "x", 1),
        (7, "same text twice over and over again in here ok", "en", "x", 1),
        (None, None, "en", "x", 1),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string, n_words int")


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
