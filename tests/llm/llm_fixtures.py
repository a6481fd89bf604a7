import os

import pytest

SF_DIR = "/root/testdata/sf0.001"

LONG = "word " * 40_000


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("the given tables are not here")
    return SF_DIR


SHAPE = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use inside, or return.
    "score double, bucket int, key string, row long, label string, weight double, n_dropped int, text_key string, kept string"
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, equal ids, clashing columns."""
    more = (0.5, 1, "k", 2, "l", 0.1, 3, "t", "yes")
    rows = [
        (1, "the same text as another one has, word for word", "en", "a", 10, *more),
        (2, "The Same text as another one has, word for word", "en", "a", 10, *more),
        (2, "The Same text as another one has, word for word", "en", "a", 10, *more),
        (3, "", "en", "b", 0, *more),
        (4, None, None, None, None, *([None] * 9)),
        (None, "a text without any number to its name, none at all", "en", None, 5, *more),
        (None, None, None, None, None, *([None] * 9)),
        (5, LONG, "en", "b", 200_000, *more),
        (5, "another text under a number that is taken already", "de", "b", 9, *more),
        (6, "\n\n \n", "fr", "c", 4, *more),
        (7, "😀 ÀÉ İstanbul ſecret ΣΑΣ 你好 мир", None, "c", 20, *more),
        (8, "%%% ### 123 !!!", "en", "c", 15, *more),
    ]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SHAPE)
