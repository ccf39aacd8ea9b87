import os

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables are not here")
    return FOLDER


@pytest.fixture(scope="session")
def texts(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, source) rows, with extra columns of clashing names."""

    def make(rows, parts=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, class string, size int"
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), True, 7.0, "c", 1) for r in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


#: Nulls, empty and blank texts, repeated rows, one long word, one long text.
ODD = [(None, "a b c d e f g"), (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (4, "one two"), (5, "x" * 5000), (6, "word " * 30000), (7, "Ünïcode ñandú — “quoted” gap")]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
