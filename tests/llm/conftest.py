import duckdb
import pytest

from kabuto.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 4, app="kabuto-llm-tests")
    yield s


@pytest.fixture(scope="session")
def texts():
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


#: Null, empty and odd texts, repeated ids and rows, a long text.
ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one two"),
    (4, "one two"),
    (5, "ONE two"),
    (None, "one two three four five six seven"),
    (6, "word " * 40_000),
    (7, "\U0001f600 caf\u00e9 \u2581x \x00 <s> <|im_end|> \u00a0"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD as documents, with extra columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1, "y") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, `key` string")
