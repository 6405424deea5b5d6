import duckdb
import pytest

from conftest import SF0001  # noqa: F401


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the smallest driver table."""
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF0001}/documents.parquet') ORDER BY doc_id").fetchall()


#: Rows every operator has to take: nulls, empty and odd texts, repeated rows, a very long text.
ODD = [(None, None), (None, "no id here\nbut text"), (1, ""), (2, None), (3, " \t\n "), (4, "one"), (4, "one"), (5, "two words"),
       (6, "a  b \n\n\n c▁d "), (7, "café café 中文 \U0001f600 <|endoftext|> <s> x\x1cy it's WE'LL İ"),
       (8, "long words in a very long text . " * 30000), (9, "same three\nlines here\nagain\n" * 4)]
ODD_SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
