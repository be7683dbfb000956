import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from fundlens.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "fundlens-tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with clashing names."""
    rows = [
        (1, None, None, None, 0, "x"), (2, "", "en", "a", 0, "x"), (3, "Hello's  world\n\n x", "en", "a", 0, None),
        (3, "Hello's  world\n\n x", "en", "a", 0, None), (None, "null id", None, "b", 0, "x"),
        (4, "word " * 60_000, "en", None, 0, "x"), (5, "z" * 5_000, "de", "b", 0, "x"),
        (6, "tab\tnew\x0bline\x85nbsp\xa0 　 ½ ² é ñ 中文 \U0001f600 \U00010940", "fr", "c", 0, "x"),
        (7, "<|endoftext|> a<|endoftext|>  <|endo", "es", "c", 0, "x"), (8, "...!!! ###  \n", None, "c", 0, "x"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string"
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "size AS n_tokens", "size AS word", "size AS TEXT", "size AS Doc_Id")
