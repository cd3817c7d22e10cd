import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from ledgerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="4", shuffle_partitions=4, app="ledgerloom-llm-tests")


#: Nulls in every column, empty and one-character texts, ties, repeated rows, and columns named like results.
EDGE = [
    (1, "a b c d e f g " * 20, "s1"), (1, "a b c d e f g " * 20, "s1"), (2, "a b c d e f g " * 20, None), (3, None, "s1"),
    (4, "", "s2"), (5, " \n\t ", "s2"), (None, "x y", "s2"), (None, None, None), (6, "é" * 70, "s1"),
    (7, "one two three four five six seven " * 3000, "s3"), (8, "<|endoftext|> 中文 😀", "s3"), (9, "a", "s3"),
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, s, 1, 2, True, "z") for i, t, s in EDGE]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_bytes long, n_tokens long, kept boolean, fingerprint string"
    )


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
