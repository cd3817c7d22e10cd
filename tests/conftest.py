import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="4", shuffle_partitions=4, app="ledgerloom-tests")


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("test tables are not there")
    return SF_DIR


@pytest.fixture
def ledger(spark):
    """Build a small ledger from (txn_id, consumer_id, category, amount, direction, date) tuples."""

    def build(rows):
        return spark.createDataFrame(
            [(i, c, k, float(a), d, day) for i, c, k, a, d, day in rows],
            "txn_id long, consumer_id long, category string, amount double, credit_or_debit string, posted_date string",
        ).selectExpr(
            "txn_id", "consumer_id", "category", "cast(amount as decimal(18,2)) amount", "credit_or_debit",
            "cast(posted_date as date) posted_date",
        )

    return build
