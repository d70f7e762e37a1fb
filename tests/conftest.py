import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
sys.path.insert(0, str(HERE))

from tablecraft.session import GROUP_ROWS_KEY, local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Groups above 40 rows are split, as they would be on large data."""
    spark.conf.set(GROUP_ROWS_KEY, "40")
    yield
    spark.conf.unset(GROUP_ROWS_KEY)


@pytest.fixture(scope="session")
def data():
    return DATA
