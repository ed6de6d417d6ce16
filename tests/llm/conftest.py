import pytest

from logsift.llm.common import ship


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)
