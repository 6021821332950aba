import pytest

from quipu.llm.tables import ship


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship(spark)
