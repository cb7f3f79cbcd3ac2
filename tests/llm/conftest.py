import pytest

from termtide.llm.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
