import pytest

from vetline.llm.frames import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)
