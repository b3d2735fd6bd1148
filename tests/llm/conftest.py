import pytest

from medallion.llm.common import share_checkout


@pytest.fixture(autouse=True)
def checkout_on_workers(spark):
    share_checkout(spark)
