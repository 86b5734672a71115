import pytest
from llm_helpers import SF, wide


@pytest.fixture
def docs(spark):
    def make(*rows):
        return wide(spark.createDataFrame([*rows], "doc_id long, text string")).repartition(3)
    return make


@pytest.fixture(scope="session")
def load(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
