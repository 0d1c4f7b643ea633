import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")
