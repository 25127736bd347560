import pytest

from tastegrid.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column function to a list of texts (or numbers) and give the results in order."""
    def run(f, items, kind="string"):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
        from pyspark.sql import functions as F

        return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]

    return run
