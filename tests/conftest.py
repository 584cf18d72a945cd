import pytest

from vellum.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("OFF")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one expression over a list of texts, in order."""
    from pyspark.sql import functions as F

    def run(expression, texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r[0] for r in rows.orderBy("i").select(expression(F.col("x")).alias("v")).collect()]

    return run
