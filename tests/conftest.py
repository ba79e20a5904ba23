import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row."""

    def run(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return run


@pytest.fixture
def rows(spark):
    def run(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)

    return run
