import pytest
from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    from pagewright.session import configure

    spark = (SparkSession.builder.master("local[8]").appName("pagewright-tests")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    return make_session()
