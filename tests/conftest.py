import pytest
from pyspark.sql import SparkSession

from yearwheel.operators.staging import Staging
from yearwheel.session import configured


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = configured(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def stage(spark, tmp_path):
    return Staging(spark, str(tmp_path / "stage"))


@pytest.fixture
def table(spark):
    """Small table from rows; the schema is a DDL string."""

    def make(schema, rows):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def read(df, *columns):
        got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(got, key=lambda r: [(v is not None, str(type(v)), v) for v in r])

    return read


@pytest.fixture
def plan():
    """Physical plan as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


