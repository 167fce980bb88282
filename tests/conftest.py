import pytest

from ledgerloom.session import spark_session
from ledgerloom.sources.workspace import Workspace


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def workspace(spark):
    return Workspace(spark)


@pytest.fixture
def frame(spark):
    """Frame from rows of text and a ``name type`` schema; cells are cast, ``None`` stays missing."""
    from ledgerloom.functions.columns import literal_frame

    def build(schema: str, *rows):
        columns = [tuple(c.strip().split(" ", 1)) for c in schema.split(";")]
        return literal_frame(spark, list(rows), columns)
    return build


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
