import pytest

from daytally.settings import build_session, pin_time_zone


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="2000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield pin_time_zone(session)
    session.stop()


@pytest.fixture
def lines(spark):
    def make(*texts):
        return spark.createDataFrame([(text,) for text in texts], "value string")

    return make


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())
