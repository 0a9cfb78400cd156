import pytest

from carelake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app="tests", **{
        "spark__sql__shuffle__partitions": "4", "spark__driver__memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from carelake.catalog.bindings import Tables

    return Tables(spark, "/root/testdata/sf0.001")
