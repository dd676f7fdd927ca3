import pytest

from smslens.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "1000")  # plans are read in tests; late in a run their names have more digits
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
