import pytest

from tessera import session


@pytest.fixture(scope="session")
def spark():
    s = session.builder("tests", "local[4]", 4).config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
