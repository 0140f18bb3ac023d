import pytest

from geoloom import session


@pytest.fixture(scope="session")
def spark():
    s = session.build("local[4]", 8, app="tests", **{"spark__driver__memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
