import pytest

from caretide.session import build_session, clear_scratch


@pytest.fixture(scope="session")
def spark():
    session = build_session("8", "caretide-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()
