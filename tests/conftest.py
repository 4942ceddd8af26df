import logging

import pytest

from postlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    logging.getLogger("DataFrameQueryContextLogger").setLevel(logging.CRITICAL)
    session = local_session(name="postlens-tests")
    yield session
    session.stop()
