import pytest

import oracle_check


@pytest.fixture(scope="session")
def spark():
    s = oracle_check.session(4)
    yield s
    s.stop()
