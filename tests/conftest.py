import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkdesk.session import local_session, ship_package

    s = local_session("*", app="sparkdesk-tests")
    ship_package(s)
    yield s
    s.stop()
