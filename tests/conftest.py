import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelspark.session import build_session
    s = build_session("local[*]", 8, app_name="panelspark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx():
    return FIXTURES
