import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for path in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if path not in sys.path:
        sys.path.insert(0, path)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loanlake.session import ensure_checkpoint_dir, get_session
    s = get_session("local[4]", 4, app_name="loanlake-tests")
    ensure_checkpoint_dir(s)
    return s
