import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from foldline.session import ensure_checkpoint_dir, local_session
    s = local_session("*", 8, app="foldline-tests")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF
