import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from orderlake.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="orderlake-tests")
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
