import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")
RAW = os.path.join(FIXTURES, "raw")


@pytest.fixture(scope="session")
def spark():
    from indistar.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="indistar-tests", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s
    s.stop()


def raw(name_glob: str) -> str:
    return os.path.join(RAW, name_glob)
