import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tabmine.session import ensure_checkpoint_dir, get_spark

    s = get_spark(master="local[4]", shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
