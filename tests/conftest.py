import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitscope.session import checkpoint_dir, local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app_name="visitscope-tests",
                            warehouse_dir=tempfile.mkdtemp(prefix="visitscope-warehouse-"))
    # Tests only: fall back to a private folder when the cluster names none.
    checkpoint_dir(session, fallback=tempfile.mkdtemp(prefix="visitscope-ckpt-"))
    yield session
    session.stop()
