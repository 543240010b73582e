import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from statweave.session import get_session
    s = get_session("local[4]", app="statweave-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sw-test-ckpt-")})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
