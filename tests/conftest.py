import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from caseflow.session import build_session
    s = build_session("local[4]", 4, "caseflow-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cf-ckpt-")})
    yield s
    s.stop()
