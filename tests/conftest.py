import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from feedmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # A setting of the context: it has to be there when the session is built.
    return local_session("4", 4, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="feedmill-")})


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
