from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave import schemas as S  # noqa: E402
from tripweave.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=8, app="tripweave-tests")
    checkpoint_dir(s, fallback=lambda: tempfile.mkdtemp(prefix="tripweave-test-ckpt-"))
    yield s


@pytest.fixture
def landing(spark):
    """Build a landing DataFrame from (id, user, tipo, payload) tuples.

    ``payload`` may be a Python object (serialised with json.dumps) or raw
    text (used as is, for malformed input).
    """
    def make(rows):
        data = []
        for r in rows:
            rid, user, tipo, payload = r[:4]
            text = payload if isinstance(payload, str) else json.dumps(payload)
            created = r[4] if len(r) > 4 else dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=rid)
            data.append((rid, user, tipo, text, created, "1.2.3"))
        return spark.createDataFrame(data, S.LANDING)
    return make
