import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panel_edit.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("panel_edit_tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: a private checkpoint folder when the session names none.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="panel-edit-ckpt-", dir="/tmp"))
    yield s


def rows(df, *cols, order=None):
    """Collect ``cols`` as tuples sorted by ``order`` (default: all columns)."""
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))
