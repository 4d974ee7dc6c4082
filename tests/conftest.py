import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakestrata.session import build_session
    s = build_session("local[4]", app="lakestrata-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.ui.enabled": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ls-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ls-test-")


def rows(df, *cols):
    """Collect a small test frame as sorted tuples."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    try:
        return sorted(out, key=lambda r: tuple((v is None, v) for v in r))
    except TypeError:
        return sorted(out, key=repr)
