import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from letrado.session import build_session
    s = build_session("local[4]", 4, app_name="letrado-tests",
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="letrado-test-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="letrado-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="letrado-test-")


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
