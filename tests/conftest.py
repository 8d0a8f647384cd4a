import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from lakemart.schemas import FEEDS  # noqa: E402
from lakemart.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="lakemart-tests",
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def raw(spark, feed, rows):
    """Raw text rows of ``feed`` (``_c0.._cN``), as the CSV scan yields them."""
    return spark.createDataFrame(rows, FEEDS[feed].raw_schema())
