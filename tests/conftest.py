import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cuespark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a small test result ordered by its key columns."""
    return [tuple(r) for r in df.select(*cols).orderBy(*cols[:2]).collect()]
