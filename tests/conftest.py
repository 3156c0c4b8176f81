import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.session import get_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 4, app="panelkit-tests",
                  extra={"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    from panelkit.session import checkpoint_dir
    checkpoint_dir(s)  # a scratch folder only when the setting is absent
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="panelkit-test-")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
