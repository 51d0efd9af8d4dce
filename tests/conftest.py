import os
import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

from pixeltally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        os.environ.get("TEST_CPUS", "8"), shuffle_partitions=4,
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """The plan as it ran: Spark re-plans while a query runs, so run it first."""
    def plan(df):
        df.toArrow()
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return re.sub(r"#\d+L?", "", text)
    return plan


@pytest.fixture
def settings(spark):
    """Session settings for one test."""
    before = {}

    def change(values):
        for key, value in values.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
