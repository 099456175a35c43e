import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tidelog import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    s = session.build(
        "tidelog-tests", 8,
        **{
            "spark.sql.shuffle.partitions": "4",
            # Many short queries: quick compilation beats optimised code.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
