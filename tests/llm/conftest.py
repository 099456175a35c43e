import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tidelog.llm.common import ready

    ready(spark)


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="session")
def compare():
    return tuples
