import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from driftlens.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
