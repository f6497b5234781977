import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from eventloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(8, "eventloom-tests", **{"spark.checkpoint.dir": folder, "spark.driver.memory": "6g"})
    yield session
    session.stop()


EVENT_COLUMNS = "id BIGINT, title STRING, description STRING, date STRING, time STRING, location STRING, link STRING"


@pytest.fixture(scope="session")
def make_events(spark):
    def build(*rows):
        """Rows of (title, date, time, location[, description[, link]]), numbered from 1."""
        full = []
        for i, row in enumerate(rows, 1):
            title, date, time, location, *rest = row
            description = rest[0] if rest else None
            link = rest[1] if len(rest) > 1 else f"https://campus.example.edu/event/{i}"
            full.append((i, title, description, date, time, location, link))
        return spark.createDataFrame(full, EVENT_COLUMNS)

    return build
