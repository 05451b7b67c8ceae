from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listenlake import schemas  # noqa: E402
from listenlake.session import get_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_session(
        "listenlake-tests",
        "local[4]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared / "checkpoints"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


_EVENT = {
    "event_id": "e1",
    "user_id": "u1",
    "song_id": "s1",
    "artist_name": "A",
    "song_name": "S",
    "event_type": "play",
    "device_type": "web",
    "country": "VN",
    "timestamp": "2024-01-07T10:15:00.000000Z",
    "username": "name",
    "age": 20,
    "subscription_type": "free",
    "registration_date": "2022-01-01",
    "genre": "Pop",
    "duration_seconds": 200,
    "release_year": 2020,
    "album_name": "Album",
}


@pytest.fixture(scope="session")
def bronze_of(spark):
    """Bronze rows from partial dicts; ids count up unless given."""

    def make(*changes: dict):
        rows = []
        for i, change in enumerate(changes):
            event = {**_EVENT, "event_id": f"e{i}", **change}
            rows.append(tuple(event[c] for c in schemas.EVENT_COLUMNS))
        return spark.createDataFrame(rows, schemas.EVENT)

    return make


@pytest.fixture(scope="session")
def silver_of(bronze_of):
    from listenlake.operators.silver import silver_events

    return lambda *changes: silver_events(bronze_of(*changes))
