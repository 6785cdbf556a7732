from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from roadpulse.schemas import VEHICLE_EVENT  # noqa: E402
from roadpulse.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MIDDAY = datetime(2024, 1, 3, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    return MIDDAY + timedelta(microseconds=round(seconds * 1_000_000))


@pytest.fixture
def events_of(spark):
    """Events from (event_id, vehicle, seconds, route, type, lat, lon) tuples;
    later fields may be left out."""

    def build(rows):
        full = []
        for row in rows:
            event_id, vehicle, seconds, *rest = row
            route, kind, lat, lon = (list(rest) + ["Route-37", "Bus", 53.0, -7.0][len(rest):])[:4]
            full.append((event_id, vehicle, kind, route, lat, lon, at(seconds), 50.0, 20.0))
        schema = "event_id bigint, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in VEHICLE_EVENT.fields
        )
        return spark.createDataFrame(full, schema)

    return build
