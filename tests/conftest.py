import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quaywise import schemas  # noqa: E402
from quaywise.session import build_session, scratch_path  # noqa: E402
from quaywise.sources.tables import Tables  # noqa: E402

NOW = datetime(2024, 1, 15, 12, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "quaywise-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    """An empty warehouse in a folder of its own."""
    return Tables(spark, scratch_path(spark, "test"))


@pytest.fixture
def folder(spark):
    return lambda name: scratch_path(spark, name)


def trip(trip_id, departure, arrival, **other):
    row = {
        "trip_id": trip_id, "train": "7001", "origin_name": "A", "departure_time": departure,
        "dest_name": "C", "arrival_time": arrival, "vehicule_category": "MODE::RER A",
        "vehicule_mode": "RAIL", "published_line_name": "Ligne 1",
        "production_date": datetime(2024, 1, 15, 11),
    }
    return {**row, **other}


def stop(trip_id, index, name, arrival="", departure="", late=0, **other):
    """A stop ``late`` minutes late; times are the planned ones."""
    def moved(text):
        if not text:
            return ""
        from datetime import timedelta
        planned = datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        return str(planned + timedelta(minutes=late))

    row = {
        "trip_id": trip_id, "call_index": index, "stop_name": name,
        "aimed_arrival": arrival, "expected_arrival": moved(arrival),
        "aimed_departure": departure, "expected_departure": moved(departure),
        "is_starting_point": int(index == 0), "is_terminus": int(departure == ""),
        "departure_platform_name": "1", "arrival_platform_name": "1",
        "production_date": datetime(2024, 1, 15, 11),
    }
    return {**row, **other}


def frame(spark, name, rows):
    """Rows (dicts) as a frame with the columns of a stored table."""
    columns = schemas.TABLES[name][0] if name in schemas.TABLES else name
    empty = spark.createDataFrame([], columns)
    return spark.createDataFrame(
        [tuple(row.get(c) for c in empty.columns) for row in rows], empty.schema
    )


def values(rows, *columns):
    """Sorted tuples of the given columns."""
    picked = rows.select(*columns) if columns else rows
    return sorted((tuple(r) for r in picked.collect()), key=str)
