import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clickloom import schemas
from clickloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shuffle_only(spark):
    """Call it to keep Spark from choosing broadcast joins for the rest of a test."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    yield lambda: spark.conf.set(key, "-1")
    spark.conf.unset(key)


DEFAULTS = {
    "date": "2024-03-01",
    "user_id": 1,
    "session_id": "s",
    "page_id": 1,
    "action_time": "2024-03-01 10:00:00",
}


@pytest.fixture(scope="session")
def make_actions(spark):
    """Typed actions from dicts; fields left out are NULL or a default."""
    from clickloom.sources.tables import typed_actions

    names = [part.split()[0] for part in schemas.ACTION_TEXT.split(", ")]

    def make(*rows: dict):
        data = [tuple({**DEFAULTS, **row}.get(name) for name in names) for row in rows]
        return typed_actions(spark.createDataFrame(data, schemas.ACTION_TEXT))

    return make


@pytest.fixture(scope="session")
def make_users(spark):
    def make(*rows: tuple):
        data = [(i, f"u{i}", f"n{i}", age, job, city, sex) for i, age, job, city, sex in rows]
        return spark.createDataFrame(data, schemas.USER_INFO)

    return make
