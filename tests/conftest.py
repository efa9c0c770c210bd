import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from perennial import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "perennial-tests",
        "local[*]",
        {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


SONG_COLUMNS = "title string, artist string, genre string, year int, popularity int"


@pytest.fixture
def make_songs(spark):
    def make(rows, columns=SONG_COLUMNS):
        return spark.createDataFrame(rows, columns)

    return make
