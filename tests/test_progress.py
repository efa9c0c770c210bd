import datetime

import pytest

from perennial.streaming import progress

NOW = datetime.datetime(2024, 1, 1)


def note(run, kind, batch=None, rows=None, name=None, failure=None):
    return (NOW, name, "q", run, kind, batch, rows, None, None, None, None, failure)


def test_states_of_runs(spark):
    rows = [
        note("a", "started", name="songs"), note("a", "batch", 0, 5, "songs"), note("a", "batch", 1, 0, "songs"),
        note("a", "batch", 1, 3, "songs"), note("a", "ended", failure="lost"), note("b", "batch", 2, 4),
    ]
    states = progress.run_states(spark.createDataFrame(rows, progress.PROGRESS)).collect()
    a, b = sorted(states, key=lambda r: r.run_id)
    assert (a.name, a.batches, a.input_rows, a.ended, a.failed, a.failure) == ("songs", 2, 8, True, True, "lost")
    assert (b.name, b.batches, b.input_rows, b.ended, b.failed) == (None, 1, 4, False, False)


def test_rows_are_held_until_there_are_enough(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "log"), every=2)
    log._note("songs", "q", "a", "started")
    assert not (tmp_path / "log").exists()
    log._note("songs", "q", "a", "batch", 0, 7)
    assert progress.progress_rows(spark, str(tmp_path / "log")).count() == 2
    with pytest.raises(TimeoutError):
        log.wait_for_end(["a"], 0.1)
