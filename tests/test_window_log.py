from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from filetrail.plans.pull import run_pull
from filetrail.schemas import WINDOWS
from filetrail.sinks.targets import write_targets
from filetrail.sources import state
from tests.test_pull import SPEC, T0, events, ids


def windows(spark, rows):
    hour = timedelta(hours=1)
    return spark.createDataFrame([(q, T0 + i * hour, T0 + (i + 1) * hour, s) for q, i, s in rows], WINDOWS)


def current(spark, path):
    return sorted(tuple(r) for r in state.load_windows(spark, path).collect())


def log_files(spark, path):
    return state.read_log(spark, path, WINDOWS).inputFiles()


def test_compaction_keeps_the_state_and_bounds_the_files(spark, tmp_path):
    path = str(tmp_path / "log")
    assert state.compact_windows(spark, path) == 0
    for i in range(6):
        state.append_windows(windows(spark, [("a", i, "open"), ("b c/ä", i, "open")]), path)
        state.append_windows(windows(spark, [("a", i, "completed")]), path)
    want, n = current(spark, path), len(log_files(spark, path))
    assert n >= 12 and state.compact_windows(spark, path) == 0
    assert current(spark, path) == want
    state.append_windows(windows(spark, [("b c/ä", 2, "completed")]), path)
    want = current(spark, path)
    assert state.compact_windows(spark, path) == n
    assert current(spark, path) == want and sum(r[3] == "completed" for r in want) == 7
    for _ in range(3):
        state.compact_windows(spark, path)
        assert current(spark, path) == want
    assert len(log_files(spark, path)) <= 4


def test_compaction_survives_a_crash_between_its_steps(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for i in range(4):
        state.append_windows(windows(spark, [("a", i, "open" if i == 3 else "completed")]), path)
    want = current(spark, path)

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(state, "append_windows", dies)
        with pytest.raises(RuntimeError):
            state.compact_windows(spark, path)
    assert current(spark, path) == want
    # the state is written, but what it covers is not listed yet
    state.append_windows(state.load_windows(spark, path), path)
    assert current(spark, path) == want
    for _ in range(3):
        state.compact_windows(spark, path)
        assert current(spark, path) == want
    assert len(log_files(spark, path)) <= 3


def test_pulls_go_on_from_a_compacted_log(spark, tmp_path):
    log, out = str(tmp_path / "s"), str(tmp_path / "o")
    raw = events(spark).repartition(3).cache()
    pulled = 0
    for seconds in (25, 50, 100):
        pulled += run_pull(raw, SPEC, log, lambda df: write_targets(df, out),
                           T0 + timedelta(minutes=15, seconds=seconds), T0)
        state.compact_windows(spark, log)
    assert ids(spark.read.parquet(out)) == [i for i in range(60) if i % 10 != 9]
    assert state.load_windows(spark, log).where(F.col("status") == "completed").count() == pulled


def test_one_run_holds_a_claim(spark, tmp_path):
    log, now = str(tmp_path / "s"), datetime.now(UTC)
    with state.claim(spark, log, "q/1", now):
        with pytest.raises(state.Claimed), state.claim(spark, log, "q/1", now):
            pass
        with state.claim(spark, log, "q/2", now):
            pass
    with pytest.raises(ZeroDivisionError), state.claim(spark, log, "q/1", now):
        raise ZeroDivisionError
    with state.claim(spark, log, "q/1", now):
        # a run that died two hours ago no longer stops others
        with state.claim(spark, log, "q/1", now + timedelta(hours=2)):
            pass
    state.append_windows(windows(spark, [("q", 0, "open")]), log)
    assert state.load_windows(spark, log).count() == 1
