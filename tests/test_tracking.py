"""The tracking table's commits."""

import threading

import pytest

from assayer.sources import CommitConflict, CommittedTable, compact_runs, log_runs, read_runs
from assayer.sources import tracking


def log(spark, path, runs, value):
    rows = [(f"e{r % 3}", f"run-{r}", value) for r in runs]
    frame = spark.createDataFrame(rows, "experiment string, run_id string, value double")
    log_runs(frame.selectExpr("experiment", "run_id", "named_struct('a', value) AS p"), frame, path)


def state(spark, path, version=None):
    rows = read_runs(spark, path, version).where("kind = 'metric'").collect()
    found = {(r["experiment"], r["run_id"]): r["number"] for r in rows}
    assert len(found) == len(rows)
    return {int(run.removeprefix("run-")): number for (_, run), number in found.items()}


def test_writers_at_once_all_land(spark, tmp_path):
    path, errors = str(tmp_path / "t"), []

    def write(i):
        try:
            log(spark, path, range(10 * i, 10 * i + 10), float(i))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert state(spark, path) == {r: float(r // 10) for r in range(60)}
    assert CommittedTable(spark, path).last().version == 6


def test_a_slower_writer_commits_on_what_is_there(spark, tmp_path):
    table, calls = CommittedTable(spark, str(tmp_path / "t")), []

    def slow(base):
        calls.append(base.version)
        if len(calls) == 1:  # another writer comes between
            table.commit(lambda b: {**b.folders, "data/other": None})
        return {**base.folders, "data/own": None}

    table.commit(slow)
    assert calls == [0, 1] and table.last().folders == {"data/other": 1, "data/own": 2}


def test_a_failed_write_is_invisible(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    log(spark, path, range(5), 1.0)
    monkeypatch.setattr(CommittedTable, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        log(spark, path, range(10), 2.0)
    monkeypatch.undo()
    assert state(spark, path) == {r: 1.0 for r in range(5)}
    assert CommittedTable(spark, path).remove_unlisted(older_than_seconds=-1) == 1
    assert state(spark, path) == {r: 1.0 for r in range(5)}


def test_compaction_drops_replaced_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    log(spark, path, range(20), 1.0)
    log(spark, path, range(10, 30), 2.0)
    expected = {r: 2.0 if r >= 10 else 1.0 for r in range(30)}
    assert state(spark, path) == expected and state(spark, path, 1) == {r: 1.0 for r in range(20)}
    compact_runs(spark, path)
    table = CommittedTable(spark, path)
    assert state(spark, path) == expected and len(table.last().folders) == 1
    assert table.remove_unlisted(older_than_seconds=-1) == 2
    assert tracking._rows(table, table.last()).where("kind = 'metric'").count() == 30
    log(spark, path, [0, 40], 3.0)
    assert state(spark, path) == {**expected, 0: 3.0, 40: 3.0}


def test_compaction_keeps_commits_made_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    log(spark, path, range(4), 1.0)
    log(spark, path, range(2), 2.0)
    write = tracking._write

    def and_another(rows, table):
        folder = write(rows, table)
        monkeypatch.setattr(tracking, "_write", write)
        log(spark, path, [0, 9], 3.0)
        return folder

    monkeypatch.setattr(tracking, "_write", and_another)
    compact_runs(spark, path)
    assert state(spark, path) == {0: 3.0, 1: 2.0, 2: 1.0, 3: 1.0, 9: 3.0}

    def and_a_compaction(rows, table):
        folder = write(rows, table)
        monkeypatch.setattr(tracking, "_write", write)
        compact_runs(spark, path)
        return folder

    monkeypatch.setattr(tracking, "_write", and_a_compaction)
    with pytest.raises(CommitConflict):
        compact_runs(spark, path)
    assert state(spark, path) == {0: 3.0, 1: 2.0, 2: 1.0, 3: 1.0, 9: 3.0}


def test_empty_table_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_runs(spark, path).count() == 0
    frame = spark.createDataFrame([(None, None, 1.0)], "experiment string, run_id string, value double")
    for _ in range(2):
        log_runs(frame.selectExpr("experiment", "run_id", "'x' AS p"), frame, path)
    compact_runs(spark, path)
    assert [r["number"] for r in read_runs(spark, path).collect() if r["kind"] == "metric"] == [1.0]


def test_a_rename_fails_where_the_version_exists(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    at = [spark._jvm.org.apache.hadoop.fs.Path(str(tmp_path / name)) for name in ("a", "b", "to")]
    for path in at[:2]:
        table._fs.create(path, False).close()
    assert table._rename(at[0], at[2]) and not table._rename(at[1], at[2])
    assert (tmp_path / "b").exists() and not (tmp_path / "a").exists()
