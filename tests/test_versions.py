"""Tables with versions: writes that are one step for a reader, earlier versions, writers at once."""

import time

import pytest
from pyspark.sql import functions as F

from meltemi.operators import sinks
from meltemi.sources import snapshots, tables
from tests.conftest import rows_of

DDL = "partition_date string, v int"


@pytest.fixture()
def days(frame):
    return lambda *rows: frame(DDL, [(f"2024-01-{d:02d}", v) for d, v in rows])


def content(spark, path, version=None):
    return rows_of(tables.read_table(spark, path, version=version).withColumn("d", F.substring("partition_date", 9, 2).cast("int")), "d", "v")


def lost(*_):
    raise RuntimeError("driver lost")


STEPS = ["staging", "version file", "rename", "after the rename"]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_refresh_killed_at_any_step_leaves_the_old_table_or_the_new(spark, days, tmp_path, monkeypatch, step, plain):
    path = str(tmp_path / "t")
    first = days((1, 1), (2, 1), (3, 1))
    sinks.append(first, path, sinks.DAY) if plain else sinks.overwrite(first, path)
    old, new = [(1, 1), (2, 1), (3, 1)], [(1, 2), (3, 2)]
    put = sinks.put_version
    with monkeypatch.context() as m:
        if step == "staging":
            m.setattr(sinks, "_folders", lost)
        elif step == "version file":
            m.setattr(sinks, "put_version", lost)
        elif step == "rename":
            m.setattr(snapshots, "version_path", lambda *_: lost())
        else:
            m.setattr(sinks, "put_version", lambda *a: (put(*a), lost()))
        with pytest.raises(RuntimeError, match="driver lost"):
            sinks.replace_range(days((1, 2), (3, 2)), path, "2024-01-01", "2024-01-03")
    assert content(spark, path) == (new if step == "after the rename" else old)
    sinks.replace_range(days((1, 2), (3, 2)), path, "2024-01-01", "2024-01-03")
    assert content(spark, path) == new


def test_a_plain_table_becomes_one_with_versions(spark, days, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(days((1, 1), (2, 1)), path, sinks.DAY)
    assert snapshots.versions(spark, path) == []
    sinks.replace_range(days((2, 5)), path, "2024-01-02", "2024-01-02")
    sinks.append(days((1, 7), (4, 7)), path, sinks.DAY)
    assert content(spark, path) == [(1, 1), (1, 7), (2, 5), (4, 7)] and content(spark, path, 1) == [(1, 1), (2, 5)]
    assert sinks.list_partitions(spark, path) == [f"partition_date=2024-01-0{d}" for d in (1, 2, 4)]
    got = tables.read_days(spark, path, ["partition_date=2024-01-01"], DDL)
    assert rows_of(got, "v") == [(1,), (7,)] and len(got.inputFiles()) == 2


def test_earlier_versions_are_read_and_restored(spark, days, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(days((1, 1), (2, 1)), path)
    sinks.replace_partitions(days((2, 2), (3, 2)), path, sinks.DAY)
    sinks.overwrite(days(), path)
    assert content(spark, path) == [] and content(spark, path, 2) == [(1, 1), (2, 2), (3, 2)] and content(spark, path, 1) == [(1, 1), (2, 1)]
    assert sinks.restore(spark, path, 2).number == 4
    assert content(spark, path) == [(1, 1), (2, 2), (3, 2)]
    history = [tuple(r) for r in snapshots.history(spark, path).drop("written_at").orderBy("version").collect()]
    assert history == [(1, "overwrite", 2, 2, 2, 0), (2, "replace partitions", 2, 3, 2, 0), (3, "overwrite", 0, 0, 0, 3), (4, "restore 2", 0, 3, 3, 0)]
    with pytest.raises(snapshots.NoVersion):
        tables.read_table(spark, path, version=9)


def test_a_refresh_reads_and_writes_its_range_only(spark, days, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(days(*[(d, 1) for d in range(1, 20)]), path)
    before = snapshots.version(spark, path).partitions
    sinks.replace_range(days((18, 2)), path, "2024-01-18", None)
    after = snapshots.version(spark, path).partitions
    assert {p for p in before if after.get(p) != before[p]} == {"partition_date=2024-01-18", "partition_date=2024-01-19"}


def test_of_two_writers_one_waits_or_fails(spark, days, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.overwrite(days((1, 1), (2, 1), (3, 1)), path)
    stage = sinks.stage

    def while_staging(other):
        def run(*args):
            monkeypatch.setattr(sinks, "stage", stage)
            other()
            return stage(*args)

        monkeypatch.setattr(sinks, "stage", run)

    # Different partitions: both come through.
    while_staging(lambda: sinks.replace_range(days((1, 5)), path, "2024-01-01", "2024-01-01"))
    sinks.replace_range(days((2, 6)), path, "2024-01-02", "2024-01-02")
    assert content(spark, path) == [(1, 5), (2, 6), (3, 1)]
    # The same partition: the second leaves the table to the first.
    while_staging(lambda: sinks.replace_range(days((3, 7)), path, "2024-01-03", "2024-01-03"))
    with pytest.raises(sinks.CommitConflict):
        sinks.replace_range(days((3, 8)), path, "2024-01-03", "2024-01-03")
    assert content(spark, path) == [(1, 5), (2, 6), (3, 7)]
    # Appends never clash.
    while_staging(lambda: sinks.append(days((3, 9)), path, sinks.DAY))
    sinks.append(days((3, 10)), path, sinks.DAY)
    assert content(spark, path) == [(1, 5), (2, 6), (3, 7), (3, 9), (3, 10)]


def test_a_taken_number_is_not_written_over(spark, days, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(days((1, 1)), path)
    taken = snapshots.version(spark, path)
    assert not sinks.put_version(spark, path, snapshots.Version(1, "late", "now", 0, {}))
    assert snapshots.version(spark, path) == taken
    assert len(list((tmp_path / "t" / "_versions").glob("*.json"))) == 1


def test_clean_up_drops_what_no_kept_version_names(spark, days, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for k in range(4):
        sinks.replace_partitions(days((1, k), (k + 2, k)), path, sinks.DAY)
    with monkeypatch.context() as m:
        m.setattr(sinks, "put_version", lost)
        with pytest.raises(RuntimeError):
            sinks.overwrite(days((9, 9)), path)
    assert sinks.clean_up(spark, path, keep=2) == {"versions": 2, "folders": 0}  # all folders are young
    time.sleep(1.1)
    assert sinks.clean_up(spark, path, keep=2, idle_hours=0)["folders"] == 3  # two old days, one never published
    assert content(spark, path) == [(1, 3), (2, 0), (3, 1), (4, 2), (5, 3)] and content(spark, path, 3) == [(1, 2), (2, 0), (3, 1), (4, 2)]
    with pytest.raises(snapshots.NoVersion):
        tables.read_table(spark, path, version=1)
