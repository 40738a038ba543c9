import os

import pytest
from landed import rows

import landfall.sinks.versions as module
from landfall.sinks.versions import AuditFailed, VersionConflict, current, publish, read_version, restore, vacuum, verify, versions


def frame(spark, *values):
    return spark.createDataFrame([(v, str(v)) for v in values], "n int, `odd name` string")


def test_versions_follow_each_other(spark, folder):
    path = f"{folder}/t"
    assert current(spark, path) is None and versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    first = publish(frame(spark, 1, 2), path, note="first")
    held = read_version(spark, path)
    second = publish(frame(spark, 3), path, fmt="orc")
    assert (first.number, first.rows, second.number, second.rows) == (1, 2, 2, 1)
    assert rows(read_version(spark, path)) == [(3, "3")]
    assert rows(held) == rows(read_version(spark, path, 1)) == [(1, "1"), (2, "2")]
    assert [v.note for v in versions(spark, path)] == ["first", ""]
    assert restore(spark, path, 1).number == 3
    assert rows(read_version(spark, path)) == [(1, "1"), (2, "2")]


class Broken(RuntimeError):
    pass


def broken(*args, **kwargs):
    raise Broken


@pytest.mark.parametrize("step", ["write_layer", "digest", "audit", "write_text", "rename"])
def test_a_failure_at_any_step_leaves_the_old_version(spark, folder, monkeypatch, step):
    path = f"{folder}/t"
    publish(frame(spark, 1, 2), path)
    with monkeypatch.context() as patch:
        if step != "audit":
            patch.setattr(module, step, broken)
        with pytest.raises(Broken):
            publish(frame(spark, 9), path, audit=broken if step == "audit" else None)
    assert rows(read_version(spark, path)) == [(1, "1"), (2, "2")]
    verify(spark, path)
    assert publish(frame(spark, 5), path).number == 2
    vacuum(spark, path)
    assert rows(read_version(spark, path)) == [(5, "5")]
    assert len(os.listdir(f"{path}/data")) == 1 and [v.number for v in versions(spark, path)] == [2]


def test_a_failing_task_leaves_the_old_version(spark, folder):
    path = f"{folder}/t"
    publish(frame(spark, 1), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish(frame(spark, 1, 0).selectExpr("1 div n as n"), path)
    assert rows(read_version(spark, path)) == [(1, "1")]


def test_of_two_writers_one_wins(spark, folder, monkeypatch):
    path = f"{folder}/t"
    publish(frame(spark, 1), path)
    with pytest.raises(VersionConflict):
        publish(frame(spark, 2), path, base=0)
    with pytest.raises(VersionConflict):  # the other publishes while this one writes
        publish(frame(spark, 2), path, audit=lambda df: publish(frame(spark, 3), path))
    assert rows(read_version(spark, path)) == [(3, "3")]
    assert len(os.listdir(f"{path}/versions")) == len([n for n in os.listdir(f"{path}/versions") if not n.startswith("draft")])


def test_changed_files_are_noticed(spark, folder):
    path = f"{folder}/t"
    made = publish(frame(spark, 1, 2), path)
    frame(spark, 1, 3).write.mode("overwrite").parquet(f"{path}/{made.data}")
    with pytest.raises(AuditFailed):
        verify(spark, path)


def test_empty_tables_and_vacuum(spark, folder):
    path = f"{folder}/t"
    assert publish(frame(spark, 1).where("n > 1"), path).rows == 0
    assert rows(read_version(spark, path)) == []
    verify(spark, path)
    for n in range(3):
        publish(frame(spark, n), path)
    vacuum(spark, path, keep=2)
    assert [v.number for v in versions(spark, path)] == [3, 4]
    assert rows(read_version(spark, path, 3)) == [(1, "1")]
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, 1)
    with pytest.raises(ValueError):
        vacuum(spark, path, keep=0)
