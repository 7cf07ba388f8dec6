"""The snapshot log: stopped writes, two writers, versions, left-over files."""

import threading

import pytest
from pyspark.sql import functions as F

from bandwatch.session import work_dir
from bandwatch.sinks import tables
from bandwatch.sinks.log import Conflict, TableLog

KEY = ["id"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "id string, day string, v int")


def put(spark, path, rows, **more):
    return tables.upsert(batch(spark, rows), path, KEY, F.col("day"), **more)


def told(df):
    return sorted((r.id, r.v) for r in df.collect())


class Stopped(Exception):
    pass


@pytest.mark.parametrize("where", ["staged", "written", "committed"])
def test_a_stopped_write_can_be_repeated(spark, where):
    path = work_dir(spark, "t")
    put(spark, path, [("a", "1", 1), ("b", "1", 1), ("c", "2", 1)])
    change = [("a", "1", 2), ("d", "3", 2)]

    def stop(step):
        if step == where:
            raise Stopped

    for _ in range(2):
        with pytest.raises(Stopped):
            put(spark, path, change, step=stop)
        now = told(tables.open_table(spark, path))
        assert now == ([("a", 1), ("b", 1), ("c", 1)] if where != "committed" else [("a", 2), ("b", 1), ("c", 1), ("d", 2)])
    assert told(put(spark, path, change)) == [("a", 2), ("b", 1), ("c", 1), ("d", 2)]


def test_writers_at_once_lose_nothing(spark):
    path = work_dir(spark, "t")
    put(spark, path, [("a", "1", 0)])
    threads = [threading.Thread(target=put, args=(spark, path, [(f"w{i}-{k}", str(k), i) for k in range(3)])) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert told(tables.open_table(spark, path)) == sorted([("a", 0)] + [(f"w{i}-{k}", i) for i in range(4) for k in range(3)])


def test_a_writer_that_comes_second(spark):
    """Another write of the same partition, and one of another partition, slip in between files and entry."""
    for day, again in (("1", 2), ("2", 1)):
        path, seen = work_dir(spark, "t"), []
        put(spark, path, [("a", "1", 0)])

        def meanwhile(step):
            if step == "written":
                if not seen:
                    put(spark, path, [("x", day, 9)])
                seen.append(step)

        out = put(spark, path, [("b", "1", 1)], step=meanwhile)
        assert told(out) == told(tables.open_table(spark, path)) == [("a", 0), ("b", 1), ("x", 9)]
        assert len(seen) == again  # merged again only where it had to


def test_entries_are_taken_once_and_old_states_stay(spark):
    path = work_dir(spark, "t")
    for v in range(25):
        put(spark, path, [("a", "1", v), (f"n{v}", str(v % 3), v)])
    log = TableLog(spark, path)
    state = log.snapshot()
    assert state.version == 24 and log.versions() == list(range(25))
    assert told(log.read(tables.open_table(spark, path).schema, log.snapshot(11)))[0] == ("a", 11)
    with pytest.raises(Conflict):
        log.commit(24, [], [], {}, state)
    assert log.changed_since(20, 24) == {"0", "1", "2"}
    whole = told(tables.open_table(spark, path))
    assert log.vacuum(keep_seconds=3600) == 0
    assert log.vacuum(keep_seconds=-1) > 0 and log.vacuum(keep_seconds=-1) == 0
    assert told(tables.open_table(spark, path)) == whole and len(whole) == 26
    assert told(log.read(tables.open_table(spark, path).schema, log.snapshot(20)))


def test_numbered_writes_happen_once(spark):
    path = work_dir(spark, "t")
    put(spark, path, [("a", "1", 1)], writer="s", number=0)
    put(spark, path, [("a", "1", 2)], writer="s", number=1, notes={"high": 7})
    out = put(spark, path, [("a", "1", 1)], writer="s", number=0)
    assert told(out) == [("a", 2)] and TableLog(spark, path).snapshot().marks["s"] == {"number": 1, "notes": {"high": 7}}


def test_odd_partitions_and_nulls(spark):
    path = work_dir(spark, "t")
    rows = [("a", "x/y=z %", 1), ("b", None, 1), ("c", "", 1)]
    put(spark, path, rows)
    assert told(put(spark, path, [("b", None, 2), ("a", "x/y=z %", 3)])) == [("a", 3), ("b", 2), ("c", 1)]
