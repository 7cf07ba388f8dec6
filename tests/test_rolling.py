"""Rolling histories by increments against rolls over the whole history."""

import random

import pytest
from pyspark.sql import functions as F

from bandwatch.operators import series as ts
from bandwatch.sinks.rolling import VALUES, RollingStore
from tests.helpers import at, cells, rows

KEYS = ("resId", "kpiId", "recordTime", "kpiValue")


def plain(df):
    return sorted((*r[:3], round(r[3], 9)) for r in rows(df, *KEYS))


@pytest.fixture(scope="module")
def batches():
    """Gaps, ties, a gap wider than the window, late and off-slot readings, nulls, a new element and a new KPI, a silent element."""
    rng = random.Random(3)

    def some(e, k, a, b, share=0.6):
        return [(e, k, s, float(rng.randint(1, 9))) for s in range(a, b) if s == a or rng.random() < share]

    return [
        some("a", "x", 0, 12) + some("a", "y", 2, 12) + some("b", "x", 0, 9) + some("c", "x", 0, 6) + [("a", "z", 3, None)],
        some("a", "x", 12, 16) + some("b", "x", 10, 14) + [("a", "w", 14, 5.0), ("b", "x", 13.5, 2.0), ("b", "y", 12, None)],
        some("a", "y", 17, 20) + some("d", "x", 14, 20) + some("b", "x", 40, 44),
        some("a", "x", 20, 24) + some("b", "x", 44, 47) + [("d", "x", 20.5, 1.0)],
    ]


def fresh_cells(spark, batch):
    return cells(spark, [(e, k, at(s), v) for e, k, s, v in batch])


def test_equals_rolls_over_the_whole_history(spark, batches, tmp_path):
    store = RollingStore(spark, str(tmp_path / "h"), 3)
    whole = None
    for batch in batches:
        fresh = fresh_cells(spark, batch)
        state = store.roll(fresh, 300)
        if whole is None:
            whole = ts.impute_median(ts.drop_empty_series(ts.regular_grid(fresh, 300)))
        else:
            whole = ts.roll_history(whole, fresh, 300)
        whole = spark.createDataFrame(whole.select("resId", "itemPara", "kpiId", "recordTime", "kpiValue").collect(), fresh.schema)
        assert plain(store.read(state)) == plain(whole)
        kept = store.digests(state).select("resId", "kpiId", F.explode("digest").alias("e")).select("resId", "kpiId", "e.value", "e.n")
        counted = whole.groupBy("resId", "kpiId", F.col("kpiValue").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        assert rows(kept, "resId", "kpiId", "value", "n") == rows(counted, "resId", "kpiId", "value", "n")
    assert plain(store.read()) == plain(whole)


def test_late_readings_and_repeats_change_nothing(spark, batches, tmp_path):
    store = RollingStore(spark, str(tmp_path / "h"), 3)
    first = store.roll(fresh_cells(spark, batches[0]), 300, number=0)
    before = plain(store.read())
    assert store.roll(fresh_cells(spark, batches[1]), 300, number=0).version == first.version
    store.roll(fresh_cells(spark, [("a", "x", 5, 100.0), ("c", "x", 0, 100.0)]), 300)
    store.roll(fresh_cells(spark, []), 300)
    assert plain(store.read()) == before


def test_a_stopped_roll_changes_nothing(spark, batches, tmp_path, monkeypatch):
    store = RollingStore(spark, str(tmp_path / "h"), 3)
    store.roll(fresh_cells(spark, batches[0]), 300)
    before = plain(store.read())
    with monkeypatch.context() as m:
        m.setattr(store.log, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            store.roll(fresh_cells(spark, batches[1]), 300, number=1)
    assert plain(store.read()) == before
    store.roll(fresh_cells(spark, batches[1]), 300, number=1)
    again = RollingStore(spark, str(tmp_path / "g"), 3)
    for batch in batches[:2]:
        again.roll(fresh_cells(spark, batch), 300)
    assert plain(store.read()) == plain(again.read())


def test_a_roll_opens_only_slots_that_leave(spark, tmp_path):
    """A window of 40 slots, rolled by 4: each roll reads 4 stored slots a series, and segments go when windows have left them."""
    store = RollingStore(spark, str(tmp_path / "h"), 2)
    elements = ("a", "b", "c")
    store.roll(fresh_cells(spark, [(e, "x", s, float(s % 7)) for e in elements for s in range(40) if s % 3 != 1]), 300)
    for k in range(10, 13):
        state = store.log.snapshot()
        fresh = fresh_cells(spark, [(e, "x", s, 2.0) for e in elements for s in range(4 * k, 4 * k + 4)])
        leaving = store.leaving(state, store._windows(store.digests(state), fresh, 300))
        assert leaving.count() == fresh.count()
        store.roll(fresh, 300)
    state = store.log.snapshot()
    assert store.read(state).count() == 3 * 40
    # three rolls of four slots are segments of their own beside the first window
    stored = store._read(VALUES, state, {p for p in state.parts() if p.startswith("values-")})
    assert stored.groupBy("segment").count().count() == 4
    store.roll(fresh_cells(spark, [(e, "x", s, 3.0) for e in elements for s in range(52, 92)]), 300)
    state = store.log.snapshot()
    assert len([p for p in state.parts() if p.startswith("values-")]) == 1 and store.read(state).count() == 3 * 40
