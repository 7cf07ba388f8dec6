import hashlib
import os

import pytest
from pyspark.sql import functions as F

from bandwatch.llm import lines
from tests.llm.test_pipeline import SPACE, without_lines


def brute(rows, key_of=lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))):
    held = {}
    for doc_id, text in rows:
        for k in {key_of(x) for x in (text or "").split("\n")}:
            if len(k) >= 40:
                held.setdefault(k, []).append(doc_id)
    out = []
    for doc_id, text in rows:
        parts = (text or "").split("\n")
        kept = []
        for x in parts:
            holders = held.get(key_of(x), ())
            largest = max((d for d in holders if d is not None), default=None)
            lost = len(holders) >= 5 and largest is not None and (doc_id is None or doc_id < largest)
            if not lost:
                kept.append(x)
        out.append((doc_id, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def long_line(i):
    return f"Line number {i} is certainly longer than forty characters É"


def test_odd_rows_batches_and_levels(spark):
    rows = [(d, "\n".join(long_line((d * k) % 17) for k in range(1, 6))) for d in range(60)]
    rows += [(100 + i, f"  {long_line(3).upper().replace('É', 'é')}\t\n short\n\n{long_line(99)}") for i in range(6)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, long_line(1)), (None, long_line(2) + "\n" + long_line(2)), (7, long_line(99)),
             (300, "x" * 40 + "\n" + "é" * 40 + "\n" + "é" * 39), (301, "y\r\n" * 50_000)] + [(310 + i, "é" * 39 + "\n" + "é" * 40) for i in range(5)]
    frame = spark.createDataFrame([(t, d, "h") for d, t in rows], "text string, doc_id long, gone string")
    want = brute(rows)
    assert sum(r[2] for r in want) > 50
    for batches, fan_in in ((4, 2), (1, 2), (7, 3)):
        got = lines.dedup_lines(frame, batches=batches, fan_in=fan_in).collect()
        assert sorted(map(tuple, got), key=repr) == want
    digest = lines.dedup_lines(frame, digest=True).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in digest if r.doc_id is not None) == sorted(
        (d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in want if d is not None)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_stage_keeps_columns_and_nulls(spark):
    rows = [(d, long_line(1) + "\nown") for d in range(6)] + [(9, None)]
    frame = spark.createDataFrame([(t, "g", d, 0) for d, t in rows], "text string, gone string, doc_id long, n_chars long")
    got = lines.without_repeated_lines(frame)
    assert got.columns == frame.columns
    want = dict(without_lines([r for r in rows if r[1] is not None]))
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {d: (t, len(t)) for d, t in want.items()} | {9: (None, 0)}


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedup_lines(empty).count() == 0 and lines.without_repeated_lines(empty).count() == 0


def test_repeated_rows_of_a_document_count_once(spark):
    text = long_line(1)
    frame = spark.createDataFrame([(1, text)] * 4 + [(2, text)], "doc_id long, text string")
    assert {r.n_dropped for r in lines.dedup_lines(frame).collect()} == {0}


def test_what_a_row_loses_stays_as_short_as_its_text(spark):
    """Thousands of rows without an id, and half of all rows with one id, each with lines of its own that others hold too."""
    rows = [(None, long_line(i) + "\n" + long_line(i + 1)) for i in range(3000)]
    rows += [(1, long_line(i)) for i in range(3000)] + [(None, long_line(5))] * 2000
    rows += [(10 + k, "\n".join(long_line(i) for i in range(3001))) for k in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    lost = lines.repeated_lines(frame).select("doc_id", F.size("gone").alias("n")).collect()
    assert len(lost) > 6000 and max(r.n for r in lost if r.doc_id in (None, 1)) == 2
    got = lines.dedup_lines(frame).collect()
    assert sorted(map(tuple, got), key=repr) == brute_ids(rows)


def brute_ids(rows):
    """Every line is held by ids 10 to 14, of which 14 keeps it."""
    return sorted(((d, (n := t.count("\n") + 1), 0 if d == 14 else n, t if d == 14 else "") for d, t in rows), key=repr)


def test_a_failed_run_leaves_no_runs(spark, monkeypatch):
    frame = spark.createDataFrame([(d, long_line(d % 3)) for d in range(30)], "doc_id long, text string")
    paths = []

    def fail(self):
        paths.extend(self._paths.values())
        raise RuntimeError("stopped")

    monkeypatch.setattr(lines.LineRuns, "totals", fail)
    with pytest.raises(RuntimeError):
        lines.dedup_lines(frame)
    assert paths and not any(os.path.exists(p) for p in paths)
    assert all(p.startswith(spark.conf.get("spark.checkpoint.dir")) for p in paths)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]
