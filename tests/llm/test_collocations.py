import re
from collections import Counter, defaultdict

import pytest

from bandwatch.llm.collocations import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= support}
        found = []
        for p, a in candidates.items():
            inside = any(100 * candidates[q] >= 100 * a for q in candidates if len(q) > len(p) and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not inside:
                s, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def run(spark, rows, **settings):
    df = spark.createDataFrame([(i, t, x, "p", 1) for i, (x, t) in enumerate(rows)], SCHEMA)
    out = collocations(df, **settings)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


ROWS = [("en", "The cat sat. The cat\tsat on the  mat; the CAT sat on"), ("en", None), (None, "a b a b a b a b a b"), ("en", ""),
        ("de", "der Hund der Hund\nder Hund. der. Hund"), ("en", "the cat\x0bsat on the mat, on the mat. sat on the mat"), ("und", "a b a b!a b"),
        ("de", "Ärger äRger ärger Ärger Ärger Ärger\x1cÄrger Ärger"), ("fr", " \t . ,"), ("en", "x" * 5000 + " y " + "x" * 5000 + " y")] * 2


@pytest.mark.parametrize("support,top,shards", [(2, 100, 8), (3, 4, 1), (4, 100, 3), (1, 9, 2)])
def test_equal_to_brute_force(spark, support, top, shards):
    want = brute(ROWS, support, top)
    assert want and run(spark, ROWS, support=support, top=top, shards=shards) == want


def test_small_lots_and_many_languages(spark, monkeypatch):
    rows = [(f"l{i % 7}", "one two three four five six. " * (i % 5)) for i in range(60)] + [("l1", "one two " * 3000)]
    want = brute(rows, 20, 50)
    import bandwatch.llm.collocations as c

    monkeypatch.setattr(c, "BUFFER", 50)
    monkeypatch.setattr(c, "MOST_WORDS", 3)
    assert want and run(spark, rows, support=20, top=50) == want


def test_nothing_to_find(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", "a b c"), ("en", None)]) == []


def test_products_past_64_bits(spark):
    """The formula alone, with counts that no test text can have."""
    from bandwatch.llm.collocations import scored

    a, l, r, n = 6 * 10**11, 7 * 10**11, 10**12 + 3, 10**13 + 7
    counts = spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", l), ("en", 1, "y", r)], "lang string, k int, phrase string, n long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    row = scored(counts, totals).collect()[0]
    assert (row.l, row.r, row.score) == (l, r, 1000 * a * n // (l * r))


def test_lots_keep_groups_apart_and_everything(monkeypatch):
    import pyarrow as pa

    import bandwatch.llm.collocations as c

    monkeypatch.setattr(c, "BUFFER", 10)
    rows = [("en" if i % 3 else "de", bytes([i]) * (i % 7)) for i in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows[i:i + 13]]), pa.array([b for _, b in rows[i:i + 13]], pa.binary())],
                                          ["lang", "h"]) for i in range(0, 60, 13)]
    lots = list(c._in_buffers(iter(batches), 1))
    assert len(lots) > 4
    for lang in ("en", "de"):
        assert [b for (x,), some in lots if x == lang for b in some] == [b for x, b in rows if x == lang]


def test_lots_are_small():
    """What a task holds at a time follows from the words of a lot."""
    import pyarrow as pa

    import bandwatch.llm.collocations as c

    text = b"words " * 10_000
    batches = (pa.RecordBatch.from_arrays([pa.array(["en"] * 10), pa.array([text] * 10, pa.binary())], ["lang", "text"]) for _ in range(30))
    lots = [sum(map(len, some)) // 6 for _, some in c._in_buffers(batches, 6)]
    assert sum(lots) == 3_000_000 and max(lots) <= 1_100_000


def test_words_of_phrases_come_once_a_task(monkeypatch):
    """The task's function alone, in this process: a lot a row."""
    from unittest.mock import MagicMock

    import numpy as np
    import pyarrow as pa

    import bandwatch.llm.collocations as c

    monkeypatch.setattr(c, "BUFFER", 8)
    h = np.array([c._word_hash(w) for w in (b"one", b"two", b"three", b"four")] * 2, np.uint32).tobytes()
    words = MagicMock()
    words.sparkSession.sparkContext.broadcast.return_value.value = np.full(1 << (c.FILTER_BITS - 3), 255, np.uint8)
    c.words_of_phrases(words, None)
    run = words.select.return_value.mapInArrow.call_args.args[0]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 20), pa.array([5] * 20), pa.array([h] * 20, pa.binary())], ["lang", "salt", "h"])
    keys = [k for out in run(iter([batch])) for k in out.column(0).to_pylist()]
    assert len(keys) == len(set(keys)) == 4


def test_final_counts_come_once_a_task_in_bounded_tasks(monkeypatch):
    """Many input partitions and a lot a row: rows of the last step follow from tasks and phrases alone."""
    from unittest.mock import MagicMock

    import numpy as np
    import pyarrow as pa

    import bandwatch.llm.collocations as c

    monkeypatch.setattr(c, "BUFFER", 8)
    found = [np.full(1 << (c.FILTER_BITS - 3), 255, np.uint8)] * 3
    docs = MagicMock()
    docs.sparkSession.sparkContext.defaultParallelism = 6
    docs.sparkSession.sparkContext.broadcast.return_value.value = found
    c.counted(docs, found)
    assert docs.coalesce.call_args.args[0] == 12
    run = docs.coalesce.return_value.mapInArrow.call_args.args[0]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"] * 20), pa.array([b"one two three. one two, four"] * 40, pa.string())], ["lang", "text"])
    rows = [tuple(r.values()) for out in run(iter([batch, batch])) for r in out.to_pylist()]
    one = {(1, "one"): 80, (1, "two"): 80, (1, "three"): 40, (1, "four"): 40, (2, "one two"): 80, (2, "two three"): 40, (3, "one two three"): 40}
    assert len(rows) == 2 * len(one) and {(k, p): n for x, k, p, n in rows if x == "de"} == one == {(k, p): n for x, k, p, n in rows if x == "en"}
    monkeypatch.setattr(c, "MOST_PHRASES", 5)  # handed on in between, nothing is lost
    some = [tuple(r.values()) for out in run(iter([batch, batch])) for r in out.to_pylist()]
    assert len(some) > len(rows) and all(sum(m for x, j, q, m in some if (x, j, q) == (lang, k, p)) == n for lang, k, p, n in rows)


def test_a_task_of_the_final_count_holds_few_words_at_a_time(monkeypatch):
    """Lots are a quarter of those of the mining, and the bound on distinct words holds over all languages."""
    from unittest.mock import MagicMock

    import numpy as np
    import pyarrow as pa

    import bandwatch.llm.collocations as c

    found = [np.full(1 << (c.FILTER_BITS - 3), 255, np.uint8)] * 2
    docs, lots, kept, made = MagicMock(), [], [], []

    class Watched(c._Counts):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

        def add(self, texts):
            lots.append(sum(len(t.split()) for t in texts))
            super().add(texts)
            kept.append(sum(len(x.ids) for x in made))

    monkeypatch.setattr(c, "_Counts", Watched)
    docs.sparkSession.sparkContext.broadcast.return_value.value = found
    c.counted(docs, found)
    run = docs.coalesce.return_value.mapInArrow.call_args.args[0]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 100), pa.array([b"words " * 10_000] * 100, pa.string())], ["lang", "text"])
    got = {r["phrase"]: r["n"] for out in run(iter([batch])) for r in out.to_pylist()}
    assert got == {"words": 1_000_000, "words words": 999_900} and max(lots) <= 300_000
    made.clear(), kept.clear()
    monkeypatch.setattr(c, "MOST_WORDS", 50)
    monkeypatch.setattr(c, "BUFFER", 8)
    langs = [f"l{i}" for i in range(10)] * 4
    texts = [" ".join(f"w{j}" for j in range(30)).encode()] * len(langs)
    rows = [r for out in run(iter([pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts, pa.string())], ["lang", "text"])])) for r in out.to_pylist()]
    assert max(kept) <= 50 + 31 + len(made) and all(r["n"] == 4 for r in rows) and len(rows) == 10 * (30 + 29)


def test_texts_come_to_tasks_in_small_batches(spark):
    from bandwatch.llm.collocations import collocations
    from bandwatch.llm.stage import BATCH_BYTES

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        collocations(spark.createDataFrame([("en", "one two")] * 3, "lang string, text string"), support=2)
        assert spark.conf.get(name) == str(BATCH_BYTES)
    finally:
        spark.conf.set(name, before)
