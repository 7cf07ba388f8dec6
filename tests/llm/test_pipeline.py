import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from bandwatch.llm import decontaminate, language
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_tokens import WORD_BPE, brute_tokens

SPACE = " \t\n\x0b\x0c\r"


def without_lines(rows):
    held = {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    for doc_id, text in rows:
        for k in {key(x) for x in text.split("\n")}:
            if len(k) >= 40:
                held.setdefault(k, []).append(doc_id)
    out = []
    for doc_id, text in rows:
        lines = [x for x in text.split("\n") if len(held.get(key(x), ())) < 5 or max(held[key(x)]) == doc_id]
        out.append((doc_id, "\n".join(lines)))
    return out


def test_stages_and_run_equal_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("block", F.lit("k"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "packing"]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frames[-1], sf_dir)
        if name != "packing":
            assert out.columns == docs.columns
            path = corpus_pipeline.staged(out, "test-stage")
            frames.append(path)
        else:
            frames.append(out)
    told = {r.doc_id: (r.lang_pred, r.score) for r in language.identify_languages(docs).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if told[r.doc_id][0] != "und" and told[r.doc_id][1] >= 0.5)
    got = lambda i: sorted((r.doc_id, r.text) for r in frames[i].collect())
    assert got(1) == rows
    rows = without_lines(rows)
    assert got(2) == rows
    assert all(r.n_chars == len(r.text) for r in frames[2].collect())
    rows = [(d, t) for d, t, _, c in groups(rows, 5, 80) if c == d]
    assert got(3) == sorted(rows)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {r[0] for r in leaks([(d, t) for d, t in rows if might_leak(t, items)], items)}
    rows = sorted((d, t) for d, t in rows if d not in bad)
    assert bad and got(4) == rows
    ids = dict(brute_tokens([type("Row", (), {"doc_id": d, "text": t}) for d, t in rows], WORD_BPE, 2))
    pieces = frames[5].collect()
    assert Counter(r.doc_id for r in pieces).keys() == ids.keys()
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in pieces) == sum(map(len, ids.values()))
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, pieces))


def might_leak(text, items):
    """Shares a five-word shingle with an item; only such documents are worth the slow comparison."""
    bags = getattr(might_leak, "bags", None) or set().union(*(decontaminate_bag(i) for _, i in items))
    might_leak.bags = bags
    return bool(bags & decontaminate_bag(text))


def decontaminate_bag(text):
    words = re.sub(r"[!-/:-@\[-`{-~]", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)).encode().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_odd_documents_pass_all_stages(spark):
    rows = [("x", 1, None, "en", "s", None), ("x", 2, "", "en", "s", 0), ("x", None, "the of and", "en", "s", 10), ("x", 3, "the of and " * 9, None, None, 99),
            ("x", 3, "the of and " * 9, None, None, 99)] + [("x", i, "the and of is", "en", "s", 13) for i in range(10, 20)]
    schema = "gone string, doc_id long, text string, lang string, source string, n_chars long"
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, "/root/testdata/sf0.001")
            out.count()
            frame = out if stage is corpus_pipeline.pack_sequences else corpus_pipeline.staged(out, "test-odd")


def test_constants_of_the_stages():
    assert decontaminate.SHINGLE == 5 and decontaminate.SIMILARITY == 0.8


def test_every_stage_gets_its_texts_in_small_batches(spark):
    """A stage is run on texts of 20 MB in all; what a task is handed at a time is told by the task."""
    import pyarrow as pa

    import corpus_pipeline
    from bandwatch.llm.stage import BATCH_BYTES

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes]})

    texts = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat('x', 10000) as text")
    held = corpus_pipeline.in_small_batches(lambda session, docs, _: docs.mapInArrow(sizes, "bytes long"))
    for stage in [f for _, f in corpus_pipeline.STAGES]:
        assert stage.__wrapped__ and stage.__code__ is held.__code__
    try:
        found = [r.bytes for r in held(spark, texts, "").collect()]
    finally:
        spark.conf.set(name, before)
    assert sum(found) >= 20_000_000 and max(found) <= 1.1 * BATCH_BYTES
