import numpy as np
from pyspark.sql import functions as F

from bandwatch.llm import quality as q


def test_held_out_documents(spark):
    """Insults are caught, good documents stay, and expected grades follow the labels."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    ratings = labels.withColumn("grade", q.grade(F.col("quality"), F.col("toxic")).cast("int"))
    model = q.fit_quality(docs, ratings.where(fit).select("doc_id", "grade"), max_fit=2500)
    rows = q.grade_documents(docs.join(ratings.where(~fit).select("doc_id", "grade"), "doc_id"), model).join(ratings, "doc_id").join(
        docs.select("doc_id", F.col("text").rlike(r"(?i)\b(trash|idiot|stupid|scum|loser|moron|clown)\b").alias("insult")), "doc_id").collect()
    good = [r for r in rows if r.grade == 2]
    insults = [r for r in rows if r.grade == 0 and r.insult]
    assert len(good) > 500 and len(insults) > 40
    assert np.mean([r.keep for r in good]) > 0.995 and np.mean([r.keep for r in insults]) < 0.15
    means = [np.mean([r.expected_grade for r in rows if r.grade == g and (g or r.insult)]) for g in range(3)]
    assert means == sorted(means)
    for r in rows:
        assert 0 <= r.p_at_least_2 <= r.p_at_least_1 <= 1 and abs(r.expected_grade - r.p_at_least_1 - r.p_at_least_2) < 1e-9


def test_thresholds_and_weights_are_recovered():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(4000):
        a, b, c = rng.integers(0, 2, 3)
        s = 3 * a - 3 * b
        u = rng.logistic()
        rows.append((np.array([1] * a + [2] * b + [3] * c + [9]), np.ones(a + b + c + 1)))
        y.append(int(s + u > -1) + int(s + u > 2) + int(s + u > 4))
    model = q.fit_ordinal(rows, np.array(y), 4)
    w = model.weights
    assert (np.diff(model.thresholds) > 0).all() and w[1] > 1.5 and w[2] < -1.5 and abs(w[3]) < 0.4
    assert np.abs(np.diff(model.thresholds) - [3, 2]).max() < 0.8


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "good words " * 100_000, 1), (None, "x", 1), (3, "again", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep int")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = q.document_quality(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.expected_grade <= 2 for r in got)
    none = q.document_quality(docs, labels.limit(0)).collect()
    assert all(abs(r.expected_grade - 1) < 1e-9 for r in none)
    assert q.document_quality(docs.limit(0), labels).count() == 0


def test_marks_count_by_share():
    at, x = q.text_features("a b c d ### e")
    assert len(at) == 6 and sorted(x)[-1] == 1 and len(q.text_features(None)[0]) == 0


def test_toxic_documents_of_every_language_are_caught(spark):
    """All held-out toxic documents count, with insults of the English list or without."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    ratings = labels.withColumn("grade", q.grade(F.col("quality"), F.col("toxic")).cast("int"))
    model = q.fit_quality(docs, ratings.where(fit).select("doc_id", "grade"))
    rows = q.grade_documents(docs, model).join(ratings.where(~fit).select("doc_id", "grade"), "doc_id").join(
        docs.select("doc_id", "lang"), "doc_id").collect()
    kept = {x: np.mean([r.keep for r in rows if r.grade == 0 and r.lang == x]) for x in ("en", "fr", "de", "es")}
    assert max(kept.values()) < 0.25 and np.mean([r.keep for r in rows if r.grade == 0]) < 0.12, kept
    for x in kept:
        assert np.mean([r.keep for r in rows if r.grade == 2 and r.lang == x]) > 0.98


def test_sample_is_drawn_by_grade(spark):
    """A grade of 1 in 200 keeps all its documents in a sample of 120, and the thresholds follow the true shares."""
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 200 = 0, 'vile text', 'nice text') as text")
    ratings = docs.selectExpr("doc_id", "cast(if(doc_id % 200 = 0, 0, 2) as int) as grade")
    model = q.fit_quality(docs, ratings, max_fit=120)
    rows = q.grade_documents(docs, model).collect()
    assert all(r.keep == (r.doc_id % 200 != 0) for r in rows)
    assert abs(np.mean([r.p_at_least_1 for r in rows]) - 0.995) < 0.02


def test_stems_are_characters_of_any_length():
    text = "Éclairs éclat abc réeuxment, ÉCLA"
    h = q.stem_hashes(text)
    assert len(h) == 4 and h[0] == h[1] == h[3] != h[2]
    assert (q.stem_hashes("漢字漢字漢 word") == np.concatenate([q.stem_hashes("漢字漢字"), q.stem_hashes("wordy")])).all()
    assert len(q.stem_hashes("")) == len(q.stem_hashes("a é 漢字漢")) == 0
