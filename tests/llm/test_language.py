import numpy as np
from pyspark.sql import functions as F

from bandwatch.llm import language


def test_accuracy_and_calibration_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (language.crc_bucket(r.doc_id) == 0) and 0 <= r.score <= 1
    apart = [r for r in got if r.held_out]
    right = np.array([r.lang == r.lang_pred for r in apart])
    scores = np.array([r.score for r in apart])
    assert right.mean() > 0.97 and abs(scores.mean() - right.mean()) < 0.05


def test_learns_nothing_from_held_out_rows_or_other_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = language.held_out(F.col("doc_id"))
    garbled = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    a = language.identify_languages(docs).orderBy("doc_id").collect()
    assert a == language.identify_languages(garbled).orderBy("doc_id").collect()
    assert "xx" not in {r.lang_pred for r in a}


def test_weights_are_sparse_and_ftrl_separates():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 300)
    rows = [(np.array([int(k), 10 + int(rng.integers(5))]), np.array([0.8, 0.6])) for k in y]
    w = language.fit_ftrl(rows, y, 3)
    assert (np.array([(x @ w[a] + w[-1]).argmax() for a, x in rows]) == y).all()
    assert (w == 0).mean() > 0.99


def test_temperature_undoes_overconfidence():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 1, (4000, 3))
    y = np.array([rng.choice(3, p=language.softmax(z)) for z in logits])
    assert 4 < language.fit_temperature(logits * 5, y) < 6.5


def test_whole_text_counts_in_slices(monkeypatch):
    text = "Abc déf ghi " * 50
    want = language.gram_counts(text)
    monkeypatch.setattr(language, "SLICE", 7)
    assert (language.gram_counts(text) == want).all() and want.sum() == 3 * len(text) - 3


def test_odd_rows(spark):
    rows = [(1, "the and of", "en", 1.0, "k"), (2, None, "en", 1.0, "k"), (3, "", None, 1.0, "k"), (4, "123 !?", "en", 1.0, "k"),
            (None, "the and", "en", 1.0, "k"), (6, "und der die", "de", 1.0, "k"), (6, "und der die", "de", 1.0, "k"),
            (7, "the " * 400_000, "en", 1.0, "k"), (8, "word", None, 1.0, "k")] + [(i, "the of and", "en", 0.0, "") for i in range(20, 30)]
    schema = "doc_id long, text string, lang string, score double, lang_pred string"
    got = language.identify_languages(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and by[7].lang_pred == "en" and by[None].held_out
    nothing = language.identify_languages(spark.createDataFrame([], schema))
    assert nothing.count() == 0
    unlabelled = language.identify_languages(spark.createDataFrame([(1, "the", None, 0.0, "")], schema)).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


def test_small_tables_are_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert language.fit_language_model(docs).temperature != 1.0
    for n in (1, 4, 5, 800, 5000):
        out = language.set_apart(n, 4000, 1000)
        assert out.sum() == n // 5 and not out[0]


def test_a_rare_language_is_learned_and_biases_follow_the_shares(spark):
    """1 in 500 rows; the other languages are 9 in 10 and 1 in 10."""
    docs = spark.range(5000).selectExpr(
        "id as doc_id", "case when id % 500 = 7 then 'xx' when id % 10 = 0 then 'de' else 'en' end as lang").selectExpr(
        "*", "case lang when 'xx' then 'qo zuq qozi' when 'de' then 'und der die' else 'the and of' end || ' ' || doc_id as text")
    model = language.fit_language_model(docs, max_fit=40, max_calibrate=10)
    assert model.labels == ["de", "en", "xx"]
    got = language.predict_language(docs, model).collect()
    assert {(r.lang, r.lang_pred) for r in got} == {(x, x) for x in model.labels}
    b = model.weights[-1] / model.temperature
    assert b[1] > b[0] > b[2]


def test_copies_do_not_push_a_language_out(spark):
    rows = [(1, "the and of", "en")] * 3000 + [(i, "und der die", "de") for i in (2, 3, 4)]
    model = language.fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_fit=8, max_calibrate=2)
    assert model.labels == ["de", "en"]
