"""Fingerprints and history versions."""

from pyspark.sql import functions as F

from bandwatch.session import work_dir
from bandwatch.sinks.audit import differences, fingerprint
from bandwatch.sinks.history import HistoryStore
from tests.helpers import cells, rows


def test_fingerprints_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (3, "a", None)], "id int, a string, b string")
    one = fingerprint(df).first()
    assert fingerprint(df.orderBy(F.desc("id")).repartition(3).select("b", "id", "a")).first() == one
    for other in (df.dropDuplicates(), df.withColumn("a", F.coalesce("a", F.lit(""))), df.where("id < 3"),
                  df.withColumns({"a": F.col("b"), "b": F.col("a")})):
        assert fingerprint(other).first() != one
    empty = fingerprint(df.limit(0)).first()
    assert (empty["rows"], empty["sum"]) == (0, 0)


def test_differences_name_the_rows(spark):
    layout = "day string, id string, v double"
    a = spark.createDataFrame([("1", "a", 1.0), ("1", "b", 2.0), ("2", "c", 3.0), (None, "d", None), ("3", "e", 1.0), ("3", "e", 2.0)], layout)
    b = spark.createDataFrame([("1", "a", 1.0), ("1", "b", 2.5), ("2", "c", 3.0), (None, "f", None), ("3", "e", 2.0), ("3", "e", 1.0)], layout)
    found = sorted((r.id, r.kind) for r in differences(a, b, ["id"], ["day"]).collect())
    assert found == [("b", "changed"), ("d", "missing"), ("f", "extra")]
    assert differences(a, a.repartition(2), ["id"], ["day"]).count() == 0


def test_the_newest_intact_version_is_read(spark):
    store = HistoryStore(spark, work_dir(spark, "h"))
    assert store.read() is None
    base = cells(spark, [("a", "k", s, float(s)) for s in range(20)])
    for v in (1, 2, 3, 4):
        assert store.write(base.withColumn("kpiValue", F.col("kpiValue") + v)) == v
    assert store.versions() == [4, 3, 2]  # retention
    version, history = store.read()
    assert version == 4 and rows(history, "kpiValue")[0] == (10.0,)
    base.limit(20).write.mode("overwrite").parquet(store.path(4))  # as many rows, other values
    assert store.read()[0] == 3
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store.path(3))
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    assert store.read()[0] == 2
    base.limit(3).write.mode("overwrite").parquet(store.path(5))  # stopped before its mark
    assert store.read()[0] == 2 and store.write(base) == 5 and store.read()[0] == 5
