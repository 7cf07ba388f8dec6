"""Line deduplication with levelled runs of line hashes.

Documents come in batches, those with the largest ids first. A batch's line keys
are merge-anti-joined with the runs: keys no run holds are new, and the batch's
largest document holding one keeps it; for known keys only the count goes on.
The batch then becomes a run of its own, sorted and bucketed by hash. As soon as
a level has ``fan_in`` runs, they are compacted into one of the next level.

Hashes have 128 bits, so that equal hashes mean equal lines even among 10**13.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.stage import id_and_text, partitions, per_batch, staged
from bandwatch.session import work_dir

SPACE = b" \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]
MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """16 bytes for a line long enough to count, from its stripped lower-case form (A-Z only)."""
    line = line.strip(SPACE)
    if len(line) < min_chars or (not line.isascii() and len(line.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(line.lower())


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, of) once per document row and distinct key; ``of`` is a hash of the row's text.

    Rows with one id lose the same keys. ``of`` tells them apart all the same, so that what a row
    is told to lose stays as short as its own text, however many rows have its id or none.
    """

    def keys(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, n = [], []
        for text in _texts(batch.column(1)):
            own = {k for line in text.split(b"\n") if (k := line_key(line, min_chars))}
            found.extend(own)
            n.append(len(own))
        rows = pa.array(np.repeat(np.arange(len(n)), n))
        halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column(0).take(rows), batch.column(2).take(rows)],
            ["h1", "h2", "doc_id", "of"])

    return docs.withColumn("of", text_hash(F.col("text"))).mapInArrow(per_batch(keys), "h1 long, h2 long, doc_id long, of long")


def text_hash(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


class LineRuns:
    """Runs of (h1, h2, n_docs, keep), by level; the key of a run is unique within it.

    A run is a table bucketed and sorted by hash, so joins with it and compactions
    need no exchange on its side. Its files lie in the shared folder; ``drop`` removes
    tables and files.
    """

    def __init__(self, like: DataFrame, fan_in: int = 2):
        self.spark, self.buckets, self.fan_in = like.sparkSession, partitions(like), fan_in
        self.levels: list[list[str]] = []
        self._paths: dict[str, str] = {}

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self._paths[name] = work_dir(self.spark, "line-run")
        (
            df.select(*HASH, "n_docs", "keep").repartition(self.buckets, *HASH)
            .write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
            .option("path", self._paths[name]).saveAsTable(name)
        )
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._paths.pop(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> None:
        """Take in a batch's (h1, h2, n_docs, keep)."""
        fresh, again = keys, None
        for run in self.runs():
            met = fresh.join(run.select(*HASH), HASH, "left_semi").withColumn("keep", F.lit(None).cast("long"))
            again = met if again is None else again.unionByName(met)
            fresh = fresh.join(run.select(*HASH), HASH, "left_anti")
        self._put(self._write(fresh if again is None else fresh.unionByName(again)), 0)

    def _put(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_in:
            merged = self._write(self._merged(self.levels[level]))
            for old in self.levels[level]:
                self._remove(old)
            self.levels[level] = []
            self._put(merged, level + 1)

    def _merged(self, names: list[str]) -> DataFrame:
        every = self.spark.table(names[0])
        for name in names[1:]:
            every = every.unionByName(self.spark.table(name))
        return every.groupBy(*HASH).agg(F.sum("n_docs").alias("n_docs"), F.max("keep").alias("keep"))

    def totals(self) -> DataFrame:
        """Every key with its number of documents and the largest id holding it."""
        return self._merged([name for level in self.levels for name in level])

    def drop(self) -> None:
        for name in list(self._paths):
            self._remove(name)
        self.levels = []


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = 4,
                   fan_in: int = 2) -> DataFrame:
    """(doc_id, of, gone): the keys that document rows with this id and text hash lose, where they lose any."""
    slim = id_and_text(docs)
    cuts = slim.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0] or []
    places = staged(
        line_keys(slim, min_chars).withColumn("batch", sum((F.coalesce(F.col("doc_id") <= c, F.lit(True)).cast("int")
                                                            for c in cuts), F.lit(0))), "line-places")
    runs = LineRuns(places, fan_in)
    try:
        for batch in range(len(cuts) + 1):
            keys = places.where(F.col("batch") == batch).select(*HASH, "doc_id").distinct().groupBy(*HASH).agg(
                F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep"))
            runs.add(keys)
        hot = staged(runs.totals().where(F.col("n_docs") >= min_docs).select(*HASH, "keep"), "line-hot")
    finally:
        runs.drop()
    return (
        places.join(hot, HASH)
        .where(F.coalesce(F.col("doc_id") < F.col("keep"), F.col("keep").isNotNull()))
        .select("doc_id", "of", F.struct("h1", "h2").alias("key"))
        .groupBy("doc_id", "of").agg(F.collect_set("key").alias("gone"))
    )


def _gone(column: pa.Array, row: int) -> set[bytes]:
    if not column[row].is_valid:
        return set()
    pairs = column[row].as_py()
    return {np.array([p["h1"], p["h2"]], "<i8").tobytes() for p in pairs}


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = 4,
                fan_in: int = 2, digest: bool = False) -> DataFrame:
    """Documents without their repeated lines: doc_id, n_lines, n_dropped, kept (``digest``: kept_sha256).

    A line's key is the line stripped of ASCII white space with A-Z in lower case. Keys of ``min_chars`` code
    points or more that ``min_docs`` documents (distinct ids) hold lose all their lines but in the largest doc_id.

    Null or empty text: one empty line. Rows with one doc_id count as one document and all keep or lose a line
    together. A null doc_id is smaller than every other; where only such rows hold a key, all keep it. An empty
    table gives an empty result. Columns besides id and text are not read.
    """
    slim = id_and_text(docs)
    lost = repeated_lines(slim, min_docs, min_chars, batches, fan_in).withColumnsRenamed({"doc_id": "_id", "of": "_of"})
    both = slim.join(lost, slim.doc_id.eqNullSafe(lost._id) & (text_hash(slim.text) == lost._of), "left").select("doc_id", "text", "gone")

    def kept(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_lines, n_dropped, out = [], [], []
        for row, text in enumerate(_texts(batch.column(1))):
            gone = _gone(batch.column(2), row)
            lines = text.split(b"\n")
            left = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            joined = b"\n".join(left)
            out.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(out, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept"])

    name = "kept_sha256" if digest else "kept"
    return both.mapInArrow(per_batch(kept), "doc_id long, n_lines long, n_dropped long, kept string").withColumnRenamed(
        "kept", name)


def without_repeated_lines(docs: DataFrame, **rule) -> DataFrame:
    """The same documents with all their columns; ``text`` has lost its repeated lines, ``n_chars`` follows it.

    Texts that lose no line stay as they are, null included.
    """
    mark = f"gone_{uuid.uuid4().hex}"  # a name no column has
    lost = repeated_lines(docs, **rule).withColumnsRenamed({"doc_id": f"id_{mark}", "of": f"of_{mark}", "gone": mark})
    min_chars = rule.get("min_chars", MIN_CHARS)

    def strip(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, gone_at = batch.schema.get_field_index("text"), batch.num_columns - 1
        out = []
        for row, text in enumerate(batch.column(at).cast(pa.large_binary()).to_pylist()):
            gone = _gone(batch.column(gone_at), row)
            if gone:
                text = b"\n".join(x for x in text.split(b"\n") if line_key(x, min_chars) not in gone)
            out.append(None if text is None else text.decode())
        arrays = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(gone_at)]
        yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:gone_at])

    same = docs["doc_id"].eqNullSafe(lost[f"id_{mark}"]) & (text_hash(docs["text"]) == lost[f"of_{mark}"])
    both = docs.join(lost, same, "left").select(*[docs[f"`{c}`"] for c in docs.columns], lost[mark])
    left = both.mapInArrow(per_batch(strip), docs.schema)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return left
