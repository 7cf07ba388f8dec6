"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams, weighted by TF-IDF. Weights are trained with
follow-the-regularised-leader (per-coordinate rates, elastic-net penalty), so most
become exactly zero; a temperature fitted on documents kept apart calibrates the
scores. Document frequencies come from all training documents; the regression itself
is fitted on at most ``MAX_FIT`` of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwatch.llm.stage import per_batch, quotas

GRAMS = (1, 2, 3)
BUCKETS = 1 << 15
MAX_FIT = 4000  # labelled documents the regression is fitted on, of each language those with the least hashes
MAX_CALIBRATE = 1000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.1
UNKNOWN = "und"
LEAST_SCORE = 0.5  # below it a document counts as of no known language
SLICE = 1 << 20  # characters hashed at a time


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed character n-grams of the whole lower-case text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(BUCKETS, np.int64)
    longest = max(GRAMS)
    for start in range(0, len(codes), SLICE):
        part = codes[start:start + SLICE + longest - 1]
        h = np.zeros(len(part), np.uint32)
        own = min(SLICE, len(codes) - start)  # grams that begin in this slice
        for n in range(1, longest + 1):
            keep = len(part) - n + 1
            if keep <= 0:
                break
            h = (h[:keep] * np.uint32(0x01000193)) ^ part[n - 1:n - 1 + keep]
            if n in GRAMS:
                place = ((h + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(17)
                total += np.bincount(place[:own], minlength=BUCKETS)
    return total


def gram_vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and unit-length TF-IDF weights, term frequencies damped by a logarithm."""
    counts = gram_counts(text)
    at = np.flatnonzero(counts)
    w = (1 + np.log(counts[at])) * idf[at]
    length = np.sqrt((w * w).sum())
    return at, w / length if length else w


@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x labels, then a row of biases
    temperature: float = 1.0

    def logits(self, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        return w @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*gram_vector(text, self.idf)) / self.temperature)
        best = int(p.argmax())  # ties: the label that sorts first
        return self.labels[best], float(min(1.0, p[best]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal over the rows in turn; the last row of the result is the bias, which is not shrunk."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    l1 = np.full((BUCKETS + 1, 1), L1 / 10)
    l1[-1] = 0
    rng = np.random.default_rng(7)

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i][0], BUCKETS), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y[i]] -= 1
            g = x[:, None] * p[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(np.arange(BUCKETS + 1))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()

    low, high, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id's text is divisible by 5. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _document_frequencies(train: DataFrame) -> np.ndarray:
    """Number of documents and, per bucket, of documents with it; last entry the total. Sums have a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found[:-1] += gram_counts(text) > 0
                found[-1] += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["bucket", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for row in train.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def set_apart(n: int, max_fit: int, max_calibrate: int) -> np.ndarray:
    """Which of ``n`` rows in order of their hashes the temperature is fitted on: a fixed share, never the first."""
    i = np.arange(n)
    return (i + 1) * max_calibrate // (max_fit + max_calibrate) > i * max_calibrate // (max_fit + max_calibrate)


def _cuts(docs: DataFrame, rows: list[tuple[str, int]]) -> DataFrame:
    """(lang, cut) as a local table, whose size Spark knows, and which needs no Python workers to be read."""
    return docs.sparkSession.createDataFrame(pa.table(
        {"lang": pa.array([x for x, _ in rows], pa.string()), "cut": pa.array([c for _, c in rows], pa.int64())}))


def fit_language_model(docs: DataFrame, max_fit: int = MAX_FIT, max_calibrate: int = MAX_CALIBRATE) -> LanguageModel:
    """Learn from text and non-null lang of documents that ``held_out`` does not name.

    Languages are all that occur in these documents, and document frequencies use all of them. The sample are at most
    ``max_fit + max_calibrate`` documents, or one of each language where there are more: of each language those with
    the least hashes, in equal numbers as far as it has as many; copies of a document count once in it. Of each
    language, at every size, the temperature sees ``max_calibrate`` in so many and the regression the others. Biases
    are then corrected for the languages' shares among all documents. The sample goes to the driver as sparse vectors.
    Without labelled documents every prediction is ``und``.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    train = slim.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    seen = _document_frequencies(train)
    idf = np.log((1.0 + seen[-1]) / (1.0 + seen[:-1])) + 1.0
    order = F.xxhash64("doc_id", "lang", "text")
    if not seen[-1]:
        return LanguageModel([], idf, np.zeros((BUCKETS + 1, 0)))
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def vectors(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [gram_vector(x, shared.value) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([a.astype("<i4").tobytes() for a, _ in rows], pa.binary()),
             pa.array([w.astype("<f4").tobytes() for _, w in rows], pa.binary()), batch.column(2)], ["doc_id", "at", "w", "lang"])

    by_lang = train.select("lang", order.alias("o")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o").alias("different")).collect()
    most = {x: max(1, q) for x, q in quotas({r.lang: r.different for r in by_lang}, max_fit + max_calibrate).items()}
    # about twice as many as wanted pass the first cut; the exact ones follow from their hashes alone
    cuts = [(r.lang, int(-(2**63) + min(1.0, (2 * most[r.lang] + 100) / r.different) * (2**64 - 1))) for r in by_lang]
    cuts = [(x, min(c, 2**63 - 1)) for x, c in cuts]
    found: dict[str, list[int]] = {x: [] for x in most}
    marked = train.withColumn("o", order)
    near = marked.join(_cuts(docs, cuts), "lang").where("o <= cut")
    for r in near.select("lang", "o").distinct().collect():
        found[r.lang].append(r.o)
    exact = [(x, sorted(o)[min(most[x], len(o)) - 1]) for x, o in found.items() if o]
    chosen = marked.join(_cuts(docs, exact), "lang").where("o <= cut")
    sample = chosen.dropDuplicates(["lang", "o"]).select("doc_id", "text", "lang").mapInArrow(
        per_batch(vectors, 500), "doc_id long, at binary, w binary, lang string")
    rows = sample.collect()
    rows.sort(key=lambda r: (r.lang, zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.w))
    labels = sorted(most)
    name = {x: i for i, x in enumerate(labels)}
    x = [(np.frombuffer(r.at, "<i4"), np.frombuffer(r.w, "<f4").astype(float)) for r in rows]
    y = np.array([name[r.lang] for r in rows])
    drawn = np.bincount(y, minlength=len(labels))
    kept_apart = np.concatenate([set_apart(n, max_fit, max_calibrate) for n in drawn])  # rows are in order of language
    model = LanguageModel(labels, idf, fit_ftrl([v for v, out in zip(x, kept_apart) if not out], y[~kept_apart], len(labels)))
    apart = np.flatnonzero(kept_apart)
    if len(apart):
        model.temperature = fit_temperature(np.array([model.logits(*x[i]) for i in apart]), y[apart])
    share = np.array([r.n for r in sorted(by_lang, key=lambda r: name[r.lang])]) / int(seen[-1])
    model.weights[-1] += model.temperature * np.log(share / (drawn / len(rows)))
    return model


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents with all their columns and ``lang_pred``, ``score`` (replacing columns of these names).

    ``und`` with score 0 for a null text or one without a letter. Only the text is looked at.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = keep.index("text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [shared.value.predict(x) for x in batch.column(at).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())],
            [*keep, "lang_pred", "score"])

    slim = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*slim.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return slim.mapInArrow(per_batch(run, 500), schema)


def identify_languages(docs: DataFrame, **bounds: int) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document row.

    Rows with one doc_id are predicted one by one. An empty table gives an empty result; without labelled rows to
    learn from all are ``und``.
    """
    model = fit_language_model(docs, **bounds)
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def crc_bucket(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5


def in_known_languages(docs: DataFrame, least_score: float = LEAST_SCORE, **bounds: int) -> DataFrame:
    """Documents, with all their columns, whose language is told with a score of ``least_score`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_language_model(docs, **bounds))
    at = docs.columns.index("text")

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        told = [shared.value.predict(x) for x in batch.column(at).to_pylist()]
        yield batch.filter(pa.array([x != UNKNOWN and p >= least_score for x, p in told], pa.bool_()))

    return docs.mapInArrow(per_batch(keep, 500), docs.schema)
