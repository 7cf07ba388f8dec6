"""Quality by ordinal regression on graded ratings.

A cumulative-link model: one weight per hashed word and word stem, shared by all grades,
and one ordered threshold between neighbouring grades. P(grade <= k) is the logistic function
of threshold k less the text's sum. It gives an expected grade and the probability of
reaching a grade, by which documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.shingles import PART, byte_word_hashes, mix
from bandwatch.llm.stage import below_share, per_batch, quotas, staged

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
MAX_FIT = 8000  # rated documents the model is fitted on, of each grade those with the least hashes
EPOCHS = 10
RATE, L1, L2 = 1.5, 8.0, 0.5
LEAST_DOCS = 4  # of the fitted ones that must hold a word for it to count
GRADES = ("toxic", "low", "good")
STEM = 4  # characters of a stem; shorter words have none
WORD_WEIGHT, STEM_WEIGHT = 0.3, 75  # of a word that occurs; of a stem's share among words, up to 1

#: A-Z in lower case; letters, digits and bytes of other scripts make words, any other byte is a word of its own kind
_LETTER = [48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)]
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ONLY_WORDS = bytes(b if _LETTER[b] else 32 for b in LOWER)
ONLY_MARKS = bytes(32 if _LETTER[b] or b < 33 else b for b in LOWER)


def grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 low quality, 2 good; null where neither label tells."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def stem_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the first ``STEM`` characters of every word that has as many, in lower case of any script."""
    data = text.lower().encode().translate(ONLY_WORDS)
    found, begin = [np.empty(0, np.uint64)], 0
    while begin < len(data):
        end = data.find(b" ", begin + PART) + 1 or len(data)
        b = np.frombuffer(data[begin:end] + b" ", np.uint8)
        begin = end
        letter = b != 32
        starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
        chars = np.append(np.flatnonzero((b & 0xC0) != 0x80), len(b))  # first bytes of characters, spaces among them
        nth = np.searchsorted(chars, starts)
        ends = chars[np.minimum(nth + STEM, len(chars) - 1)]
        last = chars[np.minimum(nth + STEM - 1, len(chars) - 1)]
        whole = np.concatenate([[0], np.cumsum(~letter, dtype=np.int32), [len(b)]])
        good = whole[np.minimum(last + 1, len(b))] == whole[starts]  # no space up to the last character
        starts, ends = starts[good], ends[good]
        h = (ends - starts).astype(np.uint64)
        for i in range(4 * STEM):
            more = starts + i < ends
            if not more.any():
                break
            h = np.where(more, h * np.uint64(0x100000001B3) + b[np.minimum(starts + i, len(b) - 1)], h)
        found.append(mix(h))
    return np.concatenate(found)


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words, stems and runs of marks of a whole text, with weights.

    A word counts once however often it occurs, so that one insult in a long text weighs what it does in a short
    one; stems, which stand for all endings of a word, and marks weigh by their share among words.
    """
    data = (text or "").encode()
    words, marks = byte_word_hashes(data.translate(ONLY_WORDS)), byte_word_hashes(data.translate(ONLY_MARKS))
    known = np.unique(words >> np.uint64(64 - BUCKET_BITS))
    run, n = np.unique(marks >> np.uint64(64 - BUCKET_BITS), return_counts=True)
    stem, often = np.unique(stem_hashes(text or "") >> np.uint64(64 - BUCKET_BITS), return_counts=True)
    at = np.concatenate([known, stem, run]).astype(np.int64)
    total = max(1, len(words))
    return at, np.concatenate([np.full(len(known), WORD_WEIGHT), np.minimum(1, STEM_WEIGHT * often / total), np.minimum(1, 10 * n / total)])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades

    def above(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...; falls with k."""
        return sigmoid(x @ self.weights[at] - self.thresholds)


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, grades: int, epochs: int = EPOCHS) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model with per-coordinate rates and an elastic net.

    Weights follow the regularised leader, so words that tell nothing stay at zero. Thresholds are a first one and
    the logarithms of the gaps after it, so they stay in order.
    """
    share = np.bincount(y, minlength=grades) / max(1, len(y))
    seen = np.zeros(BUCKETS, np.int32)
    for at, _ in rows:
        seen[np.unique(at)] += 1
    rows = [(at[keep], x[keep]) for at, x in rows for keep in [seen[at] >= LEAST_DOCS]]
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)

    def weights(at: np.ndarray) -> np.ndarray:
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0) / ((1 + np.sqrt(n[at])) / RATE + L2)

    below = np.clip(np.cumsum(share)[:-1], 0.02, 0.98)
    first = np.log(below / (1 - below))
    t = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    t2 = np.full(len(t), 10.0)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            cut = np.concatenate([t[:1], t[:1] + np.cumsum(np.exp(t[1:]))])
            s = x @ w
            high = sigmoid(cut[y[i]] - s) if y[i] < grades - 1 else 1.0
            low = sigmoid(cut[y[i] - 1] - s) if y[i] > 0 else 0.0
            p = max(high - low, 1e-9)
            up, down = high * (1 - high) / p, low * (1 - low) / p  # derivatives of log p by the two cuts
            g = (up - down) * x  # of the loss by the weights
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / RATE * w
            n[at] += g * g
            gc = np.zeros(grades - 1)
            if y[i] < grades - 1:
                gc[y[i]] -= up
            if y[i] > 0:
                gc[y[i] - 1] += down
            gt = np.concatenate([[gc.sum()], [gc[k:].sum() * np.exp(t[k]) for k in range(1, grades - 1)]])
            t2 += gt * gt
            t -= RATE / np.sqrt(t2) * gt
    return OrdinalModel(weights(np.arange(BUCKETS)), np.concatenate([t[:1], t[:1] + np.cumsum(np.exp(t[1:]))]))


def fit_thresholds(model: OrdinalModel, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Thresholds of greatest likelihood when row i counts ``weight[i]`` times and the words' weights stay."""
    s = np.array([x @ model.weights[at] for at, x in rows])
    t = np.concatenate([model.thresholds[:1], np.log(np.maximum(np.diff(model.thresholds), 1e-3))])
    t2, last = np.full(len(t), 1e-9), len(t)
    for _ in range(1000):
        cut = np.concatenate([t[:1], t[:1] + np.cumsum(np.exp(t[1:]))])
        high = np.where(y < last, sigmoid(cut[np.minimum(y, last - 1)] - s), 1.0)
        low = np.where(y > 0, sigmoid(cut[np.maximum(y - 1, 0)] - s), 0.0)
        p = np.maximum(high - low, 1e-9)
        gc = np.bincount(np.maximum(y - 1, 0), weight * low * (1 - low) / p, last) - np.bincount(
            np.minimum(y, last - 1), weight * high * (1 - high) / p, last)
        gt = np.array([gc.sum(), *(gc[k:].sum() * np.exp(t[k]) for k in range(1, last))]) / weight.sum()
        t2 += gt * gt
        t -= 0.5 / np.sqrt(t2) * gt
    return np.concatenate([t[:1], t[:1] + np.cumsum(np.exp(t[1:]))])


def fit_quality(docs: DataFrame, ratings: DataFrame, grades: int = len(GRADES), max_fit: int = MAX_FIT) -> OrdinalModel:
    """Fit on documents with a rating, ``ratings`` being (doc_id, grade) with grades from 0 on.

    At most ``max_fit`` rated documents go to the driver as sparse vectors: of each grade those whose ids have the
    least hashes, in equal numbers as far as a grade has as many. Thresholds are then fitted again with the shares
    that grades have among all rated documents. A document rated more than once has its lowest grade. Without ratings every grade is as likely
    as any other.
    """
    rated = staged(ratings.where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade")), "rated")
    totals = {r["grade"]: r["n"] for r in rated.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id")
    chosen = rated.limit(0).select("doc_id", "grade")
    for k, quota in quotas(totals, max_fit).items():
        least = rated.where((F.col("grade") == k) & below_share(order, quota, totals[k]))
        chosen = chosen.unionByName(least.orderBy(order, "doc_id").limit(quota).select("doc_id", "grade"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def vectors(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [text_features(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([a.astype("<i4").tobytes() for a, _ in rows], pa.binary()),
             pa.array([x.astype("<f4").tobytes() for _, x in rows], pa.binary())], ["doc_id", "grade", "at", "x"])

    sample = texts.join(staged(chosen, "ratings"), "doc_id").mapInArrow(
        per_batch(vectors), "doc_id long, grade int, at binary, x binary")
    # where documents repeat, their rows are more than the bound: another hash, so that no grade is cut more than others
    rows = sample.orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id", "at").limit(max_fit).collect()
    if not rows:
        even = np.arange(1, grades) / grades
        return OrdinalModel(np.zeros(BUCKETS), np.log(even / (1 - even)))
    x = [(np.frombuffer(r.at, "<i4"), np.frombuffer(r.x, "<f4").astype(float)) for r in rows]
    y = np.array([r.grade for r in rows])
    model = fit_ordinal(x, y, grades)
    share = np.array([totals.get(k, 0) for k in range(grades)]) / sum(totals.values())
    model.thresholds = fit_thresholds(model, x, y, share[y] / np.bincount(y, minlength=grades)[y] * len(y))
    return model


def grade_documents(docs: DataFrame, model: OrdinalModel, least_grade: int = 1, least_probability: float = 0.8) -> DataFrame:
    """doc_id, expected_grade, p_at_least_1, ..., keep for every document row.

    ``keep``: the probability of ``least_grade`` or more is at least ``least_probability``. Null or empty text has
    no words and gets what the thresholds alone say. Rows are graded one by one, repeated and null ids included;
    other columns are not read.
    """
    tails = [f"p_at_least_{k + 1}" for k in range(len(model.thresholds))]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [shared.value.above(*text_features(x)) for x in batch.column(1).to_pylist()]
        p = np.array(found).reshape(-1, len(tails))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(p.sum(axis=1)), *(pa.array(p[:, k].copy()) for k in range(len(tails))),
             pa.array(p[:, least_grade - 1] >= least_probability)], ["doc_id", "expected_grade", *tails, "keep"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(
        per_batch(run), "doc_id long, expected_grade double, " + "".join(f"{t} double, " for t in tails) + "keep boolean")


def document_quality(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """``grade_documents`` with a model fitted on the quality and toxic labels: 0 toxic, 1 low quality, 2 good."""
    ratings = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade(F.col("quality"), F.col("toxic")).cast("int").alias("grade"))
    return grade_documents(docs, fit_quality(docs, ratings, **bounds))
