"""Benchmark passages in documents, by SimHash of item-sized windows.

A window of as many words as an item has gets a 64-bit SimHash over its weighted
shingles, weights being how often they occur. Items are indexed by several blocks of
their fingerprint's bits: two fingerprints within the radius differ in at most
``radius // blocks`` bits of some block, and every such block value is listed, so a
lookup misses none. Candidates within the radius are verified with the exact weighted
Jaccard similarity of their shingles.

Only windows that share a shingle with an item are fingerprinted: others have a
similarity of zero. The distinct texts of a benchmark go out to the tasks in parts of
bounded size, one after the other: what a part matches is written before the next one is
fetched, so neither the driver nor a task holds more than one. Each part meets all documents.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.shingles import byte_word_hashes, mix, shingle_hashes
from bandwatch.llm.stage import id_and_text, per_batch, staged
from bandwatch.session import work_dir

SHINGLE = 5
SIMILARITY = 0.8
# Two bags at similarity 0.8 differ in about 15 % of 64 bits, 9.7 with a deviation of 2.9
RADIUS = 23
BLOCKS = (11, 11, 11, 11, 10, 10)
PART_CHARS = 400_000  # of benchmark text sent to tasks at a time
RUN = 4096  # windows fingerprinted at a time

#: A-Z in lower case, ASCII marks as spaces, so that quoting and punctuation do not matter
PLAIN = bytes(32 if 33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_words(text: str | None) -> np.ndarray:
    return byte_word_hashes((text or "").encode().translate(PLAIN))


def fingerprints(shingles: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of the ``size`` shingles from each start; every occurrence counts."""
    low, high = int(starts[0]), int(starts[-1]) + size
    bits = np.unpackbits(mix(shingles[low:high]).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    votes = sums[starts - low + size] - sums[starts - low]
    return np.packbits(votes > 0, axis=1).view(np.uint64).ravel()


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller over sum of the larger weights."""
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 0.0


class BlockIndex:
    """Fingerprints of items by the values of their bit blocks, near values included."""

    def __init__(self, prints: list[int], radius: int = RADIUS, blocks: tuple[int, ...] = BLOCKS):
        self.prints, self.radius = np.array(prints, np.uint64), radius
        self.tables: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        near, shift = radius // len(blocks), 0
        for width in blocks:
            flips = np.array([sum(1 << i for i in bits) for k in range(near + 1) for bits in combinations(range(width), k)])
            keys = (self._block(self.prints, shift, width)[:, None] ^ flips[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            first = np.searchsorted(keys[order], np.arange((1 << width) + 1)).astype(np.int32)
            self.tables.append((shift, width, first, np.repeat(np.arange(len(prints), dtype=np.int32), len(flips))[order]))
            shift += width

    @staticmethod
    def _block(prints: np.ndarray, shift: int, width: int) -> np.ndarray:
        return ((prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def within(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place in ``prints``, item) of all pairs within the radius, in order."""
        met = []
        for shift, width, first, items in self.tables:
            key = self._block(prints, shift, width)
            low, n = first[key], first[key + 1] - first[key]
            place = np.repeat(np.arange(len(prints)), n)
            item = items[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            close = np.bitwise_count(prints[place] ^ self.prints[item]) <= self.radius
            met.append(place[close] * len(self.prints) + item[close])
        for pair in np.unique(np.concatenate(met)).tolist():
            yield divmod(pair, len(self.prints))


@dataclass
class Items:
    """One part of the benchmark's texts by their key, as tasks need it."""

    rows: list[tuple[str, str]]

    def prepare(self) -> None:
        self.by_size: dict[tuple[int, int], list[tuple[str, Counter, int]]] = defaultdict(list)  # (words, shingle words)
        shared: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in self.rows:
            words = plain_words(text)
            if not len(words):
                continue
            k = min(SHINGLE, len(words))
            sh = shingle_hashes(words, k)
            print_ = int(fingerprints(sh, len(sh), np.array([0]))[0])
            self.by_size[len(words), k].append((item_id, Counter(sh.tolist()), print_))
            for x in sh.tolist():
                shared[k][x].add(len(words))
        self.shared = {k: (np.array(sorted(v), np.uint64), v) for k, v in shared.items()}
        self.index = {key: BlockIndex([p for _, _, p in items]) for key, items in self.by_size.items()}

    def passages(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """Per matching item its place in ``order``: best similarity, first word of that window, its words."""
        words = plain_words(text)
        best: dict[tuple, tuple[float, int, int]] = {}
        for k, (known, sizes) in self.shared.items():
            sh = shingle_hashes(words, k)
            if not len(sh):
                continue
            spot = np.minimum(np.searchsorted(known, sh), len(known) - 1)
            anchors = np.flatnonzero(known[spot] == sh)
            if not len(anchors):
                continue
            by_size: dict[int, list[int]] = defaultdict(list)
            for p in anchors.tolist():
                for n in sizes[int(sh[p])]:
                    by_size[n].append(p)
            for n, places in by_size.items():
                width = min(n - k + 1, len(sh))  # shingles of a window; a shorter document is one window
                mark = np.zeros(len(sh) - width + 2, np.int32)
                at = np.array(places)
                np.add.at(mark, np.clip(at - width + 1, 0, len(mark) - 2), 1)
                np.add.at(mark, np.minimum(at, len(sh) - width) + 1, -1)
                starts = np.flatnonzero(np.cumsum(mark[:-1]))
                self._windows(sh, width, starts, (n, k), best)
        return best

    def _windows(self, sh: np.ndarray, width: int, starts: np.ndarray, key: tuple[int, int], best: dict) -> None:
        index, items = self.index[key], self.by_size[key]
        cuts = np.flatnonzero(np.diff(starts) > width) + 1
        for run in np.split(starts, cuts):
            for i in range(0, len(run), RUN):
                some = run[i:i + RUN]
                for place, item in index.within(fingerprints(sh, width, some)):
                    start = int(some[place])
                    s = weighted_similarity(Counter(sh[start:start + width].tolist()), items[item][1])
                    old = best.get((key, item), (0.0, 0, 0))
                    if s >= SIMILARITY and s > old[0]:  # ties: the first window
                        best[key, item] = (s, start, width + key[1] - 1)


def text_keys(benchmark: DataFrame, text: str) -> DataFrame:
    """(key, text) of the distinct texts, written out."""
    rows = benchmark.select(F.col(text).cast("string").alias("text")).where("text is not null")
    return staged(rows.select(F.md5("text").alias("key"), "text").dropDuplicates(["key"]), "benchmark-texts")


def parts(texts: DataFrame) -> Iterator[Items]:
    """The texts in parts of about PART_CHARS characters, each collected when it is asked for."""
    chars = texts.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = int(chars // PART_CHARS) + 1
    part = F.pmod(F.xxhash64("key"), F.lit(n))
    for i in range(n):
        yield Items([(r.key, r.text) for r in texts.where(part == i).orderBy("key").collect()])


def _matched(docs: DataFrame, texts: DataFrame, told: Callable[[Items, pa.RecordBatch], list[tuple]], layout: str) -> DataFrame:
    """Rows that ``told`` makes of batches of (doc_id, text) and each part, written part by part."""
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "benchmark-matches")
    for items in parts(texts):
        shared = spark.sparkContext.broadcast(items)
        names = [c.split()[0] for c in layout.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[c.split()[1]] for c in layout.split(", ")]

        def find(batch: pa.RecordBatch, shared=shared, names=names, kinds=kinds) -> Iterator[pa.RecordBatch]:
            held = shared.value
            if not hasattr(held, "index"):
                held.prepare()
            columns = list(zip(*told(held, batch))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        docs.mapInArrow(per_batch(find), layout).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(layout).parquet(path)


def _passages(held: Items, batch: pa.RecordBatch) -> list[tuple]:
    return [(doc_id, held.by_size[key][item][0], s, start, n)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for (key, item), (s, start, n) in sorted(held.passages(text).items())]


def _held(held: Items, batch: pa.RecordBatch) -> list[tuple]:
    return [(hashlib.md5(text.encode()).hexdigest(),) for text in batch.column(1).to_pylist() if held.passages(text)]


def benchmark_passages(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: a row per document row and item that a window of it matches.

    Words are runs of anything but ASCII white space and marks, A-Z in lower case. A window has as many words as the
    item (a document with fewer is one window); it matches at a weighted similarity of 0.8 or more over five-word
    shingles (items with fewer words: one shingle of them all). The row has the best window, the first of equal ones.

    Null or empty texts match nothing, on either side. Document rows and benchmark rows with equal ids are handled
    one by one; null ids are carried. Benchmark rows of one text are looked for once. Empty tables give an empty
    result. Other columns are not read.
    """
    found = _matched(id_and_text(docs), text_keys(benchmark, item_text), _passages,
                     "doc_id long, key string, similarity double, start_word long, n_words long")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.md5(F.col(item_text).cast("string")).alias("key"))
    return found.join(items, "key").select("doc_id", "item_id", "similarity", "start_word", "n_words")


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark passage, with all their columns. A row is judged by its own text."""
    found = _matched(id_and_text(docs), text_keys(benchmark, "text"), _held, "key string")
    mark = f"key_{uuid.uuid4().hex}"  # a name no column has
    dirty = found.select(F.col("key").alias(mark)).distinct()
    return docs.join(dirty, F.md5(docs["text"]) == dirty[mark], "left_anti")
