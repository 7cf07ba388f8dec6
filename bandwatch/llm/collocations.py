"""Phrase collocations by the SON partitioning scheme.

A phrase found in a whole language at least ``support`` times reaches its share of that
support in at least one shard of it. So the shards are mined first, each completely
and at its own proportionally lowered support, level by level: a phrase of k words is
counted only where both its phrases of k - 1 words are frequent in the shard. The
union of what shards find frequent is then counted over all documents, exactly.

The number of shards is fixed, so that local supports do not fall as the corpus
grows; a shard may span many tasks, whose counts Spark adds up. Mining works on hashes
and hands on bitmaps of fixed size: a collision can add a candidate, never lose one.
Final counts are by the phrase's own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.stage import small_batches, staged
from bandwatch.operators.skew import top_k_per_group

LONGEST = 5
SUPPORT = 100
TOP = 2000
SHARDS = 8
FILTER_BITS = 26  # of the bitmap between levels: 8 MB at any size of the corpus
BITMAP_BITS = 1 << 15  # of a row of Spark's bitmap_construct_agg
BUFFER = 1 << 20  # words counted at a time in the mining
STRETCH = 1 << 16  # words hashed at a time
LOT = 1 << 18  # words counted at a time in the final count
MOST_WORDS = 200_000  # distinct words a task keeps ids for at a time, in all languages
MOST_PHRASES = 1_000_000  # candidates a task keeps counts of at a time
TASKS_A_CORE = 2  # of the final count
UNKNOWN = "und"

# A-Z in lower case; tab a space; marks that end a piece a full stop
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else 46 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case, with a full stop between pieces."""
    return text.translate(_FOLD).replace(b".", b" . ").split()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_keys(h: np.ndarray, k: int, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of a language's phrases of ``k`` words; ``h`` holds word hashes, 0 between pieces."""
    n = max(0, len(h) - k + 1)
    whole = np.ones(n, bool)
    total = np.full(n, xxhash.xxh64_intdigest(lang), np.uint64)
    for i in range(k):
        part = h[i:i + n]
        whole &= part != 0
        total += part * np.uint64(FACTORS[i])
    at = np.flatnonzero(whole)
    return at, mix(total[at])


def passes(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys >> np.uint64(64 - FILTER_BITS)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def filter_of(frequent: DataFrame, key: Column) -> np.ndarray:
    """Bitmap of the leading bits of ``key``; built by aggregates, its size is fixed."""
    bit = F.shiftrightunsigned(key, 64 - FILTER_BITS)
    rows = (
        frequent.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits"))
        .collect()  # at most 2**11 rows of 4 KB
    )
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    size = BITMAP_BITS >> 3
    for row in rows:
        out[(row.chunk - 1) * size:row.chunk * size] = np.frombuffer(row.bits, np.uint8)
    return out


class _Ids(dict):
    """Word to number; number 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})
        self.words = [b"."]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def take(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _word_hash(word: bytes) -> int:
    return (xxhash.xxh64_intdigest(word) >> 32) or 1


def shard_words(docs: DataFrame, shards: int) -> DataFrame:
    """(lang, salt, words, h): documents as 32-bit word hashes, 0 between pieces.

    A task belongs to one shard; ``salt`` names a language's part of a shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, table = _Ids(), np.zeros(1, np.uint32)
        shard = TaskContext.get().partitionId() % shards
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                out, words = [], []
                for text in part.column(1):
                    if len(ids) > MOST_WORDS:
                        ids, table = _Ids(), np.zeros(1, np.uint32)
                    found = ids.take(tokens(text.as_buffer().to_pybytes()))
                    if len(ids) > len(table):
                        new = [_word_hash(w) for w in ids.words[len(table):]]
                        table = np.concatenate([table, np.array(new, np.uint32)])
                    h = table[found]
                    words.append(int(np.count_nonzero(h)))
                    out.append(h.tobytes())
                salt = [xxhash.xxh64_intdigest(f"{x} {shard}") - (1 << 63) for x in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(salt, pa.int64()), pa.array(words, pa.int64()), pa.array(out, pa.binary())],
                    ["lang", "salt", "words", "h"])

    return docs.mapInArrow(run, "lang string, salt long, words long, h binary")


def _in_buffers(batches: Iterator[pa.RecordBatch], bytes_a_word: int, lot: int | None = None) -> Iterator[tuple[tuple, list]]:
    """((...), values) of a task's rows, grouped by all columns but the last, in lots of some ``lot`` words (``BUFFER``)."""
    lot = lot or BUFFER
    held: dict[tuple, list] = {}
    sizes: dict[tuple, int] = {}
    for batch in batches:
        *groups, data = batch.columns
        for g, x in zip(zip(*[c.to_pylist() for c in groups]), data):
            x = x.as_buffer()
            held.setdefault(g, []).append(x.to_pybytes())
            sizes[g] = sizes.get(g, 0) + x.size // bytes_a_word + 1
            if sizes[g] >= lot or sum(sizes.values()) >= 2 * lot:
                most = max(sizes, key=sizes.__getitem__)
                sizes.pop(most)
                yield most, held.pop(most)
    for g in list(held):
        yield g, held.pop(g)


def _stretches(parts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Word hashes of a lot, 0 between documents, some at a time; every phrase of ``k`` words is whole in exactly one."""
    h = np.concatenate([y for x in parts for y in (np.frombuffer(x, np.uint32), np.zeros(1, np.uint32))])
    for start in range(0, len(h), STRETCH):
        yield h[start:start + STRETCH + k - 1].astype(np.uint64)


def local_counts(words: DataFrame, k: int, shorter: np.ndarray | None) -> DataFrame:
    """(salt, key, n) of phrases of ``k`` words whose phrases of ``k - 1`` words both pass the filter ``shorter``; ``key`` is a
    phrase's hash in its language."""
    shared = words.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, salt), parts in _in_buffers(batches, 4):
            some = []
            for h in _stretches(parts, k):
                at, keys = gram_keys(h, k, lang)
                if k > 1:
                    inner, known = gram_keys(h, k - 1, lang)
                    frequent = np.zeros(len(h) + 1, bool)
                    frequent[inner[passes(shared.value, known ^ np.int64(salt).view(np.uint64))]] = True
                    keys = keys[frequent[at] & frequent[at + 1]]
                some.append(keys)
            keys, n = np.unique(np.concatenate(some), return_counts=True)
            for start in range(0, len(keys), 1 << 16):
                some = keys[start:start + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), salt)), pa.array(some), pa.array(n[start:start + (1 << 16)])], ["salt", "key", "n"])

    return words.select("lang", "salt", "h").mapInArrow(run, "salt long, key long, n long")


def local_supports(words: DataFrame, support: int) -> DataFrame:
    """(salt, need, rest): a language's support in a shard, and the most it can have without being frequent in any shard."""
    sizes = words.groupBy("lang", "salt").agg(F.sum("words").cast("decimal(20,0)").alias("words")).where("words > 0")
    whole = sizes.groupBy("lang").agg(F.sum("words").alias("all"))
    need = staged(sizes.join(whole, "lang").select(
        "lang", "salt", F.ceil(F.col("words") * support / F.col("all")).cast("long").alias("need")), "shard-supports")
    rest = need.groupBy("lang").agg(F.sum(F.col("need") - 1).alias("rest"))
    return need.join(rest, "lang").groupBy("salt").agg(F.min("need").alias("need"), F.max("rest").alias("rest"))


def possible(local: DataFrame, supports: DataFrame, support: int) -> DataFrame:
    """(key, salts): phrases that are frequent in the shards ``salts`` and can reach ``support`` over all.

    A shard that counted a phrase holds it as often, one that did not at most as often as keeps it below the local
    support. All rows of a phrase are placed together once, for the counts by shard and for the bound.
    """
    per_shard = local.repartition("key").groupBy("key", "salt").agg(F.sum("n").alias("n")).join(supports, "salt")
    bound = F.sum("n") + F.max("rest") - F.sum(F.col("need") - 1)
    return per_shard.groupBy("key").agg(
        bound.alias("most"), F.collect_list(F.when(F.col("n") >= F.col("need"), F.col("salt"))).alias("salts")).where(
        (F.col("most") >= support) & (F.size("salts") > 0)).select("key", "salts")


def words_of_phrases(words: DataFrame, pairs: np.ndarray) -> DataFrame:
    """(key) of the words that stand in a frequent phrase of two words: the only ones whose counts are asked for.

    A task gives a word once, not once a lot.
    """
    shared = words.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, np.uint64)
        for (lang, salt), parts in _in_buffers(batches, 4):
            some = []
            for h in _stretches(parts, 2):
                at, keys = gram_keys(h, 2, lang)
                at = at[passes(shared.value, keys ^ np.int64(salt).view(np.uint64))]
                some.append(np.unique(np.concatenate([h[at], h[at + 1]])))
            found = np.union1d(found, gram_keys(np.unique(np.concatenate(some)), 1, lang)[1])
            if len(found) >= BUFFER:
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["key"])
                found = found[:0]
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["key"])

    return words.select("lang", "salt", "h").mapInArrow(run, "key long").distinct()


def mined(words: DataFrame, support: int, longest: int) -> list[np.ndarray]:
    """For every length a filter of the phrases that are frequent in a shard, by their hash in their language."""
    supports = staged(local_supports(words, support), "local-supports")
    shorter, found = None, []
    for k in range(1, longest + 1):
        frequent = staged(possible(local_counts(words, k, shorter), supports, support), f"frequent-{k}")
        shorter = filter_of(frequent.select("key", F.explode("salts").alias("salt")), F.col("key").bitwiseXOR(F.col("salt")))
        found.append(filter_of(frequent, F.col("key")))
        if k == 2:
            found[0] &= filter_of(words_of_phrases(words, shorter), F.col("key"))
    return found


class _Counts:
    """Counts of one language's candidates in a task, over all of its lots.

    Words that are no candidates are as the end of a piece: nothing that holds one is a candidate. A phrase is told by
    the number of its first k - 1 words' phrase and that of its last word, both kept for as long as the task runs.
    """

    def __init__(self, lang: str, found: list[np.ndarray]):
        self.lang, self.found = lang, found
        self.forget_words()  # ``numbers`` of all words met lately: 0, or the number of a candidate
        self.known: dict[bytes, int] = {}
        self.words, self.h = [b"."], np.zeros(1, np.uint64)
        # by length from two words on: (pair, phrase) in order of the pairs, and counts in order of the phrases
        self.pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.found[1:]]
        self.n = [np.zeros(0, np.int64) for _ in self.found]

    def __len__(self) -> int:
        return sum(map(len, self.n))

    def forget_words(self) -> None:
        """Ids of all words met go; numbers of candidates stay."""
        self.ids, self.numbers = _Ids(), np.zeros(1, np.int64)

    def _number(self, new: list[bytes]) -> np.ndarray:
        h = np.array([_word_hash(w) for w in new], np.uint64)
        is_candidate = np.zeros(len(new), bool)
        at, keys = gram_keys(h, 1, self.lang)
        is_candidate[at] = passes(self.found[0], keys)
        out = np.zeros(len(new), np.int64)
        for i in np.flatnonzero(is_candidate).tolist():
            if (word := new[i]) not in self.known:
                self.known[word] = len(self.words)
                self.words.append(word)
            out[i] = self.known[word]
        self.h = np.concatenate([self.h, np.array([_word_hash(w) for w in self.words[len(self.h):]], np.uint64)])
        return out

    def add(self, texts: list[bytes]) -> None:
        parts = []
        for text in texts:
            if len(self.ids) > MOST_WORDS:
                self.forget_words()
            place = self.ids.take(tokens(text))
            if len(self.ids) > len(self.numbers):
                self.numbers = np.concatenate([self.numbers, self._number(self.ids.words[len(self.numbers):])])
            parts += [self.numbers[place], np.zeros(1, np.int64)]
        number = np.concatenate(parts)
        h = self.h[number]
        counts = np.bincount(number, minlength=len(self.words))[1:]
        self.n[0] = counts + np.pad(self.n[0], (0, len(counts) - len(self.n[0])))
        rank, wanted = number, np.append(number != 0, False)
        for k in range(2, len(self.found) + 1):
            at, keys = gram_keys(h, k, self.lang)
            at = at[passes(self.found[k - 1], keys)]
            at = at[wanted[at] & wanted[at + 1]]  # parts of a candidate are candidates
            pair, place, n = np.unique(rank[at] << np.int64(32) | number[at + k - 1], return_inverse=True, return_counts=True)
            phrase = self._phrases(k, pair)
            np.add.at(self.n[k - 1], phrase, n)
            wanted = np.zeros(len(h) + 1, bool)
            wanted[at] = True
            rank = np.zeros(len(h), np.int64)
            rank[at] = phrase[place]

    def _phrases(self, k: int, pair: np.ndarray) -> np.ndarray:
        """Numbers of phrases of ``k`` words; new ones get the next."""
        known, phrase = self.pairs[k - 2]
        at = np.searchsorted(known, pair)
        new = np.ones(len(pair), bool)
        inside = at < len(known)
        new[inside] = known[at[inside]] != pair[inside]
        if new.any():
            known = np.insert(known, at[new], pair[new])
            phrase = np.insert(phrase, at[new], np.arange(len(phrase), len(known)))
            self.pairs[k - 2] = known, phrase
            self.n[k - 1] = np.pad(self.n[k - 1], (0, len(known) - len(self.n[k - 1])))
            at = np.searchsorted(known, pair)
        return phrase[at]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Phrases are spelled out 2**14 at a time, from their last word back to the first."""
        pairs = []
        for known, phrase in self.pairs:
            pairs.append(np.zeros(len(phrase), np.int64))
            pairs[-1][phrase] = known
        for k, n in enumerate(self.n, 1):
            for start in range(0, len(n), 1 << 14):
                some = n[start:start + (1 << 14)]
                phrase, words = np.arange(start, start + len(some)), []
                for longer in reversed(pairs[:k - 1]):
                    words.append(longer[phrase] & np.int64(0xFFFFFFFF))
                    phrase = longer[phrase] >> np.int64(32)
                words.append(phrase + (k == 1))  # words are numbered from 1
                spelled = [b" ".join([self.words[i] for i in of]) for of in zip(*[w.tolist() for w in reversed(words)])]
                texts = pa.array(spelled, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.lang] * len(some), pa.string()), pa.array([k] * len(some), pa.int32()), texts, pa.array(some)],
                    ["lang", "k", "phrase", "n"])


def counted(docs: DataFrame, found: list[np.ndarray]) -> DataFrame:
    """(lang, k, phrase, n): exact counts over all documents of at least all candidates.

    A task gives a phrase once, or once each time it holds ``MOST_PHRASES``, and there are no more tasks than keep the
    cluster busy: with a task for each part of the input, each giving nearly all phrases, rows would grow with the
    product of both.
    """
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Counts] = {}
        for (lang,), texts in _in_buffers(batches, 6, min(LOT, BUFFER)):
            if lang not in held:
                held[lang] = _Counts(lang, shared.value)
            if sum(len(x.ids) for x in held.values()) > MOST_WORDS:
                for counts in held.values():
                    counts.forget_words()
            held[lang].add(texts)
            if sum(map(len, held.values())) > MOST_PHRASES:
                for counts in held.values():
                    yield from counts.rows()
                held = {}
        for lang in list(held):
            yield from held.pop(lang).rows()

    tasks = TASKS_A_CORE * docs.sparkSession.sparkContext.defaultParallelism
    rows = docs.coalesce(tasks).mapInArrow(run, "lang string, k int, phrase string, n long")
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, k, phrase, a, l, r, n, score of phrases of two words and more, by their lowest-scoring cut."""
    known = counts.select("lang", "phrase", F.col("n").alias("f"))
    parts = F.split("phrase", " ")
    cuts = counts.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "*", F.array_join(F.slice(parts, F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice(parts, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("tail"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    made = (
        cuts.join(known.withColumnsRenamed({"phrase": "head", "f": "l"}), ["lang", "head"])
        .join(known.withColumnsRenamed({"phrase": "tail", "f": "r"}), ["lang", "tail"]).join(totals, "lang")
        .withColumns({"_above": wide("a") * wide("n"), "_below": wide("l") * wide("r")})
        .withColumn("_score", F.expr("(_above * 1000BD) div _below"))
    )
    best = F.min_by(F.struct("l", "r", F.col("_score").alias("score")), F.struct("_score", "cut")).alias("_b")
    return made.groupBy("lang", "k", "phrase", "a", "n").agg(best).select("lang", "k", "phrase", "a", "_b.l", "_b.r", "n", "_b.score")


def within_longer(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): for phrases inside longer ones, the largest count of those."""
    parts, k = F.split("phrase", " "), F.col("k")
    spans = phrases.where("k > 2").select("lang", "a", "k", parts.alias("w"), F.explode(F.sequence(F.lit(2), k - 1)).alias("size"))
    inner = spans.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), k - F.col("size") + 1)).alias("at"))
    return inner.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, longest: int = LONGEST, shards: int = SHARDS,
                 absorbed: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of every language.

    Words are runs of anything but space and tab within pieces that end at ``. , ; : ! ?`` and at line ends, A-Z in
    lower case. ``n`` counts a language's words, ``a`` a phrase's contiguous occurrences; phrases with at least
    ``support`` of them are candidates. Each is scored floor(1000 a n / (l r)) with the counts of the two parts of its
    lowest-scoring cut. A candidate inside a longer one that occurs at least ``absorbed`` % as often is dropped. Order:
    score and ``a`` from the largest, then the phrase.

    Null lang counts as ``und``, null text as empty; rows of one doc_id count one by one, and copies each time. Texts
    without words add nothing; a language without candidates has no rows, an empty table none. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = staged(shard_words(slim, shards), "shard-words")
    totals = words.groupBy("lang").agg(F.sum("words").alias("n"))
    counts = staged(counted(slim, mined(words, support, longest)).where(F.col("n") >= support), "phrase-counts")
    candidates = staged(scored(counts, totals), "phrases")
    kept = candidates.join(within_longer(candidates), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * absorbed))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return top_k_per_group(kept, ["lang"], order, top, ["phrase"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
