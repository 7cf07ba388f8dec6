"""Periodic runs of words, found through a recompression grammar.

The words of a lot of documents, numbered, are the bottom of a grammar that is built by
turns: block compression writes a stretch of one symbol as one symbol of the next
level, pair compression writes chosen neighbours as one. Equal symbols spell equal words,
so how far two places agree is read off the levels: up while both places begin a symbol
of the next one, then down where they differ, with a few steps on each level.

A run of period q and at least four periods holds two equal words at i and i + q for
some i on a grid of step 3 q; over all periods these grids have about n log(n) / 3 places. Each
one where the words agree is extended exactly in both directions. All places of a lot
are worked on together.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bandwatch.llm.stage import id_and_text

TIMES = 4  # periods that a run holds at least
SHORTEST = 6  # words of the shortest run
LOT = 1 << 17  # words worked on together; a longer document is a lot of its own
PLACES = 1 << 20  # grid places looked at together
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Level:
    """Symbols of a level and how they hang together with the next one."""

    symbol: np.ndarray
    up: np.ndarray | None = None  # place in the next level of the symbol that holds this one
    first: np.ndarray | None = None  # place of the first symbol held by each of the next level; one more at the end
    blocks: bool = False  # whether the next level writes stretches of one symbol


def _blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Next level's symbols and the first places of stretches of one symbol."""
    first = np.flatnonzero(np.diff(x, prepend=x[0] - 1))
    length = np.diff(first, append=len(x))
    name = x[first] * np.int64(length.max() + 1) + length
    return np.unique(name, return_inverse=True)[1], first


def _pairs(x: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Next level's symbols and the first places where a left symbol takes in a right one behind it; sides go by the symbol's hash."""
    h = (x.astype(np.uint64) + np.uint64(1 + 2 * turn)) * MIX
    left = ((h ^ (h >> np.uint64(29))) * MIX >> np.uint64(63)).astype(bool)
    joined = np.zeros(len(x), bool)  # with the symbol before
    joined[1:] = left[:-1] & ~left[1:]
    first = np.flatnonzero(~joined)
    second = np.minimum(first + 1, len(x) - 1)
    tail = np.where((second > first) & joined[second], x[second] + 1, 0)
    name = x[first] * np.int64(x.max() + 2) + tail
    return np.unique(name, return_inverse=True)[1], first


def grammar(words: np.ndarray, longest: int) -> list[Level]:
    """Levels over ``words``, until symbols span about ``longest`` words or nothing is left to write together."""
    levels = [Level(words)]
    span, turn = 1.0, 0
    while len(levels[-1].symbol) > 2 and span < longest:
        here = levels[-1]
        blocks = turn % 2 == 0
        symbol, first = _blocks(here.symbol) if blocks else _pairs(here.symbol, turn)
        turn += 1
        if len(first) == len(here.symbol):
            if turn > 60:
                break
            continue  # nothing to write together this time
        here.blocks = blocks
        here.first = np.append(first, len(here.symbol))
        here.up = np.repeat(np.arange(len(first)), np.diff(here.first))
        levels.append(Level(symbol))
        span = len(words) / len(symbol)
    return levels


def agree(levels: list[Level], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """The first places from ``i`` on, in direction ``step`` (1 or -1), whose word differs from the one as far on from ``j``.

    Both ends of the words must be unique, so that every comparison ends within them.
    """
    i, j = i.copy(), j.copy()
    rising = np.arange(len(i))  # those that have agreed all the way so far
    stopped: list[np.ndarray] = []

    def edge(level: Level, at: np.ndarray) -> np.ndarray:
        """Whether places are the outermost of their symbol above, seen in the direction."""
        up = level.up[at]
        return at == (level.first[up] if step > 0 else level.first[up + 1] - 1)

    def go(level: Level, some: np.ndarray) -> None:
        """One step of places that agree: over the rest of the shorter stretch, where stretches are written as one."""
        if level.blocks:
            a, b = level.up[i[some]], level.up[j[some]]
            if step > 0:
                n = np.minimum(level.first[a + 1] - i[some], level.first[b + 1] - j[some])
            else:
                n = np.minimum(i[some] - level.first[a], j[some] - level.first[b]) + 1
            i[some] += step * n
            j[some] += step * n
        else:
            i[some] += step
            j[some] += step

    for level in levels:
        if level.up is None:
            stopped.append(rising)
            break
        done, ready, some = [], [], rising
        while len(some):
            both = edge(level, i[some]) & edge(level, j[some])
            ready.append(some[both])
            some = some[~both]
            same = level.symbol[i[some]] == level.symbol[j[some]]
            done.append(some[~same])
            some = some[same]
            if len(some):
                go(level, some)
        stopped.append(np.concatenate(done) if done else rising[:0])
        rising = np.concatenate(ready) if ready else rising[:0]
        i[rising], j[rising] = level.up[i[rising]], level.up[j[rising]]
    falling = rising[:0]
    for level, here in zip(reversed(levels[:len(stopped)]), reversed(stopped)):
        if len(falling):  # down to the outermost symbol of the level
            if step > 0:
                i[falling], j[falling] = level.first[i[falling]], level.first[j[falling]]
            else:
                i[falling], j[falling] = level.first[i[falling] + 1] - 1, level.first[j[falling] + 1] - 1
        falling = np.concatenate([falling, here])
        some = falling
        while len(some):
            some = some[level.symbol[i[some]] == level.symbol[j[some]]]
            if len(some):
                if level.up is None:
                    i[some] += step
                    j[some] += step
                else:
                    go(level, some)
    return i


def grid(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all grids, some ``PLACES`` at a time: periods up to a quarter of a document, places 3 periods apart."""
    long = np.flatnonzero(lengths >= SHORTEST)
    periods = np.maximum(lengths[long] // TIMES, 1)
    doc = np.repeat(long, periods)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    n = (lengths[doc] - q - 1) // (3 * q) + 1
    ends = np.cumsum(n)
    a = 0
    while a < len(doc):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PLACES, "right")))
        some = n[a:b]
        k = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        period = np.repeat(q[a:b], some)
        yield np.repeat(starts[doc[a:b]], some) + 3 * period * k, period
        a = b


def runs_of(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of documents laid into ``words`` with a unique number before, between and behind them.

    Ordered by start, then period. Of periods that give the same stretch the smallest is its period.
    """
    levels = grammar(words, int(lengths.max(initial=0)))
    found = [np.empty((3, 0), np.int64)]
    for i, q in grid(starts, lengths):
        same = np.flatnonzero(words[i] == words[i + q])
        i, q = i[same], q[same]
        # at least three periods agree around the place; most places fail at its neighbours
        near = (words[i + 1] == words[i + q + 1]) | (words[i - 1] == words[i + q - 1])
        i, q = i[near], q[near]
        end = agree(levels, i, i + q, 1) + q
        start = agree(levels, i, i + q, -1) + 1
        good = end - start >= np.maximum(SHORTEST, TIMES * q)
        found.append(np.unique(np.stack([start[good], end[good], q[good]]), axis=1))
    start, end, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.diff(start, prepend=-1) != 0
    new |= np.diff(end, prepend=-1) != 0
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The tested document: for one id hash in ten, the words from a place on repeat with a period."""
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Lot:
    """Documents that are worked on together."""

    def __init__(self):
        self.numbers, self.size = Numbers(), 0
        self.laid: list[np.ndarray] = []
        self.words: list[list[bytes]] = []

    def add(self, words: list[bytes]) -> None:
        self.laid.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.words.append(words)
        self.size += len(words)

    def runs(self) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
        """(words, start, end, period) of each document, starts counted from its first word."""
        lengths = np.array([len(x) for x in self.laid], np.int64)
        starts = np.cumsum(lengths + 1) - lengths
        whole = np.empty(int(lengths.sum()) + len(lengths) + 1, np.int64)
        marks = np.append(starts - 1, len(whole) - 1)
        whole[marks] = len(self.numbers) + np.arange(len(marks))
        for s, x in zip(starts, self.laid):
            whole[s:s + len(x)] = x
        start, end, q = runs_of(whole, starts, lengths)
        bounds = np.searchsorted(start, marks)
        for d, words in enumerate(self.words):
            a, b = bounds[d], bounds[d + 1]
            yield words, start[a:b] - starts[d], end[a:b] - starts[d], q[a:b]


def _best(start: np.ndarray, length: np.ndarray, q: np.ndarray) -> int:
    """The run of greatest length / period, compared exactly; runs come by start, then period."""
    best = 0
    for k in range(1, len(q)):
        if int(length[k]) * int(q[best]) > int(length[best]) * int(q[k]):
            best = k
    return best


def _row(words: list[bytes], start: np.ndarray, end: np.ndarray, q: np.ndarray) -> tuple:
    length = end - start
    spelled = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), q.tolist()))
    best: tuple = (None, None, None, None)
    if len(q):
        k = _best(start, length, q)
        best = (int(start[k]), int(length[k]), int(q[k]), 1000 * int(length[k]) // int(q[k]))
        turn = np.zeros(len(words) + 1, np.int64)
        np.add.at(turn, start + q, 1)
        np.add.at(turn, end, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(turn[:-1]) == 0).tolist()]
    return len(q), *best, spelled, b" ".join(words)


def periodic_runs(docs: DataFrame, test_tails: bool = False, digest: bool = False) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed of every document row.

    A run is a stretch of at least six words and four of its smallest period that neighbouring words do not extend.
    ``start``, ``length``, ``period`` and floor(1000 length / period) are those of the run with the most periods, null
    without runs; ``runs`` lists all as ``start,length,period`` lines, ``collapsed`` has the words left when each run
    keeps its first period. ``digest`` gives the last two as ``runs_sha256``, ``collapsed_sha256``. ``test_tails``
    lets one document in ten end in a period of its own, by its id's hash.

    Words are runs of anything but ASCII white space. Null or empty text: no words and no runs; null ids (with
    ``test_tails`` hashed as ``None``) and repeated ones are rows of their own. Other columns are not read. A document
    is read by one task, whatever its length.
    """
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", *(["runs_sha256", "collapsed_sha256"] if digest else ["runs", "collapsed"])]
    shown = (lambda x: hashlib.sha256(x).hexdigest()) if digest else (lambda x: x.decode())

    def told(ids: list, lot: Lot) -> pa.RecordBatch:
        rows = [_row(*r) for r in lot.runs()]
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.array(c, pa.int64()) for c in columns[:5]],
             pa.array([shown(x.encode()) for x in columns[5]], pa.string()), pa.array([shown(x) for x in columns[6]], pa.string())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        lot = Lot()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                if ids and lot.size + len(words) > LOT:
                    yield told(ids, lot)
                    ids, lot = [], Lot()
                ids.append(doc_id)
                lot.add(repeated_tail(words, doc_id) if test_tails else words)
        if ids:
            yield told(ids, lot)

    return id_and_text(docs).mapInArrow(
        run, ", ".join(f"{n} {'long' if i < 6 else 'string'}" for i, n in enumerate(names)))
