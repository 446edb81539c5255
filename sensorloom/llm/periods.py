"""Periodic runs of words, by internal pattern matching.

A run is a longest stretch of words with smallest period q that is at least twice as long (and `LEAST` words). Its first part holds a dyadic block,
of 2^k words on a grid of half that, which occurs again q words on. Words are ranked by doubled prefixes, which order the suffixes of the text and give each
block its range of that order; a wavelet tree over the order finds the occurrences of a block in a neighbouring window by range successor. Within a window as long as
the block they form an arithmetic progression, whose terms are candidate periods: one or two terms are tried as they are, of longer progressions
those that the ends of the two periodic stretches allow. Each candidate is extended to both sides by comparing ranks.

Texts are worked on many at a time, as one sequence in which words of unlike texts are unlike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Places, arrow_batches, column_bytes, slices, text_bytes
from .host_rules import bound, words_of

#: Fewest words of a run.
LEAST = 12
#: Words worked on at a time; a longer text makes a part of its own.
PART = 300_000
#: Level of the shortest blocks: 4 words.
FIRST = 2


class Ranks:
    """Ranks of all blocks of 2^k words, for each k until all differ: the place of the block's first suffix among all suffixes in order.

    A block that reaches over the end of its text, where an end mark stands, equals no other.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        first = np.append(True, symbols[order][1:] != symbols[order][:-1])
        starts = np.flatnonzero(first)
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
        self.levels, self.repeated = [rank], [np.sort(order[~(first & np.append(first[1:], True))])]
        while len(self.repeated[-1]):
            at, rank, span = self.repeated[-1], self.levels[-1], 1 << len(self.levels) - 1
            key = rank[at].astype(np.int64) * n + rank[at + span]
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            old = rank[at]
            new_group, new_class = np.append(True, key[1:] != key[:-1]), np.append(True, old[1:] != old[:-1])
            place = np.arange(len(at))
            offset = np.maximum.accumulate(np.where(new_group, place, 0)) - np.maximum.accumulate(np.where(new_class, place, 0))
            rank = rank.copy()
            rank[at] = old + offset
            self.levels.append(rank)
            self.repeated.append(np.sort(at[~(new_group & np.append(new_group[1:], True))]))

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on."""
        at, to = a.copy(), b.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            same = (self.levels[k][at] == self.levels[k][to]).astype(np.int64) << k
            at += same
            to += same
        return at - a

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b, where a < b."""
        at, to = a.copy(), b.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            span = 1 << k
            same = ((at >= span) & (self.levels[k][np.maximum(at - span, 0)] == self.levels[k][np.maximum(to - span, 0)])).astype(np.int64) << k
            at -= same
            to -= same
        return a - at


class WaveletTree:
    """Values below `top`, level by level from the highest bit: zeros before each place, and all zeros. All queries take arrays."""

    def __init__(self, values: np.ndarray, top: int):
        self.bits = max(1, int(top - 1).bit_length())
        self.zeros, self.total = [], []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero, dtype=np.int32)]).astype(np.int32))
            self.total.append(int(self.zeros[-1][-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values at places low to high (without) are less than x."""
        low, high, found = low.astype(np.int64), high.astype(np.int64), np.zeros(len(x), np.int64)
        over = x >= 1 << self.bits
        size = high - low
        for level, (zeros, total) in enumerate(zip(self.zeros, self.total)):
            one = (x >> self.bits - 1 - level & 1) == 1
            a, b = zeros[low], zeros[high]
            found += np.where(one, b - a, 0)
            low, high = np.where(one, total + low - a, a), np.where(one, total + high - b, b)
        return np.where(over, size, found)

    def ordered(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th least value (from 0) at places low to high."""
        low, high, k, found = low.astype(np.int64), high.astype(np.int64), k.copy(), np.zeros(len(k), np.int64)
        for zeros, total in zip(self.zeros, self.total):
            a, b = zeros[low], zeros[high]
            one = k >= b - a
            k -= np.where(one, b - a, 0)
            low, high = np.where(one, total + low - a, a), np.where(one, total + high - b, b)
            found = found * 2 + one
        return found


def windows(level: int) -> list[tuple[int, int]]:
    """Distances of the neighbouring windows of a block, each as wide as the block at most. All levels together meet every distance once: a run of
    period q and length max(LEAST, 2 q) holds a block of the level of q, and that block again q words on."""
    m = 1 << level
    low, high = (1 if level == FIRST else 3 * m // 2 - 1), 3 * m - 2
    return [(x, min(x + m - 1, high)) for x in range(low, high + 1, m)]


def candidates(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances such that each run has its smallest period among the distances of a place in it."""
    none = np.zeros(0, np.int64)
    if len(ranks.repeated) <= FIRST or not len(ranks.repeated[FIRST]):
        return none, none
    known = ranks.repeated[FIRST]  # all suffixes whose blocks can occur twice, in order of place
    last = ranks.levels[-1]
    order = np.argsort(last[known], kind="stable")
    tree = WaveletTree(order, len(known))
    sorted_ranks = last[known][order]
    at, by = [], []
    for level in range(FIRST, len(ranks.repeated)):
        m = 1 << level
        blocks = ranks.repeated[level]
        blocks = blocks[blocks % (m // 2) == 0]
        if not len(blocks):
            continue
        rank = ranks.levels[level]
        own, size = np.unique(rank[ranks.repeated[level]], return_counts=True)
        low = np.searchsorted(sorted_ranks, rank[blocks])
        high = low + size[np.searchsorted(own, rank[blocks])]
        for x, y in windows(level):
            before = tree.below(low, high, np.searchsorted(known, blocks + x))
            some = before < high - low
            i, a, b, before = blocks[some], low[some], high[some], before[some]
            first = known[tree.ordered(a, b, before)]
            near = first <= i + y
            i, a, b, before, first = i[near], a[near], b[near], before[near], first[near]
            n = tree.below(a, b, np.searchsorted(known, i + y + 1)) - before
            at.append(i[n <= 2])
            by.append((first - i)[n <= 2])
            more = n >= 2
            i, first, n = i[more], first[more], n[more]
            second = known[tree.ordered(a[more], b[more], before[more] + 1)]
            at.append(i[n == 2])
            by.append((second - i)[n == 2])
            long = n > 2
            found = progressions(ranks, i[long], first[long], (second - first)[long], n[long])
            at.append(found[0])
            by.append(found[1])
    return np.concatenate(at), np.concatenate(by)


def progressions(ranks: Ranks, i: np.ndarray, first: np.ndarray, d: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of blocks at i that occur n times from `first` on at steps of d, their own period.

    If these occurrences and the block lie in one stretch of period d, no distance but d itself can be a smallest period. Else a run that leaves either
    stretch has as period the distance of their left or right ends; one that does not needs stretches that touch, and both as long as its period.
    """
    if not len(i):
        return i, i
    left, right = i - ranks.behind(i, i + d), i + d + ranks.ahead(i, i + d)
    left_there, right_there = first - ranks.behind(first, first + d), first + d + ranks.ahead(first, first + d)
    apart = left != left_there
    at, by = [i, i[apart], i[apart]], [d, (left_there - left)[apart], (right_there - right)[apart]]
    touch = apart & (right >= left_there)
    if touch.any():
        longest = np.minimum(np.minimum(right - left, right_there - left_there), (right_there - left) // 2)[touch]
        i, d, n, q = i[touch], d[touch], n[touch], (first - i)[touch]
        each = np.repeat(np.arange(len(i)), n)
        term = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        period = q[each] + term * d[each]
        some = period <= longest[each]
        at.append(i[each[some]])
        by.append(period[some])
    return np.concatenate(at), np.concatenate(by)


def runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run, by start, then period. Symbols of end marks must occur once."""
    ranks = Ranks(symbols)
    at, by = candidates(ranks)
    key = np.unique(at[by > 0] * (len(symbols) + 1) + by[by > 0])
    at, by = key // (len(symbols) + 1), key % (len(symbols) + 1)
    inside = at + by < len(symbols)
    at, by = at[inside], by[inside]
    start = at - ranks.behind(at, at + by)
    length = at + by + ranks.ahead(at, at + by) - start
    some = length >= np.maximum(LEAST, 2 * by)
    start, length, by = start[some], length[some], by[some]
    order = np.lexsort((by, length, start))
    start, length, by = start[order], length[order], by[order]
    lead = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, by = start[lead], length[lead], by[lead]
    order = np.lexsort((by, start))
    return start[order], length[order], by[order]


def runs_of_texts(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (in the text), length and period of every run, and a flag for each word of all texts in turn: whether it is kept when each run keeps
    only its first period."""
    places = Places()
    size = np.array([len(t) for t in texts], np.int64)
    flat = np.fromiter((places[w] for t in texts for w in t), np.int64, int(size.sum()))
    text = np.repeat(np.arange(len(texts)), size)
    at = np.arange(len(flat)) + text  # an end mark after each text
    symbols = np.empty(len(flat) + len(texts), np.int64)
    symbols[at] = text * (len(places) + 1) + flat + 1
    ends = np.cumsum(size + 1) - 1
    symbols[ends] = np.arange(len(texts)) * (len(places) + 1)
    start, length, period = runs(symbols)
    found = np.searchsorted(ends, start)
    step = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    kept = (np.cumsum(step)[:-1] == 0)[at]
    return found, start - (np.cumsum(size + 1) - size - 1)[found], length, period, kept


def parts(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive texts of some PART words together; a longer text by itself."""
    begin = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > PART:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period in words, by start, then period) and `collapsed` (the words that are kept if each run keeps its first period,
    joined by one space) of every row.

    Words are separated by ASCII white space. A null or empty text has no runs and an empty `collapsed`. Repeated rows give a row each, a null id is passed
    on; an empty table gives no rows; other columns are ignored. Texts are taken whole, in memory proportional to the longest.
    """
    arrow_batches(docs.sparkSession)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [t.split() for t in column_bytes(b, "text")]
            sizes = np.array([len(w) for w in words], np.int64)
            for part in parts(sizes):
                some = words[part]
                text, start, length, period, kept = runs_of_texts(some)
                collapsed, done = [], 0
                for w in some:
                    own = kept[done : done + len(w)]
                    done += len(w)
                    collapsed.append(b" ".join(w if own.all() else [x for x, k in zip(w, own.tolist()) if k]))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(some)))]).astype(np.int32)
                found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(run_type))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(part.start, len(some)), pa.ListArray.from_arrays(pa.array(offsets), found),
                                                  pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(work, "doc_id long, runs array<struct<start long, length long, period long>>, collapsed string")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with a periodic end in every tenth text or so, told by crc32 of the id: from word a = g % n on, words repeat those from a on with
    period 1 + (n - a) / (3 + g % 8), where g is a tenth of that crc32 and n the number of words. Rows of null id stay as they are."""
    code = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(code / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words)
        return F.when(n > 0, bound(F.struct((g % n).cast("int").alias("a"), n.alias("n")), lambda x: bound(
            F.struct(x.a.alias("a"), (1 + F.floor((x.n - x.a) / (3 + g % 8))).cast("int").alias("p")),
            lambda y: F.array_join(F.transform(words, lambda w, i: F.when(i < y.a, w).otherwise(words[y.a + (i - y.a) % y.p])), " ")))).otherwise(F.lit(""))

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(text_col, F.when(code % 10 == 0, bound(words_of(text), repeat)).otherwise(F.col(text_col)))


def digest(found: DataFrame) -> DataFrame:
    """One flat row for each of `periodic_runs`: number of runs, the longest (ties: smallest start, then period), hashes of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
