"""Periodic runs of words (operator 11): internal pattern matching over a suffix array.

A run is a stretch of consecutive words with smallest period q, of at least
``max(MIN_LENGTH, 2 q)`` words, that no neighbouring word extends. All runs of a
text are found:

1. Prefix doubling names the 2^k-word substrings of every text and ends in the
   suffix array; a name is the first place of its suffixes there, so every
   substring of 2^k words has its interval of the array at hand. Names that are
   unique in their text leave the sort.
2. A run of period q holds a dyadic block (2^k words from a multiple of 2^k on,
   2^(k+1) - 1 <= max(q, MIN_LENGTH - q)) that occurs again q words later. So
   each block that is not unique asks for its occurrences in the neighbouring
   windows of 2^k starts: a wavelet tree over the suffix array gives the first
   two (range successor) and the last one.
3. Occurrences in such a window form an arithmetic progression. Up to two of
   them are candidate periods as they are. Of three and more, with difference d,
   the block and its occurrences lie in two maximal stretches of period d: the
   period then aligns their starts or their ends, or the stretches touch and
   every term may be one.
4. A candidate is extended both ways by comparing names from long to short,
   which is exact. Of equal stretches the smallest period stays.

Scale: one narrow Arrow pass, nothing is shuffled. A slice of texts (at most
``SLICE_BYTES``, or one text) is indexed at once in numpy: O(n log n) time, 4
bytes a word for each doubling (at most log2 of the longest text's words) and
some 100 bytes a word beside.

Odd cases: null, empty and blank texts have no words and no runs (collapsed "");
rows repeat as they come, a null id changes nothing; other columns stay, those
named like an output column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import read_table, with_arrow

MIN_LENGTH = 12
SLICE_BYTES = 2 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def split_words(texts) -> tuple[np.ndarray, pa.Array]:
    """Offsets of each text's words, and all words ``[^\\x20\\x09-\\x0D]+``."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    ends, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
    some = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(some)])
    return before[ends - ends[0]], flat.filter(pa.array(some))


class Names:
    """Suffix array and dyadic names of texts laid end to end; no substring reaches over a text's end."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        n = len(words)
        self.n = n
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        key = text * (int(words.max(initial=0)) + 1) + words
        self.order = np.arange(n)              # the suffix array, once all names are unique
        self.levels, self.sizes = [], []       # name of each place, and how many share it
        name = np.zeros(n, np.int64)
        left, step = self.order, 1             # places whose names are not unique yet
        slots = np.arange(n)                   # where these stand in the array
        end = offsets[1:][text]
        while True:
            by = np.argsort(key)
            left, key = left[by], key[by]
            new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(key)))
            self.order[slots] = left
            name = name.copy()
            name[left] = np.repeat(slots[first], size)
            count = np.ones(n, np.int32)
            count[left] = np.repeat(size, size)
            self.levels.append(name.astype(np.int32))
            self.sizes.append(count)
            again = np.repeat(size > 1, size)
            slots, left = slots[again], left[again]
            if not len(left):
                break
            after = left + step
            inside = after < end[left]
            key = name[left] * (n + 1) + np.where(inside, name[np.minimum(after, n - 1)] + 1, 0)
            step *= 2

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are the same."""
        i, j, got = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name, step = self.levels[k], 1 << k
            live = np.flatnonzero((i < self.n) & (j < self.n))
            same = live[name[i[live]] == name[j[live]]]
            i[same] += step
            j[same] += step
            got[same] += step
        return got

    def extend_back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j are the same; i and j stand in one text."""
        i, j, got = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name, step = self.levels[k], 1 << k
            live = np.flatnonzero((i >= step) & (j >= step))
            same = live[name[i[live] - step] == name[j[live] - step]]
            i[same] -= step
            j[same] -= step
            got[same] += step
        return got


class WaveletTree:
    """Range counts and order statistics over an array of values below 2^bits, a level per bit."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.levels = []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~one)]).astype(np.int32)
            self.levels.append(zeros)
            values = np.concatenate([values[~one], values[one]])

    def count_below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values among places low to high (exclusive) are smaller than x."""
        total = np.where(x >> self.bits > 0, high - low, 0)
        x = np.where(x >> self.bits > 0, 0, x)
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.levels):
            z0, z1 = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            one = (x >> b) & 1 == 1
            total = total + np.where(one, z1 - z0, 0)
            low = np.where(one, zeros[-1] + low - z0, z0)
            high = np.where(one, zeros[-1] + high - z1, z1)
        return total

    def at_rank(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of this rank (from 0) among places low to high (exclusive)."""
        value = np.zeros(len(low), np.int64)
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.levels):
            z0, z1 = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            one = rank >= z1 - z0
            value |= one.astype(np.int64) << b
            rank = np.where(one, rank - (z1 - z0), rank)
            low = np.where(one, zeros[-1] + low - z0, z0)
            high = np.where(one, zeros[-1] + high - z1, z1)
        return value

    def successors(self, low: np.ndarray, high: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Of the values in [start, end) at places low to high: how many, the first, the second and the last (-1: none)."""
        below = self.count_below(low, high, start)
        many = self.count_below(low, high, end) - below
        found = [np.full(len(low), -1, np.int64) for _ in range(3)]
        for out, least, rank in zip(found, (1, 2, 3), (below, below + 1, below + many - 1)):
            q = np.flatnonzero(many >= least)
            out[q] = self.at_rank(low[q], high[q], rank[q])
        return many, *found


def _windows(k: int) -> list[tuple[int, int]]:
    """Distances, from and to (inclusive), at which a block of 2^k words is looked for."""
    size = 1 << k
    if k == 1:  # all periods for which MIN_LENGTH, not 2 q, is the bound or blocks of 4 are too long
        return [(d, d + 1) for d in range(1, 7, 2)]
    return [(2 * size - 1, 3 * size - 2), (3 * size - 1, 4 * size - 2)]


def _candidates(names: Names) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances at which a block may occur again as part of a run."""
    if len(names.levels) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # only places whose two words occur again matter: the others leave the array
    kept = names.sizes[1][names.order] > 1
    tree = WaveletTree(names.order[kept])
    place = np.concatenate([[0], np.cumsum(kept)])
    blocks, periods = [], []
    for k in range(1, len(names.levels)):
        block = np.arange(0, names.n, 1 << k)
        block = block[names.sizes[k][block] > 1]
        first = names.levels[k][block].astype(np.int64)
        low, high = place[first], place[first + names.sizes[k][block]]
        for near, far in _windows(k):
            many, p1, p2, last = tree.successors(low, high, block + near, block + far + 1)
            for some, p in ((many >= 1, p1), (many == 2, p2)):
                blocks.append(block[some])
                periods.append((p - block)[some])
            more = np.flatnonzero(many >= 3)
            if len(more):
                b, p1, p2, last = block[more], p1[more], p2[more], last[more]
                d = p2 - p1
                # the stretches of period d around the block and around its occurrences
                start, end = b - names.extend_back(b, b + d), b + d + names.extend(b, b + d)
                start2, end2 = p1 - names.extend_back(p1, p2), p2 + names.extend(p1, p2)
                two = start != start2
                b, p1, last, d, start, end, start2, end2 = (x[two] for x in (b, p1, last, d, start, end, start2, end2))
                blocks += [b, b]
                periods += [end2 - end, start2 - start]
                longest = np.minimum(np.minimum(end - start, end2 - start2), last - b)
                terms = np.where(start2 <= end, np.maximum((longest - (p1 - b)) // d + 1, 0), 0)
                at = np.arange(terms.sum()) - np.repeat(np.cumsum(terms) - terms, terms)
                blocks.append(np.repeat(b, terms))
                periods.append(np.repeat(p1 - b, terms) + at * np.repeat(d, terms))
    return np.concatenate(blocks), np.concatenate(periods)


def find_runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of texts laid end to end, by start, then period.

    ``words``: a number per word; ``offsets``: where each text begins, and the end.
    """
    if not len(words):
        return (np.zeros(0, np.int64),) * 3
    names = Names(words, offsets)
    block, period = _candidates(names)
    text_end = np.repeat(offsets[1:], np.diff(offsets))
    ok = (period > 0) & (block + period < text_end[block])
    block, period = np.divmod(np.unique(block[ok] * (len(words) + 1) + period[ok]), len(words) + 1)
    start = block - names.extend_back(block, block + period)
    end = block + period + names.extend(block, block + period)
    long = (end - start >= np.maximum(MIN_LENGTH, 2 * period))
    start, end, period = start[long], end[long], period[long]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _runs_of(texts):
    """Number of words, runs, and the text without the repeats, of each text."""
    offsets, flat = split_words(texts)
    coded = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, end, period = find_runs(coded, offsets)
    text = np.searchsorted(offsets, start, "right") - 1
    # words after the first period of a run go
    depth = np.zeros(len(coded) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    stay = np.cumsum(depth)[:-1] == 0
    kept = np.concatenate([[0], np.cumsum(stay)])[offsets]
    left = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), flat.filter(pa.array(stay)))
    bounds = np.searchsorted(text, np.arange(len(offsets))).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(
        [pa.array(start - offsets[text]), pa.array(end - start), pa.array(period)], ["start", "length", "period"]))
    return pa.array(np.diff(offsets)), runs, pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; by start, then period) and collapsed.

    ``collapsed`` is the text's words joined by one space, without those that
    repeat: a word goes if a run holds it after that run's first period.
    """
    return with_arrow(docs, [text], [("n_words", "bigint"), ("runs", RUNS), ("collapsed", "string")], _runs_of, SLICE_BYTES)


def planted(text: Column, doc_id: Column) -> Column:
    """The text, for one id in ten with a tail that repeats one of its own stretches.

    h = crc32 of the decimal id and g = h / 10 decide: if h % 10 = 0 and there
    are n > 0 words, word i >= a becomes word a + (i - a) % p, with a = g % n and
    p = 1 + (n - a) / (3 + g % 8), whole numbers. Words are then joined by one space.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")

    def tail(words: Column) -> Column:
        n, g = F.size(words).cast("bigint"), F.floor(h / 10).cast("bigint")
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("bigint")
        again = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
        return F.when(n > 0, F.array_join(again, " ")).otherwise("")

    # words split once: held by a one-element array that is transformed
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.isNotNull(), F.get(F.transform(F.array(words), tail), F.lit(0))).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, its planted tail included, and digests of the runs and of the collapsed text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    # ties of the greatest length: smallest start, then period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return periodic_runs(docs).withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
