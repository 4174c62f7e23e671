"""Suffix-array dedup (operator 9): a distributed sort of the suffixes of content-cut phrases.

Every byte covered by an ``n``-byte string (400) that also starts anywhere else
goes; strings are judged on the input.

1. Equal texts are found by their 128-bit hash; one of each is looked at further
   (all copies of a text of n bytes or more go whole).
2. Texts are cut into phrases at positions whose 8-byte hash is the strict
   minimum among its 24 neighbours on each side, so equal strings are cut alike.
   A phrase gets a 64-bit name, of its bytes and those beside it that decide
   about its two cuts (a window that holds both cuts holds them too). Names that occur once cannot lie in a repeat;
   the rest, with their places, are the text to sort.
3. That text's suffixes are sorted by their first 27 phrases, which is more than
   any n bytes hold: one sort by range partitions.
4. Adjacent suffixes are compared by prefix: each phrase gets the number of
   phrases it shares with the suffix before and after it. This settles every
   window of n bytes but those at the rims of repeats: a window inside a shared
   run of phrases repeats, one whose whole phrases are not shared does not.
5. Rim windows share all their whole phrases with another place and are
   compared on all n bytes by a hash, against each other and against one copy
   of the settled windows with the same whole phrases. Windows with less than two cuts (text of a short period)
   are compared so from the start; those that repeat inside their own text are
   settled there.

Nothing is ordered in one task or on the driver, which sees two rows per
partition of the sort.
Texts are never shuffled unless the list of spans outgrows a broadcast
(``BROADCAST_ROWS``); phrases are, 28 bytes for some 49 of text, and once more
with up to 27 names those that occur twice.

Defined cases: null and empty texts have no bytes and no spans; repeated rows
are copies of each other; texts shorter than n lose nothing; other columns pass
through, those named like the outputs are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.llm.common import byte_slices, read_table, staged, with_arrow
from canvass.llm.hashing import RangeHash, mix, powers

LENGTH = 400
RADIUS, GRAM = 24, 8
REACH = RADIUS + GRAM          # bytes after a cut that decide about it; RADIUS before it
LEVELS = 3                     # suffixes are sorted by 3 ** LEVELS phrases; a phrase has more than RADIUS bytes
BROADCAST_ROWS = 1_000_000     # spans of so many texts at most, some 100 MB
DOC = ["h1", "h2"]


def cuts(raw: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The texts in one buffer, and the cut positions in each."""
    buf = np.frombuffer(b"".join(raw) + bytes(GRAM + 2 * RADIUS), np.uint8)
    n = len(buf) - GRAM - 2 * RADIUS
    grams = np.lib.stride_tricks.sliding_window_view(buf, GRAM)[:n + 2 * RADIUS].copy().view(np.uint64).ravel()
    value = (mix(grams) >> np.uint64(32)).astype(np.uint32)
    low, span = value, 1
    while span < RADIUS:                                       # least of RADIUS values from each position on
        step = min(span, RADIUS - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    at = np.arange(RADIUS, max(RADIUS, n - RADIUS))
    at = at[(value[at] < low[at - RADIUS]) & (value[at] < low[at + 1])]
    bounds = np.cumsum([0] + [len(r) for r in raw])
    out, doc = [], np.searchsorted(bounds, at, "right") - 1
    at = at[(at - RADIUS >= bounds[doc]) & (at + REACH <= bounds[doc + 1])]
    where = np.searchsorted(at, bounds)
    for d in range(len(raw)):
        out.append(at[where[d]:where[d + 1]] - bounds[d])
    return buf[:n], out


def reached(cut: np.ndarray, windows: int, ahead: int) -> np.ndarray:
    """For each window start p, the number of cuts at p + ahead or before (a running count, not a search each)."""
    return np.bincount(np.clip(cut - ahead, 0, windows), minlength=windows + 1)[:windows].cumsum()


def window_cuts(cut: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start, the numbers of the first and the last cut that the window alone decides."""
    windows = max(0, size - n + 1)
    return reached(cut, windows, RADIUS - 1), reached(cut, windows, n - REACH) - 1


PARSED = ("h1 bigint, h2 bigint, n_bytes bigint, cut array<int>, name array<bigint>, "
          "weak array<struct<hash:bigint,p:int,check:boolean>>, again array<struct<start:int,end:int>>")


def _lists(sizes, values) -> pa.ListArray:
    """One list per size, of consecutive values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def _flat(column) -> tuple[np.ndarray, pa.Array]:
    """Where each list of a column begins and ends in the values of all."""
    return np.concatenate(([0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False)))), column.flatten()


def few_cuts(cut: list[np.ndarray], sizes: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Text number, start and end of ranges (that may overlap) of the windows that decide about less than two cuts.

    Such a window lies between two cuts that have one cut between them at most.
    """
    far = 1 << 40
    around = np.concatenate([x for c in cut for x in ((-far,), c, (far, far))])
    doc = np.repeat(np.arange(len(cut)), [len(c) + 3 for c in cut])
    start = np.maximum(0, around[:-2] - RADIUS + 1)
    end = np.minimum(np.maximum(0, sizes[doc[:-2]] - n + 1), around[2:] - n + REACH)
    at = np.flatnonzero((doc[:-2] == doc[2:]) & (start < end))
    return list(zip(doc[at].tolist(), start[at].tolist(), end[at].tolist()))


def _parse(n: int):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, 1 << 20):
                raw = [t.encode() for t in part.column(2).to_pylist()]
                buf, cut = cuts(raw)
                ranges = RangeHash(buf)
                sizes, count = np.array([len(r) for r in raw]), np.array([len(c) for c in cut])
                at = np.cumsum(sizes) - sizes
                flat, doc = np.concatenate(cut), np.repeat(np.arange(len(cut)), count)
                first = np.flatnonzero(doc[:-1] == doc[1:])
                place = at[doc] + flat
                names = ((ranges(place[first] - RADIUS, place[first + 1] + REACH) >> np.uint64(1)) | np.uint64(1)).view(np.int64)
                masks: dict[int, np.ndarray] = {}
                for d, x, y in few_cuts(cut, sizes, n):
                    masks.setdefault(d, np.zeros(sizes[d] - n + 1, bool))[x:y] = True
                weak, n_weak, again = [], np.zeros(len(raw), np.int64), [[] for _ in raw]
                for d, mask in masks.items():
                    p = np.flatnonzero(mask)
                    # those that repeat inside the text are settled here; one of each is enough for other texts
                    h, once, which, times = np.unique(ranges(at[d] + p, at[d] + p + n).view(np.int64), return_index=True,
                                                      return_inverse=True, return_counts=True)
                    weak.append((h, p[once].astype(np.int32), times == 1))
                    n_weak[d] = len(h)
                    mask[p] = times[which] > 1
                    again[d] = [{"start": x, "end": y} for x, y in _runs(mask)]
                h, p, check = (np.concatenate(x) for x in zip(*weak)) if weak else (np.zeros(0, t) for t in (np.int64, np.int32, bool))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(sizes, pa.int64()),
                    _lists(count, pa.array(flat.astype(np.int32))), _lists(np.maximum(0, count - 1), pa.array(names)),
                    _lists(n_weak, pa.StructArray.from_arrays([pa.array(h), pa.array(p), pa.array(check)], names=["hash", "p", "check"])),
                    pa.array(again, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    names=["h1", "h2", "n_bytes", "cut", "name", "weak", "again"])
    return run


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of leading names that rows of two padded matrices share (0 pads)."""
    same = (x == y) & (x != 0)
    return np.where(same.all(1), x.shape[1], same.argmin(1))


def _matrix(column, width: int) -> np.ndarray:
    """Lists of names as rows, 0 after their end."""
    bounds, values = _flat(column)
    out = np.zeros((len(column), width), np.int64)
    size = np.diff(bounds)
    out[np.repeat(np.arange(len(column)), size), np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)] = values.to_numpy()
    return out


def suffix_ranks(text: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``text``: h1, h2, path, pos, name (above 0; gaps in pos end a run). Adds rank, before and after.

    Suffixes are ordered by their first 3 ** levels names, a run's end before all
    names; rank is the place in that order, before and after the number of names
    shared with the suffix before and after.
    """
    depth, columns = 3 ** levels, text.columns
    w = Window.partitionBy(*DOC, "path").orderBy("pos").rowsBetween(0, depth - 1)
    rows = text.withColumn("near", F.collect_list(F.struct("pos", "name")).over(w))
    rows = rows.select(*columns, F.transform(F.filter(
        "near", lambda x, i: x["pos"] == F.col("pos") + i), lambda x: x["name"]).alias("names"))
    # equal suffixes may lie in several partitions
    rows = rows.sort("name", "names", *DOC, "path", "pos")

    def run(batches):
        # the last row of a batch waits for the next one; a partition's first and last row carry their names
        part, row, held, shared = TaskContext.get().partitionId(), 0, None, 0

        def out(rows, before, after, last=False):
            names = [None] * rows.num_rows
            for i in ([0] if row == 0 else []) + ([-1] if last else []):
                names[i] = rows.column(len(columns))[i].as_py()
            return pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array(np.arange(row, row + rows.num_rows)), pa.array(before, pa.int32()),
                 pa.array(after, pa.int32()), pa.array(np.full(rows.num_rows, part, np.int32)), pa.array(names, pa.list_(pa.int64()))],
                names=[*columns, "row", "before", "after", "part", "rim"])

        for batch in batches:
            batch = batch if held is None else pa.concat_batches([held, batch])
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(len(columns)), depth)
            inner, k = _common(m[:-1], m[1:]), batch.num_rows - 1
            before = np.concatenate(([shared], inner))
            if k:
                yield out(batch.slice(0, k), before[:-1], inner)
            held, shared, row = batch.slice(k), int(before[-1]), row + k
        if held is not None:
            yield out(held, [shared], [0], True)

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in text.schema]
                       + ["row bigint, before int, after int, part int, rim array<bigint>"])
    done = staged(rows.mapInArrow(run, schema), "suffixes")
    # the pairs between partitions are compared here
    rims = sorted((r.part, r.row, r.rim) for r in done.where("rim is not null").select("part", "row", "rim").collect())
    ends: dict[int, list] = {}
    for part, row, names in rims:
        ends.setdefault(part, [names, row, names])[1:] = row, names
    joints, offset, last = [], 0, []
    for part, (head, row, tail) in ends.items():
        k = int(_common(_matrix(pa.array([last], pa.list_(pa.int64())), depth), _matrix(pa.array([head]), depth))[0])
        if joints:
            joints[-1][-1] = k
        joints.append([part, offset + 1, row, k, 0])
        offset, last = offset + row + 1, tail
    table = done.sparkSession.createDataFrame(joints, "part int, offset bigint, last bigint, b int, a int")
    return done.join(F.broadcast(table), "part").select(
        *columns, (F.col("offset") + F.col("row")).alias("rank"),
        F.when(F.col("row") == 0, F.col("b")).otherwise(F.col("before")).alias("before"),
        F.when(F.col("row") == F.col("last"), F.col("a")).otherwise(F.col("after")).alias("after"))


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_PAIRS = "array<struct<start:int,end:int>>"
_KEYED = "array<struct<start:int,end:int,key:bigint>>"


def _keyed(mask: np.ndarray, a: np.ndarray, b: np.ndarray, total: np.ndarray) -> list[dict]:
    """Runs of windows with the same whole phrases, with a key of those phrases."""
    at = np.flatnonzero(mask)
    if not len(at):
        return []
    new = np.flatnonzero((np.diff(at) != 1) | (np.diff(a[at]) != 0) | (np.diff(b[at]) != 0)) + 1
    first, last = at[np.concatenate(([0], new))], at[np.append(new, len(at)) - 1]
    _, down = powers(len(total) + 1)
    key = mix((total[b[first]] - total[a[first]]) * down[a[first]]).view(np.int64)
    return [{"start": i, "end": j + 1, "key": k} for i, j, k in zip(first.tolist(), last.tolist(), key.tolist())]


def _judge(n: int):
    """Windows by phrases alone: ranges of starts that repeat for sure, that are to be compared, and one copy of sure ones."""
    def work(sizes, cut, names, shared):
        sure, rim, copy = [], [], []
        (ends, cut), (_, names), (of, shared) = _flat(cut), _flat(names), _flat(shared)
        cut, names = cut.to_numpy().astype(np.int64), names.to_numpy().view(np.uint64)
        place, earlier, later = (x.to_numpy() for x in shared.flatten())
        ends_name = np.concatenate(([0], np.cumsum(np.maximum(0, np.diff(ends) - 1))))
        for d, size in enumerate(sizes.to_pylist()):
            c, name, s = cut[ends[d]:ends[d + 1]], names[ends_name[d]:ends_name[d + 1]], slice(of[d], of[d + 1])
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(name * powers(len(name) + 1)[0][:-1], dtype=np.uint64)))
            before, after = np.zeros(len(c) + 1, np.int64), np.zeros(len(c) + 1, np.int64)
            before[place[s]], after[place[s]] = earlier[s], later[s]
            most = np.maximum(before, after)
            windows = max(0, size - n + 1)
            a, b = window_cuts(c, size, n)
            maybe = (b - a >= 1) & (most[np.minimum(a, len(c))] >= b - a)
            x, y = reached(c, windows, 0) - 1, reached(c, windows, n - 1)              # cuts around the window
            inside = (x >= 0) & (y < len(c))
            safe = inside & (most[np.maximum(x, 0)] >= y - x)
            lead = safe & (b - a >= 1) & (before[np.maximum(x, 0)] < y - x)             # the first of its run in the order
            sure.append([{"start": i, "end": j} for i, j in _runs(safe)])
            rim.append(_keyed(maybe & ~safe, a, b, total))
            copy.append(_keyed(lead, a, b, total))
        return sure, rim, copy
    return work


def _windows(n: int):
    """Hashes of the n-byte windows that start in the given ranges."""
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, 1 << 20):
                ranges = RangeHash(np.frombuffer(b"".join(t.encode() for t in part.column(2).to_pylist()), np.uint8))
                size = pc.binary_length(part.column(2)).to_numpy().astype(np.int64)
                at, (bounds, spans) = np.cumsum(size) - size, _flat(part.column(3))
                start, end, check = (x.to_numpy(zero_copy_only=False) for x in spans.flatten())
                doc, many = np.repeat(np.arange(len(size)), np.diff(bounds)), (end - start).astype(np.int64)
                p = np.arange(many.sum()) + np.repeat(start - (np.cumsum(many) - many), many)
                doc = np.repeat(doc, many)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranges(at[doc] + p, at[doc] + p + n).view(np.int64)), part.column(0).take(pa.array(doc)),
                     part.column(1).take(pa.array(doc)), pa.array(p.astype(np.int32)), pa.array(np.repeat(check, many))],
                    names=["hash", "h1", "h2", "p", "check"])
    return run


def _near(docs: DataFrame, small: DataFrame, how: str) -> DataFrame:
    """Texts joined to a list by their hash: the list is broadcast while it is small."""
    return docs.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, DOC, how)


def repeated_spans(docs: DataFrame, text: str = "text", n: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """``docs`` with text hashes h1 and h2; and per hash the spans to remove: whole (boolean), spans (merged byte ranges)."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = docs.withColumns({"h1": F.xxhash64(content), "h2": F.xxhash64(F.lit(1), content)})
    long = docs.where(F.octet_length(content) >= n).select(*DOC, content.alias("text"))
    copies = staged(long.groupBy(*DOC).agg(F.count("*").alias("n")).where("n > 1").select(*DOC), "copies")
    single = _near(long, copies, "left_anti")
    one_each = _near(long, copies, "left_semi").groupBy(*DOC).agg(F.first("text").alias("text"))
    parsed = staged(single.union(one_each).mapInArrow(_parse(n), PARSED), "phrases")

    phrases = parsed.select(*DOC, F.posexplode("name").alias("pos", "name"))
    twice = phrases.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    repeated = phrases.join(twice, "name").select(*DOC, F.lit(0).cast("bigint").alias("path"), F.col("pos").cast("bigint"), "name")
    shared = suffix_ranks(repeated).where("before > 0 or after > 0")
    shared = shared.groupBy(*DOC).agg(F.collect_list(F.struct("pos", "before", "after")).alias("shared"))
    judged = with_arrow(parsed.select(*DOC, "n_bytes", "cut", "name").join(shared, DOC), ["n_bytes", "cut", "name", "shared"],
                        [("sure", _PAIRS), ("rim", _KEYED), ("copy", _KEYED)], _judge(n))
    judged = staged(judged.select(*DOC, "sure", "rim", "copy").where("size(sure) + size(rim) > 0"), "judged")

    # sure windows are needed only where a rim has the same whole phrases
    rims = judged.select(*DOC, F.inline("rim")).withColumn("check", F.lit(True))
    spare = judged.select(*DOC, F.inline("copy")).withColumn("check", F.lit(False)).join(
        rims.select("key").distinct(), "key", "left_semi").select(*rims.columns)
    some = staged(rims.union(spare).groupBy(*DOC).agg(F.collect_list(F.struct("start", "end", "check")).alias("ranges")), "ranges")
    texts = _near(single.union(one_each), some, "inner").select(*DOC, "text", "ranges")
    weak = parsed.select(*DOC, F.inline("weak")).select("hash", *DOC, "p", "check")
    windows = staged(texts.mapInArrow(_windows(n), "hash bigint, h1 bigint, h2 bigint, p int, check boolean").union(weak), "windows")
    again = windows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    found = windows.where("check").join(again, "hash", "left_semi").select(*DOC, F.col("p").alias("start"), (F.col("p") + 1).alias("end"))
    found = found.union(judged.select(*DOC, F.inline("sure"))).union(parsed.select(*DOC, F.inline("again")))
    merged = with_arrow(found.groupBy(*DOC).agg(F.collect_list(F.struct("start", "end")).alias("starts")),
                        ["starts"], [("spans", _PAIRS)], lambda s: _merge(s, n)).select(*DOC, "spans")
    whole = copies.withColumn("whole", F.lit(True))
    spans = merged.join(whole, DOC, "full").select(*DOC, F.coalesce("whole", F.lit(False)).alias("whole"), "spans")
    return docs, staged(spans, "removed")


def _merge(starts, n: int):
    """Ranges of window starts to maximal covered byte ranges."""
    bounds, ranges = _flat(starts)
    doc = np.repeat(np.arange(len(starts)), np.diff(bounds)) << 32       # a text's places lie behind those of the text before
    start, end = (doc + x.to_numpy() for x in ranges.flatten())
    order = np.argsort(start)
    start, end = start[order], np.maximum.accumulate(end[order] - 1 + n)
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(start)), bool), start[1:] > end[:-1])))
    start, end = start[new], end[np.append(new[1:], len(end)) - 1] if len(new) else end
    low = lambda x: pa.array((x & 0xFFFFFFFF).astype(np.int32))
    return (_lists(np.bincount(start >> 32, minlength=len(starts)), pa.StructArray.from_arrays([low(start), low(end)], names=["start", "end"])),)


RESULT = [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]


def _kept(raw: bytes, whole, spans) -> tuple[bytes, list[tuple[int, int]]]:
    spans = [(0, len(raw))] if whole and raw else [(s["start"], s["end"]) for s in spans or ()]
    kept, last = [], 0
    for a, b in spans:
        kept.append(raw[last:a])
        last = b
    return b"".join(kept) + raw[last:], spans


def _digest(texts, whole, spans):
    out = [[], [], [], []]
    for t, w, s in zip(texts.to_pylist(), whole.to_pylist(), spans.to_pylist()):
        raw = (t or "").encode()
        kept, cut = _kept(raw, w, s)
        for o, v in zip(out, (len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest())):
            o.append(v)
    return out


def remove_repeats(docs: DataFrame, text: str = "text", n: int = LENGTH) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept_sha256."""
    marked, spans = repeated_spans(docs, text, n)
    both = _near(marked, spans, "left")
    return with_arrow(both, [text, "whole", "spans"], RESULT, _digest).drop(*DOC, "whole", "spans")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 400-byte strings removed from all documents."""
    return remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
