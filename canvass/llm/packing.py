"""Best-fit packing (operator 6): partitions packed by best-fit decreasing, certified by lower bounds.

Documents are tokenised (the ids of a public vocabulary, then the end id 1);
only those longer than a sequence are cut, into full pieces and a rest. Pieces
are dealt to partitions of bounded size. Each partition is packed by best-fit
decreasing, and dual feasible functions give a lower bound on the sequences it
needs. A partition whose count equals its bound is certified and its full
sequences stay. The pieces of the open sequences - all with room left in
partitions with a gap, and the emptiest one of every certified partition, where
only rounding is lost - are exchanged: pooled, dealt anew and packed again by
the same rule, until no round saves a sequence or the whole is certified.

Tokenising: the vocabulary's own rule splits a text into letter runs, digits
and other runs after lower-casing, and each run is coded on its own. So words
are coded once and remembered in the Python worker (``CACHE`` of them at
most); texts beyond Latin script or with marks of the vocabulary go to
the tokeniser whole. Tests hold both ways against each other.

Defined cases: null and empty texts have only the end id; repeated rows are
packed as separate documents; an empty table gives no pieces; other columns of
the input are not carried. Token ids are not kept: a piece's CRC-32 stands for them.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import byte_slices, empty_workers, give_back_memory, held, read_table, small_batches, staged

LENGTH = 4096
END_ID = 1
PART_PIECES = 50_000   # pieces in one partition, some 10 MB
CACHE = 600_000        # remembered words, some 120 MB at most
SLICE_BYTES = 2 << 20  # text coded at a time
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# The vocabulary's split rule: a fixed value.
_RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Characters for which Python's lower() and the vocabulary's normal form agree.
_PLAIN = regex.compile(r"[\t\n\r -~¡-įĲ-ɏ]*+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Coder:
    """Token ids of texts, by a tokenizers file, remembered per word."""

    def __init__(self, path: str, cache: int = CACHE):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)   # ids that end a run
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.known = Remembered(cache)

    def whole(self, texts: list[str]) -> list[bytes]:
        """The tokeniser's own way."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_runs(self, runs: list[str]) -> list[bytes]:
        if not runs:
            return []
        ids = np.array(self.tokenizer.encode(" ".join(runs), add_special_tokens=False).ids, "<u4")
        cut = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(cut, cut[1:])]

    def _new_words(self, words: list[str]) -> list[bytes]:
        split = [(w,) if w.isalpha() else _RUNS.findall(w) for w in words]    # a word of letters is one run
        runs = list(set(chain.from_iterable(split)))
        of = dict(zip(runs, self._new_runs(runs)))
        return [of[s[0]] if len(s) == 1 else b"".join([of[r] for r in s]) for s in split]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit bytes."""
        plain = [_PLAIN.fullmatch(t) is not None and not any(m in t for m in self.marks) for t in texts]
        rest = iter(self.whole([t for t, p in zip(texts, plain) if not p]))
        lower = pc.utf8_lower(pa.array([t for t, p in zip(texts, plain) if p], pa.string()))
        # a stop or comma between a letter or digit and white space is a run of its own
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, r"([\pL\pN])([.,])(\s|$)", r"\1 \2\3"))
        coded = words.flatten().dictionary_encode()
        unique = coded.dictionary.to_pylist()
        of = self.known.get_all(unique, self._new_words)
        codes = coded.indices.to_numpy()
        flat = [of[w] for w in unique]
        size = np.array([len(x) // 4 for x in flat], np.int64)
        start = np.cumsum(size) - size
        n = size[codes]
        stop = np.cumsum(n)
        out = np.frombuffer(b"".join(flat), "<u4")[np.repeat(start[codes] - (stop - n), n) + np.arange(n.sum())]
        at = np.concatenate(([0], stop))[words.offsets.to_numpy()].tolist()
        raw = out.tobytes()
        made = iter([raw[4 * a:4 * b] for a, b in zip(at, at[1:])])
        return [next(made) if p else next(rest) for p in plain]


class Remembered:
    """Results by key; of ``size`` at most, the half not asked for lately is dropped."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get_all(self, keys: list[str], make) -> dict:
        """A mapping that holds all ``keys``; ``make`` gives the values of a list of unknown ones."""
        if len(self.young) > self.size // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = [k for k in keys if k not in young]
        young.update([(k, old[k]) for k in missing if k in old])
        new = [k for k in missing if k not in old]
        young.update(zip(new, make(new)))
        return young


def pieces(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end_id: int = END_ID,
           doc_id: str = "doc_id", text: str = "text", cache: int = CACHE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    ``cache`` (words remembered in a worker) and ``slice_bytes`` (text coded at
    a time, or one document) trade memory for time; rows never depend on them.
    """
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def coder():
        return held((path, cache), lambda: Coder(path, cache))

    def run(batches):
        coder()
        give_back_memory()  # what reading the vocabulary took
        for batch in batches:
            for part in byte_slices(batch, 1, slice_bytes):
                coded = coder().ids([t or "" for t in part.column(1).to_pylist()])
                rows = []
                for d, ids in zip(part.column(0).to_pylist(), coded):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * length)):
                        cut = ids[at:at + 4 * length]
                        rows.append((d, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
        # between tasks only the words asked for lately are kept
        coder().known.old = {}
        give_back_memory()

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECE)


def lower_bound(sizes: np.ndarray, length: int = LENGTH) -> int:
    """Sequences that ``sizes`` need at least: the best of several dual feasible functions."""
    if not len(sizes):
        return 0
    n = np.bincount(sizes, minlength=length + 1)
    x = np.arange(length + 1)
    best = -(-int((n * x).sum()) // length)
    for k in range(1, 21):            # u(k): x if (k + 1) x is whole, else floor((k + 1) x) / k
        whole = (k + 1) * x % length == 0
        f = np.where(whole, k * x, (k + 1) * x // length * length)
        best = max(best, -(-int((n * f).sum()) // (k * length)))
    # every cut: sizes above 1 - cut count whole, those below cut not at all
    cut = np.unique(np.minimum(sizes, length - sizes))
    cut = cut[(cut > 0) & (cut <= length // 2)]
    count, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * x)])
    above = count[-1] - count[length - cut + 1]
    between = total[length - cut + 1] - total[cut]
    return max(best, int((above - (-between // length)).max(initial=0)))


def best_fit_decreasing(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size. Open bins are kept by room; a bit set finds the least room that fits."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms, count = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fit = rooms >> s
        if fit:
            room = s + (fit & -fit).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, b, count = length, count, count + 1
        bins[i], offsets[i] = b, length - room
        room -= s
        if room:
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
    return bins, offsets


PACKED = PIECE + ", row bigint, sequence_id bigint, offset bigint, open boolean"


def _pack(df: DataFrame, parts: int, round_: int, length: int) -> DataFrame:
    """Each partition packed; ``open`` marks pieces that go to the next exchange."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True])
        sizes = pdf["length"].to_numpy()
        bins, offsets = best_fit_decreasing(sizes, length)
        fill = np.bincount(bins, weights=sizes)
        if len(fill) > lower_bound(sizes, length):
            loose = fill < length                     # a gap: all with room
        else:
            loose = np.zeros(len(fill), bool)         # certified: the emptiest alone
            loose[int(np.argmin(fill))] = fill.min() < length
        # sequence numbers: round, partition, bin; a partition has some part_pieces pieces, fewer than 2^20
        pdf["sequence_id"] = (np.int64(round_) << 52) + (np.int64(part) << 20) + bins
        pdf["offset"], pdf["open"] = offsets, loose[bins]
        return pdf.drop(columns="part")

    # by a number of the piece itself: rows that repeat one id are spread like any others
    dealt = df.withColumn("part", F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInPandas(run, PACKED)


def pack(made: DataFrame, length: int = LENGTH, part_pieces: int = PART_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset."""
    if not 0 < part_pieces <= 1 << 19:
        raise ValueError("part_pieces: from 1 to 2^19, as sequence numbers leave 20 bits to a partition")
    numbered = staged(made.withColumn("row", F.monotonically_increasing_id()), "pieces")
    empty_workers(made.sparkSession)
    n = numbered.count()
    if not n:
        return made.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    now = staged(_pack(numbered, -(-n // part_pieces), 0, length), "packed")
    closed, k = [now.where("not open")], 0
    while True:
        k += 1
        pool = now.where("open")
        n, tokens, had, parts = pool.agg(F.count("*"), F.sum("length"), F.countDistinct("sequence_id"),
                                         F.countDistinct(F.shiftright("sequence_id", 20))).first()
        if not n or had <= -(-tokens // length) or k > 1 and parts == 1:
            break                                     # certified, or nothing to exchange with
        again = staged(_pack(pool.select(*numbered.columns), -(-n // part_pieces), k, length), "packed")
        if again.select("sequence_id").distinct().count() >= had:
            break                                     # no sequence saved
        closed.append(again.where("not open"))
        now = again
    closed.append(now.where("open"))
    out = closed[0]
    for c in closed[1:]:
        out = out.unionByName(c)
    return out.drop("open", "row")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return pack(pieces(read_table(spark, sf_dir, "documents")))
