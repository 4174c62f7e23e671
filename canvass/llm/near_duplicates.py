"""MinHash near-duplicates (operator 5): banded candidates, sequential Bayesian pruning, exact verification.

A document's set is its distinct 5-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``; a shorter text is one shingle; no words, no set).
Two documents are linked if their sets' Jaccard similarity is at least 0.75;
groups are the connected components of these links.

1. One narrow pass makes each set, its digest and a MinHash signature (numpy).
   Documents with equal sets are one from here on.
2. Signatures are cut into 32 bands of 4: at similarity 0.75 a pair shares no
   band with probability 5e-6. Only bands shared by several sets stay.
3. A candidate pair's signatures are compared 32 values at a time. After each
   batch the posterior of a similarity of 0.75 or more (uniform prior) is
   looked at, and the pair dropped once it is below ``MISS``.
4. The full sets of the rest are compared.

Only components matter, so a bucket's pairs are not all made. First each set is
paired with the smallest id that it shares a bucket with; a bucket of n alike
copies costs n pairs, not n squared. Then only buckets with members that are
not connected yet count: those of at most ``SMALL`` sets pair such members
outright; larger ones are cut into blocks of bounded size, and the members
outside the bucket's largest component meet all others block by block, inside
tasks that hold the two blocks' signatures and sets, give out links alone, and
test no pair that is connected by then or was met in an earlier band. So no link
between components is lost, and no shuffle carries the pairs of a large bucket.

Scale: signatures (512 bytes a document) and pairs are shuffled; texts are read
in place: those of candidates by a broadcast of their ids, if at most
``BROADCAST_IDS``, else by a shuffle join. Each step is written to the shared
checkpoint folder.

Defined cases: null and empty texts have 0 shingles and are their own
component; rows with equal doc_id are one document, linked by any of their
texts, and each row gets the result; a null doc_id is linked with nothing;
other columns are not carried.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import byte_slices, components, read_table, staged, with_arrow
from canvass.llm.hashing import BASE, RangeHash, mix

SHINGLE = 5
BANDS, ROWS = 32, 4
BATCH = 32
PERCENT = 75
MISS = 1e-6
SMALL = 16                  # buckets whose pairs are made outright
BLOCK, BLOCK_SHINGLES = 512, 1 << 20   # sets, and shingles, in a block of a larger bucket: some 8 MB
BROADCAST_IDS = 2_000_000   # 8 bytes each, some 100 MB as a hash table

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = np.random.default_rng(20240229)
_PLACE = _R.integers(0, 1 << 64, SHINGLE, np.uint64) | np.uint64(1)
_MUL = _R.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_IN_BAND = _R.integers(0, 1 << 64, ROWS, np.uint64) | np.uint64(1)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Each text's set: sorted distinct 64-bit shingle hashes."""
    raw = [(t or "").encode().lower() for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    bounds = np.cumsum([len(r) + 1 for r in raw])               # each text ends with a space
    space = _SPACE[buf]
    edge = np.diff(np.concatenate(([1], space.view(np.int8))))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    word = RangeHash(buf)(start, end)
    first = np.searchsorted(start, np.concatenate(([0], bounds[:-1])))
    last = np.append(first[1:], len(start))
    n = max(0, len(word) - SHINGLE + 1)
    every = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        every += word[k:k + n] * _PLACE[k]
    every = mix(every)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(every[a:b - SHINGLE + 1]))
        elif b > a:                                             # fewer words: one shingle, apart from all longer ones
            out.append(mix((word[a:b] * _PLACE[:b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (set, 128) of non-empty sets, as 32-bit values."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((BANDS * ROWS, len(sets)), np.uint32)
    work = np.empty_like(flat)
    for k in range(BANDS * ROWS):
        np.multiply(flat, _MUL[k], out=work)
        np.right_shift(work, np.uint64(32), out=work)
        out[k] = np.minimum.reduceat(work, starts)
    return np.ascontiguousarray(out.T)


SKETCH = "doc_id bigint, n_shingles bigint, digest binary, signature binary"


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature (both null for an empty set)."""
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, 1 << 20):
                sets = shingle_sets(part.column(1).to_pylist())
                some = [s for s in sets if len(s)]
                sig = iter([r.tobytes() for r in signatures(some)] if some else [])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(sig) if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "signature"])

    return docs.mapInArrow(run, SKETCH)


def bands(sketch: DataFrame) -> DataFrame:
    """One row per set and band: key, band, id, size."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
                key = mix(mix((sig * _IN_BAND).sum(2, dtype=np.uint64)) + np.arange(BANDS, dtype=np.uint64) * np.uint64(BASE))
                ids = part.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(ids))),
                     pa.array(np.repeat(ids, BANDS)), pa.array(np.repeat(part.column(2).to_numpy(), BANDS))],
                    names=["key", "band", "id", "size"])

    return sketch.select("id", "signature", "size").mapInArrow(run, "key bigint, band int, id bigint, size bigint")


@functools.cache
def least_matches(n: int, share: float, miss: float) -> int:
    """Smallest number of equal values among n at which P(similarity >= share) is not below ``miss``.

    With a uniform prior the posterior is P(Binomial(n + 1, share) <= matches).
    """
    p = 0.0
    for m in range(n + 1):
        p += math.comb(n + 1, m) * share ** m * (1 - share) ** (n + 1 - m)
        if p >= miss:
            return m
    return n


def _prune(a, b):
    """Which pairs of signatures outlast all batches."""
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint32).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint32).reshape(len(b), -1)
    alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
    for n in range(BATCH, x.shape[1] + 1, BATCH):
        matches[alive] += (x[alive, n - BATCH:n] == y[alive, n - BATCH:n]).sum(1)
        alive = alive[matches[alive] >= least_matches(n, PERCENT / 100, MISS)]
    out = np.zeros(len(x), bool)
    out[alive] = True
    return (pa.array(out),)


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _compare(a, b):
    """Which pairs of full sets are similar enough."""
    return ([_alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a.to_pylist(), b.to_pylist())],)


def _sets(texts):
    return ([s.tobytes() for s in shingle_sets(texts.to_pylist())],)


def full_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """id, set of the documents with these ids; a broadcast list leaves the other texts where they are."""
    ids = staged(ids, "ids")
    chosen = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id")
    return staged(with_arrow(chosen, ["text"], [("set", "binary")], _sets, 1 << 20).select("id", "set"), "sets")


def similar_pairs(pairs: DataFrame, docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``docs``: id, text of the pairs' ids; ``sketch``: id, signature."""
    def side(df, c, value):
        return df.select(F.col("id").alias(c), F.col(value).alias(f"{value}_{c}"))

    alike = with_arrow(pairs.join(side(sketch, "a", "signature"), "a").join(side(sketch, "b", "signature"), "b"),
                       ["signature_a", "signature_b"], [("alive", "boolean")], _prune)
    alike = staged(alike.where("alive").select("a", "b"), "alike")
    sets = full_sets(alike.select(F.col("a").alias("id")).union(alike.select("b")).distinct(), docs)
    full = with_arrow(alike.join(side(sets, "a", "set"), "a").join(side(sets, "b", "set"), "b"),
                      ["set_a", "set_b"], [("similar", "boolean")], _compare)
    return staged(full.where("similar").select("a", "b"), "similar")


def block_links(members: DataFrame, docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """Links (a, b) between members (key, band, id, size, component) of large buckets that are not connected yet."""
    share = members.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    main = share.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.sum("total").alias("total"))
    main = main.select("key", F.col("main.component").alias("main"),
                       F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    rows = members.join(main, "key").withColumns({
        "rest": F.col("component") != F.col("main"), "block": F.pmod(F.xxhash64("id"), "blocks").cast("int")})
    # members outside the main component, in blocks, meet every block of the main component and of themselves
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    meets = F.when(F.col("rest"), F.concat(
        F.transform(every, lambda j: F.struct(F.lit(True).alias("cross"), F.col("block").alias("i"), j.alias("j"))),
        F.transform(every, lambda j: F.struct(F.lit(False).alias("cross"), F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    )).otherwise(F.transform(every, lambda i: F.struct(F.lit(True).alias("cross"), i.alias("i"), F.col("block").alias("j"))))
    sets = full_sets(rows.select("id").distinct(), docs)
    rows = (rows.join(sets, "id").join(sketch.select("id", "signature"), "id")
            .select("key", "band", "id", "component", "rest", "block", "signature", "set", F.inline(meets)))
    return staged(rows.groupBy("key", "cross", "i", "j").applyInPandas(_meet, "a bigint, b bigint").distinct(), "links")


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between the two sides of one meeting of blocks, enough to connect what they connect."""
    band, cross, i, j = (pdf[c].iloc[0] for c in ("band", "cross", "i", "j"))
    ids, block = pdf["id"].to_numpy(), pdf["block"].to_numpy()
    sig = np.frombuffer(b"".join(pdf["signature"]), np.uint32).reshape(len(pdf), -1)
    sets = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
    root = pdf["component"].to_numpy().copy()
    rest = pdf["rest"].to_numpy()
    left = np.flatnonzero(rest) if cross else np.flatnonzero(block == i)
    right = np.flatnonzero(~rest) if cross else np.flatnonzero(block == j)
    found = []
    for x in left.tolist():
        other = right[root[right] != root[x]]
        if not cross and i == j:
            other = other[other > x]
        matches = np.zeros(len(other), np.int64)
        for n in range(BATCH, sig.shape[1] + 1, BATCH):
            matches += (sig[other, n - BATCH:n] == sig[x, n - BATCH:n]).sum(1)
            alive = matches >= least_matches(n, PERCENT / 100, MISS)
            other, matches = other[alive], matches[alive]
        # a pair that shares an earlier band meets there
        early = (sig[other, :ROWS * band].reshape(len(other), band, ROWS) == sig[x, :ROWS * band].reshape(band, ROWS)).all(2).any(1)
        other, matches = other[~early], matches[~early]
        for y in other[np.argsort(-matches, kind="stable")].tolist():
            if root[y] != root[x] and _alike(sets[x], sets[y]):
                found.append((ids[x], ids[y]))
                root[root == root[y]] = root[x]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sketch = staged(sketches(docs), "sketches")
    # one id per digest; a doc_id with several texts has several, tied together by the doc_id
    alias = (sketch.where("digest is not null and doc_id is not null").groupBy("digest")
             .agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("size")))
    alias = staged(alias, "sets")
    same = sketch.where("digest is not null and doc_id is not null").select("doc_id", "digest").join(
        alias.select("digest", "id"), "digest").where("doc_id != id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    texts = docs.where("doc_id is not null").withColumnRenamed("doc_id", "id")

    keyed = bands(alias)
    shared = keyed.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("n")).where("n > 1")
    buckets = staged(keyed.join(shared.select("key", "lead"), "key"), "buckets")

    lead = buckets.where("id != lead").groupBy("id").agg(F.min("lead").alias("a"))
    links = similar_pairs(lead.select("a", F.col("id").alias("b")), texts, alias)
    now = buckets.join(components(links), "id", "left").select(
        "key", "band", "id", "size", F.coalesce("component", "id").alias("component"))
    mixed = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x != y")
    now = staged(now.join(mixed.select("key", "n"), "key"), "mixed")
    small = now.where(F.col("n") <= SMALL)
    pairs = (small.select("key", F.col("id").alias("a"), F.col("component").alias("ca")).join(
        small.select("key", F.col("id").alias("b"), F.col("component").alias("cb")), "key").where("a < b and ca != cb")
        .select("a", "b").distinct().join(lead.select("a", F.col("id").alias("b")), ["a", "b"], "left_anti"))
    links = links.union(similar_pairs(pairs, texts, alias)).union(block_links(now.where(F.col("n") > SMALL), texts, alias))
    known = components(links.union(same)).withColumnRenamed("id", "doc_id")
    return (sketch.select("doc_id", "n_shingles").join(known, "doc_id", "left")
            .withColumn("component_id", F.coalesce("component", "doc_id")).drop("component")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
