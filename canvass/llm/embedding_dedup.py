"""Embedding near-duplicates (operator 13): lattice hashing.

Rows with equal labels are linked if their cosine, in double precision, is at
least ``COSINE``; groups are the connected components of these links.

1. Equal vectors of a label are one class from here on: its size counts.
2. ``TABLES`` times, eight coordinates of a randomly turned unit vector are
   decoded to the nearest point of the E8 lattice. The point is the vector's
   home cell in that table; the ``PROBES`` next lattice points around it (of the
   240 at least distance from the home) are cells that it visits.
3. Two classes meet in a cell that is home to one and home to or visited by the
   other. A meeting computes all cosines of its two sides.
4. A link found counts once: in the first table in which the pair meets, there
   in the common home, or else in the home of the smaller digest if both visit
   each other. A meeting gives out a link count and one edge per member, not its
   pairs.

At a cosine of 0.93 a pair meets in a table with probability 0.5, so that all
ten tables miss it with 0.001; from 0.96 on with less than 1e-6.

Scale: cell names are shuffled (90 of 8 bytes a class) and vectors once per
shared cell. Cells are cut into blocks of at most ``BLOCK`` classes that meet
pairwise, each meeting dealt on its own, so a cell of a third of all vectors is
spread over the cluster; its cosines are as many as its pairs, since the link
counts ask for them, but no pair leaves a task. Exact copies cost nothing. Random
directions share a cell with some 2e-4 of their label in each table: for labels
of many millions ``scale`` should grow, and ``tables`` with it.

Odd cases: vectors that are null, empty or zero, or hold null or non-finite
components, and rows without label or vec_id link with nothing; vectors of
different lengths never link; a vec_id with several vectors ties their groups
together, each row counts its own links; without vec_id component_id is null.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import components, read_table, small_batches, staged
from canvass.llm.hashing import mix

COSINE = 0.93
TABLES = 10
PROBES = 8
SCALE = 1.0
BLOCK = 512
SMALL = 24
BUCKET_ROWS = 8192


@functools.cache
def roots() -> np.ndarray:
    """The 240 points of E8 nearest to its origin."""
    at = np.arange(8)
    whole = [np.where(at == i, a, np.where(at == j, b, 0)) for i in range(8) for j in range(i) for a in (-1, 1) for b in (-1, 1)]
    signs = np.where(np.arange(256)[:, None] >> at & 1, -0.5, 0.5)
    return np.concatenate([np.array(whole, float), signs[(signs < 0).sum(1) % 2 == 0]])


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest whole-numbered points with an even sum."""
    y = np.rint(x)
    off = x - y
    odd = np.flatnonzero(y.sum(1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(1)
    y[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return y


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice points: whole-numbered or half-way ones, with an even sum."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


@functools.cache
def turn(length: int, tables: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Projection to 8 coordinates per table, and an offset: random rotations, so that tables of one rotation are orthogonal."""
    rng = np.random.default_rng([length, tables])
    need, parts = 8 * tables, []
    while sum(p.shape[1] for p in parts) < need:
        square = rng.normal(size=(length, length))
        parts.append(np.linalg.qr(square)[0] if length >= 8 else square / np.sqrt(length))
    return np.concatenate(parts, 1)[:, :need] * scale * np.sqrt(length), rng.uniform(0, 2, need)


def _name(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A 64-bit name of lattice points of a table."""
    name = mix(table.astype(np.uint64) + np.uint64(1))
    for c in range(8):
        name = mix(name * np.uint64(3) + (2 * points[..., c]).astype(np.int64).view(np.uint64))
    return name.view(np.int64)


def cells(unit: np.ndarray, tables: int, probes: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Names of the home cells (vector, table) and of the visited ones (vector, table, probe)."""
    project, offset = turn(unit.shape[1], tables, scale)
    x = (unit @ project + offset).reshape(-1, 8)
    home = decode(x)
    near = np.argpartition((home - x) @ roots().T, probes, axis=1)[:, :probes]
    table = np.tile(np.arange(tables), len(unit))
    visited = _name(home[:, None, :] + roots()[near], table[:, None])
    return _name(home, table).reshape(len(unit), tables), visited.reshape(len(unit), tables, probes)


def _units(vectors: np.ndarray) -> np.ndarray:
    big = vectors / np.abs(vectors).max(1, keepdims=True)
    return big / np.sqrt((big * big).sum(1, keepdims=True))


def _rows(batches):
    """vec_id, label, digest of (label, vector), vector as doubles; the last two null if the row takes no part."""
    for batch in batches:
        vec_id, label, vector = batch.columns
        names = label.cast(pa.string()).to_pylist()
        digests, kept = [], []
        for v, name, some in zip(vector, names, vec_id.is_valid().to_pylist()):
            x = None
            if some and name is not None and v.is_valid and len(v) and v.values.null_count == 0:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 is 0.0
            if x is None or not np.isfinite(x).all() or not x.any():
                digests.append(None)
                kept.append(None)
            else:
                kept.append(x.tobytes())
                digests.append(hashlib.blake2b(x.tobytes() + name.encode(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([vec_id.cast(pa.int64()), pa.array(names, pa.string()), pa.array(digests, pa.binary()), pa.array(kept, pa.binary())],
                                         names=["vec_id", "label", "digest", "vector"])


def _by_length(vectors: list[bytes]):
    """Positions and vectors, for each length that occurs."""
    sizes = np.array([len(v) // 8 for v in vectors])
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        yield at, np.frombuffer(b"".join(vectors[i] for i in at), np.float64).reshape(len(at), length)


def _label_name(label: str, length: int) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(f"{length}:{label}".encode(), digest_size=8).digest(), "little"))


def _keys(tables: int, probes: int, scale: float):
    """Cell keys of classes: one row per home and visited cell, named with label and length."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                digest, label, vector = (c.to_pylist() for c in part.columns)
                for places, values in _by_length(vector):
                    home, visited = cells(_units(values), tables, probes, scale)
                    salt = np.array([_label_name(label[i], values.shape[1]) for i in places])
                    every = np.concatenate([home[:, :, None], visited], 2)
                    key = mix(every.view(np.uint64) ^ salt[:, None, None]).view(np.int64)
                    shape = every.shape
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.ravel()), pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), shape[2]), shape[0])),
                        pa.array(np.tile(np.arange(shape[2]) == 0, shape[0] * tables)),
                        pa.array([digest[i] for i in places], pa.binary()).take(pa.array(np.repeat(np.arange(len(places)), tables * shape[2])))],
                        names=["key", "tbl", "home", "digest"])
    return run


def _linked(unit: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of left and right vectors at this cosine or more."""
    a, b = np.nonzero(unit[left] @ unit[right].T >= cosine - 1e-9)
    return left[a], right[b]


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each place reaches over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _meet(tables: int, probes: int, scale: float, cosine: float):
    """All meetings of a bucket: per member with links, its linked rows and one edge."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [_meet_length(pdf.iloc[at], values, tables, probes, scale, cosine) for at, values in _by_length(pdf["vector"].tolist())]
        return pd.concat(out, ignore_index=True)
    return run


def _meet_length(pdf: pd.DataFrame, values: np.ndarray, tables: int, probes: int, scale: float, cosine: float) -> pd.DataFrame:
    unit = _units(values)
    by = pdf["meeting"].to_numpy()
    order = np.lexsort((~pdf["side"].to_numpy(), by))  # the first side of each meeting first
    by, unit, values = by[order], unit[order], values[order]
    pdf = pdf.iloc[order]
    inner, first, table = pdf["inner"].to_numpy(), pdf["side"].to_numpy(), pdf["tbl"].to_numpy()
    start = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
    end = np.append(start[1:], len(by))
    size = np.repeat(end - start, end - start)
    pairs = []
    # small meetings all at once, place by place apart
    for d in range(1, SMALL):
        a = np.flatnonzero((size[:-d] <= SMALL) & (by[d:] == by[:-d])) if d < len(by) else np.zeros(0, np.int64)
        a = a[inner[a] | (first[a] != first[a + d])]
        a = a[np.einsum("ij,ij->i", unit[a], unit[a + d]) >= cosine - 1e-9]
        pairs.append((a, a + d))
    for s, e in zip(start.tolist(), end.tolist()):
        if e - s > SMALL:
            here = np.arange(s, e)
            if not inner[s]:
                pairs.append(_linked(unit, here[first[s:e]], here[~first[s:e]], cosine))
            elif first[s:e].all():  # one block with itself
                a, b = _linked(unit, here, here, cosine)
                pairs.append((a[a < b], b[a < b]))
            else:
                pairs.append(_linked(unit, here[first[s:e]], here[~first[s:e]], cosine))
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    label = pd.factorize(pdf["label"])[0]  # names of cells and meetings are hashes; links never rest on them
    a, b = a[label[a] == label[b]], b[label[a] == label[b]]
    a, b = _once(pdf, unit, inner, table, a, b, tables, probes, scale)
    # at the bound the cosine is computed plainly
    edge = np.abs(np.einsum("ij,ij->i", unit[a], unit[b]) - cosine) < 1e-9 if len(a) else np.zeros(0, bool)
    x, y = values[a[edge]], values[b[edge]]
    fails = np.flatnonzero(edge)[(x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) < cosine]
    a, b = np.delete(a, fails), np.delete(b, fails)
    weight = pdf["size"].to_numpy()
    n = np.bincount(a, weight[b], len(by)) + np.bincount(b, weight[a], len(by))
    root, some, ids = _spanning(len(by), a, b), np.flatnonzero(n), pdf["id"].to_numpy()
    return pd.DataFrame({"digest": pdf["digest"].to_numpy()[some], "n": n[some].astype(np.int64), "a": ids[some], "b": ids[root[some]]})


def _once(pdf, unit, inner, table, a, b, tables, probes, scale):
    """The pairs whose first meeting this is."""
    if not len(a):
        return a, b
    used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    home = np.empty((len(used), tables), np.int64)
    visited = np.empty((len(used), tables, probes), np.int64)
    for s in range(0, len(used), 1024):
        home[s:s + 1024], visited[s:s + 1024] = cells(unit[used[s:s + 1024]], tables, probes, scale)
    t = table[a]
    stay = np.ones(len(a), bool)
    for earlier in range(int(t.max())):  # a common home first, as it is found fastest
        q = np.flatnonzero(stay & (t > earlier))
        stay[q] = home[i[q], earlier] != home[j[q], earlier]
    for earlier in range(int(t.max())):
        q = np.flatnonzero(stay & (t > earlier))
        met = ((visited[i[q], earlier] == home[j[q], earlier][:, None]).any(1) | (visited[j[q], earlier] == home[i[q], earlier][:, None]).any(1))
        stay[q[met]] = False
    # b visits the home of a; if a visits that of b too, the smaller digest's home counts
    q = np.flatnonzero(stay & ~inner[a])
    both = (visited[i[q], t[q]] == home[j[q], t[q]][:, None]).any(1)
    digest = np.array(pdf["digest"].tolist(), "S16")
    stay[q[both & (digest[b[q]] < digest[a[q]])]] = False
    return a[stay], b[stay]


def _met(keyed: DataFrame) -> DataFrame:
    """key, tbl, meeting, side, inner, digest: the rows of every meeting; cells are cut into blocks that meet pairwise."""
    shared = keyed.groupBy("key").agg(
        F.sum(F.col("home").cast("bigint")).alias("homes"), F.count("*").alias("rows")).where("homes > 0 and rows > 1")
    rows = keyed.join(shared, "key").withColumns({
        "blocks": F.ceil(F.col("homes") / BLOCK).cast("int"), "others": F.ceil((F.col("rows") - F.col("homes")) / BLOCK).cast("int")})
    rows = rows.withColumn("block", F.pmod(F.xxhash64("digest"), F.when(F.col("home"), F.col("blocks")).otherwise(F.col("others"))).cast("int"))

    def meetings(n, make):
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make)).otherwise(F.array())

    def meeting(inner, i, j, side):
        return F.struct(inner.alias("inner"), i.alias("i"), j.alias("j"), side.alias("side"))

    yes, no, block = F.lit(True), F.lit(False), F.col("block")
    at_home = F.concat(
        meetings(F.col("blocks"), lambda j: meeting(yes, F.least(block, j), F.greatest(block, j), block <= j)),
        meetings(F.col("others"), lambda j: meeting(no, block, j, yes)))
    visiting = meetings(F.col("blocks"), lambda i: meeting(no, i, block, no))
    # a cell's only home class meets its visitors alone
    rows = rows.select("key", "tbl", "digest", "homes", F.inline(F.when(F.col("home"), at_home).otherwise(visiting)))
    return rows.where("not inner or homes > 1").withColumn("meeting", F.xxhash64("key", "inner", "i", "j")).drop("i", "j", "homes")


def embedding_duplicates(vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
                         cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``."""
    small_batches(vectors.sparkSession)
    given = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    rows = staged(given.mapInArrow(_rows, "vec_id bigint, label string, digest binary, vector binary"), "vectors")
    taking = rows.where("digest is not null")
    classes = staged(taking.groupBy("digest").agg(F.min("vec_id").alias("id"), F.count("*").alias("size"), F.first("label").alias("label"),
                                                  F.first("vector").alias("vector")), "classes")
    keyed = staged(classes.select("digest", "label", "vector").mapInArrow(
        _keys(tables, probes, scale), "key bigint, tbl int, home boolean, digest binary"), "cells")
    met = staged(_met(keyed), "meetings")
    buckets = max(1, -(-met.count() // BUCKET_ROWS))
    sides = met.join(classes.select("digest", "id", "size", "label", "vector"), "digest").withColumn("bucket", F.pmod("meeting", F.lit(buckets)))
    found = staged(sides.groupBy("bucket").applyInPandas(
        _meet(tables, probes, scale, cosine), "digest binary, n bigint, a bigint, b bigint"), "links")
    links = classes.join(found.groupBy("digest").agg(F.sum("n").alias("n")), "digest", "left").select(
        "digest", "id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")).where("n_links > 0")
    counted = staged(rows.select("vec_id", "digest").join(links, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "id"), "counted")
    edges = found.select("a", "b").union(counted.select(F.col("vec_id").alias("a"), F.col("id").alias("b"))).where("a != b").distinct()
    known = components(edges).withColumnRenamed("id", "vec_id")
    return (counted.drop("id").join(known, "vec_id", "left").withColumn("component_id", F.coalesce("component", "vec_id")).drop("component")
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op13_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings with equal labels."""
    return embedding_duplicates(read_table(spark, sf_dir, "embeddings"))
