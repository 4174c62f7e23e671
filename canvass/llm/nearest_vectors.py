"""Approximate nearest neighbours (operator 3): a forest of random-projection trees, one shared queue, exact reranking.

Fit: on a bounded sample of rows (``FIT_VALUES`` numbers at most, the smallest
hashes of vec_id) each tree splits its points by the plane halfway between two
of them, drawn at random, down to leaves that hold some ``LEAF`` of all rows. The
planes are the index; every row is routed to its leaf in every tree.

Search: a query walks all trees with one priority queue, ordered by how far it
is on the wrong side of the worst plane on the way; it collects leaves until
they hold ``SHARE`` of the rows. Rows and visits meet in groups of neighbouring
leaves of one tree; exact distances (double precision, original vectors) leave
each query's best k of the group. The last step ranks what the groups gave.

``SHARE`` suits vectors without any structure, as in the test tables, where
every plane separates many near pairs; clustered ones need a few leaves.

Scale: rows are shuffled once per tree, queries once per group visited. A leaf with
more than ``GROUP`` rows - copies that no plane separates - is dealt to several
groups, all of which its queries visit, so no group is larger. It counts as
``LEAF`` rows in the queue, so copies do not use a query's search up. The planes
and leaf counts are broadcast; their size is bound by the sample's.

Recall against brute force, 10 nearest: see the README; tests hold it above 0.9.

Defined cases: vectors that are null, zero, hold null or non-finite components,
or have another length than most take no part, as rows or queries; rows with
the query's vec_id are not its neighbours; a row given twice counts once;
fewer candidates than k give fewer results; ties go to the smaller vec_id; an
empty table gives none. Other columns are not carried.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.llm.common import read_table

TREES = 24
LEAF = 100               # rows in a leaf
SHARE, LEAST = 0.5, 8_000  # rows that a query's leaves hold: this share of all, and so many at least
GROUP = 16_384           # rows in a group of neighbouring leaves, or in a part of a leaf of copies
FIT_VALUES = 2_000_000   # numbers in the sample, 8 MB
K = 10


class Tree:
    """Planes of one random-projection tree; child -1 - j stands for leaf j."""

    def __init__(self, points: np.ndarray, leaf: int, rng: np.random.Generator):
        normals, offsets, children = [], [], []
        self.leaves = 0
        root = [0]
        todo = [(np.arange(len(points)), root, 0)]
        while todo:
            rows, parent, side = todo.pop()
            plane = self._plane(points[rows], rng) if len(rows) > leaf else None
            if plane is None:
                parent[side] = -1 - self.leaves
                self.leaves += 1
                continue
            normal, offset = plane
            above = points[rows] @ normal > offset
            parent[side] = len(normals)
            normals.append(normal)
            offsets.append(offset)
            children.append([0, 0])
            todo += [(rows[~above], children[-1], 0), (rows[above], children[-1], 1)]
        self.root = root[0]
        self.normals = np.array(normals, np.float32).reshape(len(normals), points.shape[1])
        self.offsets = np.array(offsets, np.float32)
        self.children = np.array(children, np.int64).reshape(len(children), 2)

    @staticmethod
    def _plane(points, rng, tries: int = 5):
        """The plane halfway between two points that leaves at least a tenth on either side, if one is found."""
        for _ in range(tries):
            a, b = points[rng.choice(len(points), 2, replace=False)]
            normal = a - b
            size = np.linalg.norm(normal)
            if size > 0:
                normal = normal / size
                offset = float(normal @ (a + b) / 2)
                above = int((points @ normal > offset).sum())
                if min(above, len(points) - above) * 10 >= len(points):
                    return normal, offset
        return None

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.full(len(x), self.root, np.int64)
        while (live := np.flatnonzero(at >= 0)).size:
            node = at[live]
            above = np.einsum("ij,ij->i", x[live], self.normals[node]) > self.offsets[node]
            at[live] = self.children[node, above.astype(np.int64)]
        return -1 - at


def search(trees: list[Tree], counts: dict[tuple[int, int], int], query: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """(tree, leaf) visits of a query, by one queue over all trees, until they hold ``wanted`` rows."""
    margins = [t.normals @ query - t.offsets for t in trees]
    queue = [(-np.inf, k, t.root) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    visits, held = [], 0
    while queue and held < wanted:
        worst, k, node = heapq.heappop(queue)
        if node < 0:
            n = counts.get((k, -1 - node), 0)
            if n:
                visits.append((k, -1 - node))
                held += min(n, LEAF)
            continue
        margin, (low, high) = float(margins[k][node]), trees[k].children[node].tolist()
        heapq.heappush(queue, (max(worst, margin), k, low))
        heapq.heappush(queue, (max(worst, -margin), k, high))
    return visits


def _usable(c: Column) -> Column:
    return (F.coalesce(F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(c, lambda x: x != 0), F.lit(False)))


def _matrix(col: pa.Array, d: int, kind=np.float64) -> np.ndarray:
    return col.flatten().to_numpy().reshape(-1, d).astype(kind)


def groups_of(counts: dict[tuple[int, int], int]) -> dict[tuple[int, int], tuple[int, int]]:
    """(tree, leaf) -> first group and number of parts: leaves next to each other share a group of at most GROUP rows."""
    out, group, held, before = {}, -1, 0, None
    for (t, leaf), n in sorted(counts.items()):
        if t != before or held + n > GROUP:
            group, held, before = group + 1, 0, t
        parts = -(-n // GROUP)
        out[t, leaf] = (group, parts)
        group, held = group + parts - 1, held + n
    return out


def nearest(df: DataFrame, queries: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, leaf: int = LEAF, share: float = SHARE, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that ``queries`` (a condition) picks."""
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("v"),
                     F.coalesce(queries, F.lit(False)).alias("query")).where(_usable(F.col("v")) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.range(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                                     F.lit(0.0).alias("score"))
    d, n = sizes
    rows = rows.where(F.size("v") == d)
    kind = rows.schema["v"].dataType.simpleString()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(2, FIT_VALUES // d)).select("v").collect()
    points = np.array([r.v for r in sample], np.float32)
    rng = np.random.default_rng(seed)
    forest = spark.sparkContext.broadcast([Tree(points, max(4, round(leaf * len(points) / n)), rng) for _ in range(trees)])

    def leaves(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _matrix(part.column(1), d, np.float32)
                for t, tree in enumerate(forest.value):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(np.full(len(x), t, np.int32)), pa.array(tree.route(x).astype(np.int32)), part.column(1)],
                        names=["vec_id", "tree", "leaf", "v"])

    held = rows.select("vec_id", "v").mapInArrow(leaves, f"vec_id bigint, tree int, leaf int, v {kind}")
    counted = {(r.tree, r.leaf): r.n for r in held.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast((counted, groups_of(counted)))
    wanted = max(LEAST, share * n)

    def place(batches):
        where = places.value[1]
        for batch in batches:
            group = [where[t, x][0] + (i % p if (p := where[t, x][1]) > 1 else 0) for i, t, x in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(group, pa.int32())],
                                             names=["vec_id", "leaf", "v", "group"])

    def visit(batches):
        counts, where = places.value
        for batch in batches:
            out = []
            for q, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                meets: dict[int, list[int]] = {}
                for t, x in search(forest.value, counts, np.array(v, np.float32), wanted):
                    first, parts = where[t, x]
                    for g in range(first, first + parts):
                        meets.setdefault(g, []).append(x)
                out += [(q, g, x, v) for g, x in meets.items()]
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int32()), batch.column(1).type)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["query_id", "group", "leaves", "q"])

    held = held.mapInArrow(place, f"vec_id bigint, leaf int, v {kind}, group int")
    visits = rows.where("query").select("vec_id", "v").distinct().mapInArrow(
        visit, f"query_id bigint, group int, leaves array<int>, q {kind}")

    def meet(here: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(here) and len(asked):
            here = here.sort_values(["leaf", "vec_id"])
            ids, x = here["vec_id"].to_numpy(), np.stack(here["v"].to_numpy()).astype(np.float64)
            leaf = here["leaf"].to_numpy()
            for q, wanted_leaves, v in zip(asked["query_id"], asked["leaves"], asked["q"]):
                a, b = np.searchsorted(leaf, wanted_leaves), np.searchsorted(leaf, wanted_leaves, "right")
                at = np.concatenate([np.arange(i, j) for i, j in zip(a, b)])
                at = at[ids[at] != q]
                score = np.sqrt(((x[at] - np.asarray(v, np.float64)) ** 2).sum(1))
                order = np.lexsort((ids[at], score))
                                # copies of one row may fill the first places: keep k different ids
                keep = order[np.sort(np.unique(ids[at][order], return_index=True)[1])[:k]]
                out.append((np.full(len(keep), q), ids[at][keep], score[keep]))
        return pd.DataFrame({c: np.concatenate([o[i] for o in out]) for i, c in enumerate(("query_id", "vec_id", "score"))})

    found = held.groupBy("group").cogroup(visits.groupBy("group")).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest neighbours of every row whose vec_id is divisible by 100."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
