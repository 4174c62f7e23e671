"""Operator 13 against all cosines."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from canvass.llm.embedding_dedup import decode, embedding_duplicates, op13_embedding_duplicates, roots
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label string, n_links string, `a.b` int"


def brute(rows):
    """vec_id -> links of each of its rows, and component, from all cosines."""
    ok = [i for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and r[1] and None not in r[1]
          and all(math.isfinite(x) for x in r[1]) and any(r[1])]
    n, root = [0] * len(rows), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, i in enumerate(ok):
        for j in ok[p + 1:]:
            x, y = np.array(rows[i][1]), np.array(rows[j][1])
            if rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                n[i] += 1
                n[j] += 1
                a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                root[b] = a
    return sorted((r[0] is None, r[0] or 0, n[i], None if r[0] is None else find(r[0])) for i, r in enumerate(rows))


def result(df):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in df.collect())


def around(rng, x, cosine):
    """A vector at this cosine of x."""
    z = rng.normal(size=len(x))
    u = x / np.linalg.norm(x)
    z -= (z @ u) * u
    return (cosine * u + math.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z)) * rng.uniform(0.1, 9)


def test_lattice():
    assert roots().shape == (240, 8) and np.allclose((roots() ** 2).sum(1), 2)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 8)) * 3
    y = decode(x)
    double = (2 * y).astype(int)
    assert (2 * y == double).all() and ((double % 2).sum(1) % 8 == 0).all() and (y.sum(1) % 2 == 0).all()
    here = ((x - y) ** 2).sum(1)
    assert (here <= 1 + 1e-9).all()  # the covering radius
    assert (here[:, None] <= (((x - y)[:, None] - roots()) ** 2).sum(2) + 1e-9).all()


def test_links_of_planted_copies(spark):
    rng = np.random.default_rng(8)
    rows, next_id = [], iter(range(10_000))
    for group in range(60):
        base = rng.normal(size=64)
        label = str(group % 3)
        rows.append((next(next_id), base.tolist(), label, "x", 1))
        for c in rng.choice([1.0, 0.999, 0.97, 0.95, 0.935, 0.9, 0.5], 5):
            rows.append((next(next_id), around(rng, base, c).tolist(), label, "x", 1))
        rows.append((next(next_id), base.tolist(), label, "x", 1))
        rows.append((next(next_id), base.tolist(), "other", "x", 1))
    got, want = result(embedding_duplicates(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    found, there = sum(r[2] for r in got), sum(r[2] for r in want)
    assert all(g[2] <= w[2] for g, w in zip(got, want)) and found >= 0.99 * there > 0
    assert sum(g[3] != w[3] for g, w in zip(got, want)) <= 0.01 * len(rows)


def test_large_group_in_blocks(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=24)
    rows = [(i, (base + 0.02 * rng.normal(size=24)).tolist(), "hot", "", 0) for i in range(1300)]
    rows += [(2000 + i, base.tolist(), "hot", "", 0) for i in range(900)]
    got = embedding_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()
    assert len(got) == 2200
    # all are close to the centre: everyone is linked with everyone, each pair counted once
    assert {r["n_links"] for r in got} == {2199} and {r["component_id"] for r in got} == {0}
    assert [r["vec_id"] for r in got if r["kept"]] == [0]


def test_odd_vectors(spark):
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, a, "x"), (2, [2.0, 4.0, 6.0], "x"), (2, b, "x"), (3, b, "x"), (4, a, None), (5, a, "y"), (None, a, "x"), (None, None, None),
            (6, None, "x"), (7, [], "x"), (8, [0.0, -0.0, 0.0], "x"), (9, [1.0, None, 3.0], "x"), (10, [1.0, float("nan"), 3.0], "x"),
            (11, [float("inf"), 2.0, 3.0], "x"), (12, [1.0, 2.0, 3.0, 0.0], "x"), (13, a, "x"), (13, a, "x"), (14, [1e300, 2e300, 3e300], "x"),
            (15, [7.0], "x"), (16, [-7.0], "x"), (17, [0.5], "x")]
    rows = [(*r, "old", 5) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    out = embedding_duplicates(df)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = result(out)
    want = brute([(r[0], [x / 1e300 for x in r[1]] if r[0] == 14 else r[1], r[2]) for r in rows])
    assert got == want
    assert embedding_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("cosine", [0.93, 0.96])
def test_recall_at_the_bound(spark, cosine):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1500):
        x = rng.normal(size=64)
        rows += [(2 * i, x.tolist(), "x", "", 0), (2 * i + 1, around(rng, x, cosine + 1e-6).tolist(), "x", "", 0)]
    out = embedding_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert out.where("n_links = 1").count() >= 0.98 * len(rows)
    assert out.where(F.col("component_id") == F.col("vec_id") - F.col("vec_id") % 2).count() >= 0.98 * len(rows)


def test_query_on_given_vectors(spark):
    rows = [(r[0], list(r[1]) if r[1] else None, r[2]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(op13_embedding_duplicates(spark, SF_SMALL)) == brute(rows)
