"""Operator 6: dealing by the piece's own number, bounds over every cut."""

import numpy as np
import pytest

from canvass.llm.packing import lower_bound, pack


def plain_bound(sizes, length):
    """The cut functions one by one."""
    best = 0
    for cut in range(1, length // 2 + 1):
        if cut in {min(s, length - s) for s in sizes}:
            best = max(best, -(-sum(length if s > length - cut else 0 if s < cut else s for s in sizes) // length))
    return best


def test_bound_tries_every_cut():
    rng = np.random.default_rng(2)
    for _ in range(200):
        sizes = rng.integers(1, 41, int(rng.integers(1, 60)))
        assert lower_bound(sizes, 40) >= plain_bound(sizes.tolist(), 40)
    assert lower_bound(np.array([2049] * 7 + [1] * 3), 4096) == 7


def test_one_id_on_every_row_is_dealt_like_others(spark):
    made = spark.range(6000).selectExpr("cast(null as bigint) doc_id", "0 piece", "cast(0 as bigint) start", "1 + pmod(id * 131, 4096) length", "id ids_crc32")
    out = pack(made, part_pieces=500)
    rows = out.collect()
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and len(rows) == 6000
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= 1.03 * lower_bound(np.array([r["length"] for r in rows]))
    with pytest.raises(ValueError):
        pack(made, part_pieces=1 << 20)
