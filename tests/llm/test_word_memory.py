"""What a toxicity worker remembers of words is small, and forgetting changes no score."""

import numpy as np
import pyarrow as pa

from canvass.llm import toxicity as T


def test_remembered_words_are_bounded(monkeypatch):
    net = T.Network()
    assert T.Scorer(net).table.nbytes <= 10 << 20
    texts = [pa.array([" ".join(f"word{i * 97 + j}" for j in range(80))]) for i in range(12)]
    whole = T.Scorer(net)
    want = [whole(t)[0] for t in texts]
    monkeypatch.setattr(T, "CACHE", 200)
    small = T.Scorer(net)
    got = [small(t)[0] for t in texts]
    assert len(small.table) == 200 and len(small.row) <= 200
    np.testing.assert_allclose(got, want, rtol=1e-5)
