"""Operator 8: texts of very long numbers take linear time, and the address pattern stays the contract's."""

import random
import re
import time

from canvass.llm.personal_data import IP, base_spans, candidates

PLAIN = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_a_million_digits():
    for text in ("7" * 1_000_000 + " 1.2.3.4", "1." * 500_000, "+" * 300_000 + "1" * 300_000, "1.2.3" * 200_000):
        start = time.process_time()
        base = base_spans(text)
        candidates(text, base)
        assert time.process_time() - start < 10, text[:20]
    assert (1, 1_000_001, 1_000_008) in base_spans("7" * 1_000_000 + " 1.2.3.4")


def test_address_pattern_is_the_plain_one():
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choice("12.. -") for _ in range(rng.randint(0, 40)))
        assert [m.span() for m in IP.finditer(text)] == [m.span() for m in PLAIN.finditer(text)], text
