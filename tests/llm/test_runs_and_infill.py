"""Operators 11 and 12 against plain versions."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass.llm.fill_in_middle import OP12_SQL, fill_in_middle, op12_fill_in_middle, restored
from canvass.llm.periodic_runs import find_runs, op11_periodic_runs, periodic_runs, planted
from tests.conftest import SF_SMALL

WORDS = re.compile("[^\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_runs(words):
    """(start, length, period) of all runs, period by period."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(12, 2 * q):
                run = words[start:start + length]
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(words):
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def plain_planted(doc_id, text):
    words, h = WORDS.findall(text or ""), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_runs_of_every_document(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in op11_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    # the plain version is quadratic: long texts without a planted tail are compared where they are short enough
    for doc_id, text in docs:
        words = plain_planted(doc_id, text)
        if len(words) <= 1500:
            assert got[doc_id] == plain_row(words), doc_id
    assert any(v[0] for v in got.values())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 9), st.integers(1, 40)), max_size=5), min_size=1, max_size=4))
def test_runs_of_nested_repeats(recipe):
    texts = []
    for steps in recipe:
        x = [0]
        for letter, period, times in steps:
            x.append(letter)
            for _ in range(times):
                x.append(x[-min(period, len(x))])
        texts.append(x)
    offsets = np.cumsum([0] + [len(x) for x in texts])
    start, end, period = find_runs(np.concatenate(texts).astype(np.int64), offsets)
    want = [(int(o) + s, n, q) for x, o in zip(texts, offsets) for s, n, q in plain_runs(x)]
    assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want


@pytest.mark.parametrize("words", [[0] * 3000, [0, 1] * 900, ([0, 1] * 30 + [2]) * 12, [0, 0, 1] * 100 + [0, 1] * 50])
def test_runs_of_long_powers(words):
    start, end, period = find_runs(np.array(words, np.int64), np.array([0, len(words)]))
    assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == plain_runs(words)


def test_runs_odd_rows(spark):
    texts = [None, "", " \t\n", "a", "a " * 13 + "b", "x\ty\n" * 20, "é ü " * 8, "w " * 200_000, "a " * 13 + "b", "a b " * 12]
    df = spark.createDataFrame([(i if i else None, t, "old", i) for i, t in enumerate(texts)], "doc_id int, text string, runs string, `a.b` int")
    rows = {r["a.b"]: r for r in periodic_runs(df).collect()}
    assert len(rows) == len(texts)
    assert [(rows[i]["n_words"], rows[i]["runs"], rows[i]["collapsed"]) for i in range(3)] == [(0, [], "")] * 3
    assert [tuple(r) for r in rows[4]["runs"]] == [(0, 13, 1)] and rows[4]["collapsed"] == "a b" == rows[8]["collapsed"]
    assert [tuple(r) for r in rows[5]["runs"]] == [(0, 40, 2)] and rows[5]["collapsed"] == "x y"
    assert [tuple(r) for r in rows[7]["runs"]] == [(0, 200_000, 1)]
    assert rows[9]["n_words"] == 12 and rows[9]["collapsed"] == "a b"  # a no-break space is no separator
    assert periodic_runs(df.limit(0)).count() == 0


def test_planted_tail(spark):
    df = spark.range(400).withColumn("text", F.when(F.col("id") % 7 != 0, F.concat_ws(" ", *[F.hex(F.xxhash64("id", F.lit(i))) for i in range(37)])))
    got = {r[0]: (r[1], r[2]) for r in df.select("id", "text", planted(F.col("text"), F.col("id")).alias("p")).collect()}
    for doc_id, (text, made) in got.items():
        assert WORDS.findall(made or "") == plain_planted(doc_id, text)


def test_infill_twin_and_round_trip(spark):
    got = {r[0]: tuple(r) for r in op12_fill_in_middle(spark, SF_SMALL).collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF_SMALL}/documents.parquet')")
    want = {r[0]: r for r in con.execute(OP12_SQL).fetchall()}
    assert got == want
    texts = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    assert all(row[6] == sha(texts[k] or "") for k, row in got.items())
    assert {row[2] for row in got.values()} == {"plain", "psm", "spm"}


def test_infill_against_a_plain_version(spark):
    rng = np.random.default_rng(5)
    alphabet = list("abZ \n\t<>PSM0é漢🙂İ")
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 60)))) for _ in range(400)]
    texts += [None, "", "<P>", "a<S>b", "<M", "<S<S", "<" * 9, "word" * 300_000, "7" * 200_000, "same", "same"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, form string")
    df = df.union(spark.createDataFrame([(None, "a null id, cut like any other", "x")], df.schema))
    made = fill_in_middle(df).withColumn("back", restored(F.col("fim_text"), F.col("form")))
    rows = made.collect()
    assert len(rows) == len(texts) + 1 and made.columns.count("form") == 1
    for r in rows:
        text, digest = r["text"] or "", sha(f"1:{'' if r['doc_id'] is None else r['doc_id']}")
        h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
        units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
        assert r["n"] == len(units) and r["back"] == text
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            assert (r["form"], r["fim_text"], r["prefix_chars"], r["middle_chars"]) == ("plain", text, None, None)
        else:
            form = "spm" if h[3] % 100 < 20 else "psm"
            out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
            assert (r["form"], r["fim_text"], r["prefix_chars"], r["middle_chars"]) == (form, out, len(p), len(m))
    assert fill_in_middle(df.limit(0)).count() == 0
