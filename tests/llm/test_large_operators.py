"""Line dedup, vectors, near-duplicates, packing, toxicity, suffix dedup: against brute force on small tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from canvass.llm import line_dedup as lines
from canvass.llm import near_duplicates as near
from canvass.llm import nearest_vectors as vectors
from canvass.llm import packing, suffix_dedup as suffix, toxicity
from canvass.llm.common import components


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(r, text, n, alphabet):
    x = list(text)
    for _ in range(n):
        i, k = r.randrange(len(x)), r.randint(0, 2)
        if k == 0:
            x[i] = r.choice(alphabet)
        elif k == 1:
            x.insert(i, r.choice(alphabet))
        else:
            del x[i]
    return "".join(x)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_against_plain(spark, edits):
    r = random.Random(edits)
    pairs = []
    for _ in range(250):
        a = "".join(r.choice("abü") for _ in range(r.randint(8, 40)))
        pairs.append((a, edited(r, a, r.randint(0, 4), "abü")))
    got = Counter(tuple(x) for x in lines.edit_distance_at_most(spark.createDataFrame(pairs, "a string, b string"), "a", "b", edits).collect())
    assert got == Counter(p for p in pairs if distance(*p) <= edits)


def test_line_dedup_against_plain(spark, monkeypatch):
    monkeypatch.setattr(lines, "FIRST_LEADS", 2)                     # more rounds
    r = random.Random(5)
    seeds = ["".join(r.choice("abcde ") for _ in range(r.randint(33, 60))) for _ in range(8)]
    hot = "x" * 15 + " a very common beginning of lines "              # a segment that many different lines share
    pool = [edited(r, s, r.randint(0, 3), "abc") for s in seeds for _ in range(6)] + [hot + f"{i * 7919:020d}" for i in range(30)]
    pool = [p.replace("\n", "") for p in pool] + ["short", ""]
    docs = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 6)))) for i in range(60)] + [(70, None), (71, ""), (None, pool[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_removed", F.lit("old"))
    got = {x.doc_id: (x.deduped, x.n_lines, x.n_removed, x.n_near) for x in lines.dedup_lines(df).collect()}
    first = {}
    for d, t in sorted((d, t) for d, t in docs if d is not None and t is not None):
        for i, line in enumerate(t.split("\n")):
            if len(line) >= lines.MIN_CHARS:
                first.setdefault(line, (d, i))
    g = Groups(first.values())
    texts = list(first)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                g.join(first[a], first[b])
    for d, t in docs:
        split = t.split("\n") if t is not None else []
        gone = [d is not None and len(x) >= lines.MIN_CHARS and g.find(first[x]) != (d, i) for i, x in enumerate(split)]
        near_ = sum(b and g.find(first[x]) != first[x] for x, b in zip(split, gone))
        kept = "\n".join(x for x, b in zip(split, gone) if not b) if t is not None else None
        assert got[d] == (kept, len(split), sum(gone), near_), d
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_takes_exact_repeats_of_short_lines(spark, tmp_path):
    docs = [(1, "Menu\n\nfirst text\n "), (2, "Menu\n\nfirst texts\nMenu"), (3, "menu\n\n \nfirst text"), (None, "Menu"), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: (x.n_lines, x.n_removed, x.n_near, x.kept_sha256) for x in lines.op1_line_dedup(spark, str(tmp_path)).collect()}
    kept = {1: docs[0][1], 2: "\nfirst texts", 3: "menu\n\n ", None: "Menu", 4: ""}
    assert {d: g[1:3] for d, g in got.items()} == {1: (0, 0), 2: (2, 0), 3: (1, 0), None: (0, 0), 4: (0, 0)}
    assert {d: g[3] for d, g in got.items()} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in kept.items()}


def test_nearest_recall_ties_and_bad_vectors(spark, monkeypatch):
    r = np.random.default_rng(1)
    x = r.standard_normal((3000, 16)).astype(np.float32)
    x[:900] = x[0]                                                    # a third are copies of one vector
    rows = [(i, v.tolist(), 1.0) for i, v in enumerate(x)]
    rows += [(5000, None, 1.0), (5100, [0.0] * 16, 1.0), (5200, [float("nan")] * 16, 1.0), (5300, [1.0, None] * 8, 1.0),
             (5400, [1.0], 1.0), (5500, [float("inf")] * 16, 1.0), (7, x[7].tolist(), 1.0)]
    monkeypatch.setattr(vectors, "GROUP", 256)
    monkeypatch.setattr(vectors, "LEAST", 1500)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = {}
    for q in vectors.nearest(df, F.col("vec_id") % 100 == 0, trees=12, leaf=40).collect():
        got.setdefault(q.query_id, []).append((q.rank, q.vec_id, q.score))
    assert set(got) == set(range(0, 3000, 100))
    recall = []
    for q, found in got.items():
        d = np.sqrt(((x.astype(np.float64) - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(3000), d))[:10].tolist()
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(f[2] == pytest.approx(d[f[1]], abs=1e-12) for f in found)
        recall.append(len({f[1] for f in found} & set(best)) / 10)
        if q < 900:
            assert [f[1] for f in found] == best                        # copies: ties by id
    assert np.mean(recall) >= 0.9
    few = vectors.nearest(df.where("vec_id in (100, 1000, 2000)"), F.col("vec_id") % 1000 == 0).collect()
    assert Counter(q.query_id for q in few) == {1000: 2, 2000: 2}
    assert vectors.nearest(df.limit(0), F.lit(True)).count() == 0


def sets_plain(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.mark.parametrize("small, block", [(16, 512), (2, 7)])
def test_near_duplicates_against_plain(spark, monkeypatch, small, block):
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "BLOCK", block)
    r = random.Random(4)
    base = [[r.choice("abcdefghijklmnop") * r.randint(1, 4) for _ in range(60)] for _ in range(4)]
    docs = []
    for i in range(120):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice("xyz")
        docs.append((i * 3 % 131, " ".join(w) if r.random() < .8 else "\t".join(w).upper()))
    docs += [(500, None), (501, ""), (502, " \n"), (503, "a b"), (504, "A  b"), (505, "a b c d e"), (506, docs[0][1]), (506, docs[0][1]), (None, "a b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("component", F.lit(1))
    got = {q.doc_id: (q.n_shingles, q.component_id, q.kept) for q in near.near_duplicates(df).collect()}
    texts = {d: sets_plain(t) for d, t in docs if d is not None}
    g = Groups(texts)
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if texts[a] and texts[b] and 100 * len(texts[a] & texts[b]) >= 75 * len(texts[a] | texts[b]):
                g.join(a, b)
    assert got == {**{d: (len(s), g.find(d), g.find(d) == d) for d, s in texts.items()}, None: (1, None, True)}
    assert near.near_duplicates(df.limit(0)).count() == 0


def test_components_against_plain(spark):
    r = random.Random(12)
    for pairs in ([(i, i + 1) for i in range(30)], [(r.randrange(60), r.randrange(60)) for _ in range(40)], [(5, 5), (None, 3)], [(3, 1), (3, 2), (9, 1)]):
        g = Groups({x for p in pairs for x in p if x is not None})
        real = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
        for a, b in real:
            g.join(a, b)
        got = {(q.id, q.component) for q in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert got == {(x, g.find(x)) for p in real for x in p}


def test_posterior_bound():
    assert near.least_matches(128, 0.75, 1e-6) < 96 * 0.8
    assert [near.least_matches(n, 0.75, 1e-6) for n in (32, 64, 96, 128)] == sorted(near.least_matches(n, 0.75, 1e-6) for n in (32, 64, 96, 128))


def test_coder_equals_tokeniser():
    coder = packing.Coder(packing.default_vocabulary(), cache=500)
    r = random.Random(1)
    letters = [chr(c) for c in [*range(9, 127), *range(161, 600), 0x3a3, 0x4e2d, 0x301]]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["", "It's don't '''s we'll. a.b, c . ,", "a\x1cb", "İstanbul", "<|endoftext|> hi", "x\u0085y", "A. B, C.\nD", "end.", "1, 2."]
    for i in range(0, len(texts), 500):
        assert coder.ids(texts[i:i + 500]) == coder.whole(texts[i:i + 500])


def test_packing_rules(spark):
    r = random.Random(8)
    docs = [(i, " ".join(r.choice(["ab", "cat", "über", "x1"]) for _ in range(r.choice([0, 3, 40, 200, 900])))) for i in range(150)]
    docs += [(200, None), (201, ""), (5, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("piece", F.lit("old"))
    got = packing.pack(packing.pieces(df, length=256), length=256, part_pieces=40).collect()
    coder = packing.Coder(packing.default_vocabulary())
    want = Counter()
    for d, t in docs:
        ids = np.append(np.frombuffer(coder.whole([t or ""])[0], "<u4"), np.uint32(1)).astype("<u4")
        for k in range(0, len(ids), 256):
            want[d, k // 256, k, len(ids[k:k + 256]), zlib.crc32(ids[k:k + 256].tobytes())] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == want
    bins = {}
    for x in got:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 256
    sizes = np.array([x.length for x in got])
    assert packing.lower_bound(sizes, 256) <= len(bins) <= packing.lower_bound(sizes, 256) + 1
    assert packing.pack(packing.pieces(df.limit(0))).count() == 0


def test_lower_bound_never_above_best_fit():
    r = np.random.default_rng(3)
    for _ in range(60):
        sizes = r.integers(1, 101, r.integers(1, 40))
        assert packing.lower_bound(sizes, 100) <= packing.best_fit_decreasing(sizes, 100)[0].max() + 1
    assert packing.lower_bound(np.array([51] * 7 + [49]), 100) == 7


def test_toxicity_held_out_accuracy(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice(["ba", "to", "li", "ne", "ru"]) for _ in range(r.randint(1, 3)))
    docs, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        w = [word() for _ in range(r.choice([5, 20, 60, 150]))]
        if toxic:
            for _ in range(1 + len(w) // 30):
                w[r.randrange(len(w))] = r.choice(["zork", "GRUX", "plimf" + word()])
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs += [(2000, None), (2001, ""), (2002, "!!"), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("old"))
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = {q.doc_id: (q.score, q.predicted) for q in toxicity.score_toxicity(df, marks, fit_docs=300).collect()}
    held = [(y, got[d][1]) for d, y in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert sum(y == p for y, p in held) / len(held) > 0.95
    assert got[2000] == got[2001] == got[2002] == (0.0, 0) and all(0 <= s <= 1 for s, _ in got.values())
    assert {q.score for q in toxicity.score_toxicity(df, marks.limit(0)).collect()} == {0.0}


def test_toxicity_fits_on_whole_texts(spark, monkeypatch):
    """Toxic passages of long texts lie where no small choice of windows by hash finds them; the curve belongs to whole texts."""
    r = random.Random(8)
    word = lambda: "".join(r.choice(["ba", "to", "li", "ne", "ru"]) for _ in range(r.randint(1, 3)))
    starts = sorted(toxicity.window_starts(2400), key=lambda s: zlib.crc32(b"%d" % s))
    seen = {w for s in starts[:32] for w in range(s, s + toxicity.WINDOW)}
    unseen = [w for w in range(2400 - 4) if not seen & set(range(w, w + 4))]
    docs = []
    for i in range(360):
        w = [word() for _ in range(2400 if i % 2 else 40)]
        if i % 4 < 2:
            at = r.choice(unseen) if i % 2 else r.randrange(36)
            w[at:at + 4] = [r.choice(["zork", "grux", "plimf"]) for _ in range(4)]
        docs.append((i, " ".join(w), int(i % 4 < 2)))
    nets, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: nets.append(fit(*a, **k)) or nets[-1])
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    got = {q.doc_id: q.predicted for q in toxicity.score_toxicity(df.drop("toxic"), df.select("doc_id", "toxic")).collect()}
    net, sample = nets[0], [(t, y) for d, t, y in docs if zlib.crc32(str(d).encode()) % 4 != 2]
    fitted, net.platt = net.platt, (1.0, 0.0)
    p = toxicity.Scorer(net)(pa.array([t for t, _ in sample]))
    assert fitted == pytest.approx(toxicity._platt(np.log(p / (1 - p)), np.array([float(y) for _, y in sample])), rel=.01, abs=.01)
    held = [(y, got[d]) for d, _, y in docs if zlib.crc32(str(d).encode()) % 4 == 2]
    assert sum(y == p for y, p in held) / len(held) > 0.95


def test_toxicity_reads_long_runs_whole():
    score = toxicity.Scorer(toxicity.Network(3))
    for start, end in (("漢字" * 40, "毒" * 5), ("ab" * 90, "zork"), ("a中" * 50, "毒x")):
        words = toxicity.split_words(pa.array([f"so, {start}{end}!"]))
        assert "".join(words[1][c] for c in words[0]) == "so" + start + end
        p = score(pa.array([start, start + end, start + end[::-1] + end]))
        assert len(set(p.tolist())) == 3
    alike = toxicity.Network(3).gates(["漢" * 21 + "毒", "漢" * 21 + "字", "漢" * 21])
    assert len(np.unique(alike, axis=0)) == 3
    assert toxicity.split_words(pa.array(["a" * 64 + " b"]))[1] == ["a" * 64, "b"]


def test_toxicity_gradients():
    net = toxicity.Network(1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    r = np.random.default_rng(2)
    x = r.standard_normal((5, 3, 6 * toxicity.HIDDEN))
    mask = np.array([[1, 1, 1], [1, 1, 0], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    kept = []
    net.logits(x, mask, kept)
    g, dx = net.gradients(x, mask, np.array([1., -2., .5]), kept)
    loss = lambda: float((net.logits(x, mask) * [1., -2., .5]).sum())
    for array, grad in ((net.w["fwd"], g["fwd"]), (net.w["bwd"], g["bwd"]), (net.w["att"], g["att"]), (net.w["out"], g["out"]), (x, dx)):
        for at in [tuple(r.integers(0, s) for s in array.shape) for _ in range(6)]:
            was = array[at]
            array[at] = was + 1e-3
            up = loss()
            array[at] = was - 1e-3
            down = loss()
            array[at] = was
            assert grad[at] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def repeats_plain(raws, n):
    count = Counter(x[i:i + n] for x in raws for i in range(len(x) - n + 1))
    out = []
    for x in raws:
        cover = np.zeros(len(x) + 1, int)
        for i in range(len(x) - n + 1):
            if count[x[i:i + n]] > 1:
                cover[i:i + n] = 1
        kept = bytes(b for b, c in zip(x, cover) if not c)
        runs = int((np.diff(np.concatenate(([0], cover))) == 1).sum())
        out.append((len(x), len(x) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_against_plain(spark, seed):
    r = random.Random(seed)
    text = lambda n, a="abcdefghij klmnü": "".join(r.choice(a) for _ in range(n))
    shared = [text(r.randint(250, 900)) for _ in range(5)]
    docs = []
    for _ in range(30):
        parts = [r.choice([text(r.randint(0, 300)), r.choice(shared), r.choice(shared)[:r.randint(1, 600)], r.choice(shared)[r.randint(0, 300):]])
                 for _ in range(r.randint(0, 4))]
        docs.append("".join(parts))
    docs += [docs[0], docs[0], "a" * 1000, "a" * 399, "ab" * 450, (shared[0][:90] + "-") * 14, None, "", text(399), (text(260) + "|") * 5]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumn("n_bytes", F.lit("old"))
    got = {q.doc_id: (q.n_bytes, q.n_removed, q.n_spans, q.kept_sha256) for q in suffix.remove_repeats(df).collect()}
    want = repeats_plain([(d or "").encode() for d in docs], 400)
    assert got == dict(enumerate(want))


def test_suffix_ranks_against_sorting(spark):
    r = random.Random(9)
    runs = {(d, 0): [r.choice([3, 5, 8]) for _ in range(r.randint(1, 40))] for d in range(12)}
    rows = [(d, h, 0, i, v) for (d, h), x in runs.items() for i, v in enumerate(x)]
    got = {(q.h1, q.pos): q["rank"] for q in suffix.suffix_ranks(spark.createDataFrame(rows, "h1 long, h2 long, path long, pos long, name long")).collect()}
    depth = 3 ** suffix.LEVELS
    key = {(d, i): tuple((x[i:] + [0] * depth)[:depth]) for (d, _), x in runs.items() for i in range(len(x))}
    ordered = sorted(key, key=lambda k: got[k])
    assert all(key[a] <= key[b] for a, b in zip(ordered, ordered[1:]))
    assert all((key[a] == key[b]) or got[a] < got[b] for a, b in zip(ordered, ordered[1:]))


def test_suffix_ranks_share_names_with_their_neighbours(spark):
    r = random.Random(10)
    runs = {d: [r.choice([3, 5]) for _ in range(r.randint(1, 60))] for d in range(20)} | {20: [4] * 50, 21: [4] * 50}
    gap = {(d, i) for d in (3, 4, 20) for i in (7, 30)}
    rows = [(d, -d, 0, i, v) for d, x in runs.items() for i, v in enumerate(x) if (d, i) not in gap]
    df = spark.createDataFrame(rows, "h1 long, h2 long, path long, pos long, name long").repartition(7)
    got = sorted(suffix.suffix_ranks(df).collect(), key=lambda q: q["rank"])
    assert [q["rank"] for q in got] == list(range(1, len(rows) + 1))

    def names(q):
        end = min([len(runs[q.h1])] + [i for d, i in gap if d == q.h1 and i > q.pos])
        return runs[q.h1][q.pos:end][:3 ** suffix.LEVELS]

    def shared(x, y):
        return next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))

    pairs = [shared(names(a), names(b)) for a, b in zip(got, got[1:])]
    assert [q.before for q in got] == [0, *pairs] and [q.after for q in got] == [*pairs, 0]


def test_few_cuts_against_counting():
    r = np.random.default_rng(3)
    cut = [np.sort(r.choice(1500, k, replace=False)) for k in (0, 1, 2, 3, 5, 9, 20)] + [np.array([], int)]
    sizes = np.array([1500] * 7 + [399])
    want = set()
    for d, (c, size) in enumerate(zip(cut, sizes)):
        a, b = suffix.window_cuts(c, size, 400)
        want |= {(d, p) for p in np.flatnonzero(b - a < 1).tolist()}
    assert {(d, p) for d, x, y in suffix.few_cuts(cut, sizes, 400) for p in range(x, y)} == want


def test_suffix_dedup_sorts_once(spark, monkeypatch):
    """Each written table is a pass over the phrases or the windows; a sort by levels of triples wrote twenty."""
    r = random.Random(11)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared, labels, staged = text(900), [], suffix.staged
    monkeypatch.setattr(suffix, "staged", lambda df, label: (labels.append(label), staged(df, label))[1])
    docs = [(i, text(300) + shared + text(300)) for i in range(6)]
    rows = suffix.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    # the bytes beside the passage may agree by chance
    assert all(900 <= q.n_removed < 920 and q.n_spans == 1 for q in rows)
    assert len(labels) <= 7


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(df).count() == 0
    assert toxicity.Scorer(toxicity.Network())(pa.array([], pa.string())).shape == (0,)
