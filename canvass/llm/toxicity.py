"""Toxicity (operator 7): a bidirectional gated recurrent network with attention pooling, in numpy.

A word is a run between ASCII characters that are no letter or digit; of a longer
run (text without spaces, say) every 64 characters, or 21 beyond ASCII, are a word.
Words get a vector from a hashed word table and the mean of hashed vectors of
character 3- and 4-grams (word starts and ends marked), so endings unseen in training
still share their stem's features. A forward and a backward GRU read windows of
``WINDOW`` words; attention over the joined states pools each window into one
logit. Windows overlap by half and the last one ends with the text, so every
word is scored whole; a document's logit is its largest window's.

Training: a bounded sample of labelled rows (``FIT_DOCS`` per class, the
smallest hashes of doc_id) with their whole texts, by Adam on the best windows of
each document (multiple-instance learning), then Platt scaling of the document
logits. Before each epoch one Spark pass scores every window of the sample and
brings only its best two and a few others per document to the driver; a last pass
gives the largest window logit of each whole text, which the scaling is fitted
on. The weights are a few hundred KB and broadcast. Scoring covers every
window of every document in one narrow pass.

Defined cases: texts without a word (null and empty ones too) score 0; a
label given twice counts as toxic if either says so; null labels are left out;
without a training row of both classes every score is 0; repeated documents are
scored alike; other columns pass through, those named like the outputs are replaced.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import held, read_table, staged, with_arrow

WINDOW, STRIDE = 32, 16
WORD_ROWS, CHAR_BITS, DIM, HIDDEN = 1 << 13, 13, 12, 8
FIT_DOCS, FIRST_WINDOWS = 1500, 6   # of each class; windows of a text in the first epoch
EPOCHS, BATCH_DOCS, RATE = 6, 64, 0.01
THRESHOLD = 0.3
LONG = r"([^\x00-\x7F]{21}|[^ ]{64})"   # a whole word: what follows in the run is the next
CACHE = 50_000   # words whose gate inputs are remembered in a worker: 192 bytes each, and as much for their row numbers


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Word codes of all texts in a row, the distinct words, and each text's first word."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    spaced = pc.replace_substring_regex(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    spaced = pc.replace_substring_regex(spaced, LONG, r"\1 ")
    words = pc.ascii_split_whitespace(pc.ascii_trim(spaced, " "))
    coded = words.flatten().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist(), words.offsets.to_numpy()


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word row of each word; all character n-gram rows in a row, and each word's first."""
    raw = [w.encode() for w in words]
    rows = np.fromiter((zlib.crc32(r) % WORD_ROWS for r in raw), np.int64, len(raw))
    text = np.frombuffer(b"".join([b"<" + r + b">" for r in raw]) + bytes(3), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(r) + 2 for r in raw])
    starts = np.concatenate(([0], ends[:-1]))
    n = len(text) - 3
    left = np.repeat(ends, ends - starts) - np.arange(n)       # characters up to the word's end
    three = text[:n] * np.uint32(0x9E3779B1) + text[1:n + 1] * np.uint32(0x85EBCA77) + text[2:n + 2] * np.uint32(0xC2B2AE3D)
    both = np.column_stack((three, three * np.uint32(31) + text[3:] * np.uint32(0x27D4EB2F) + np.uint32(1)))
    both = (both ^ (both >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    valid = np.column_stack((left >= 3, left >= 4))
    count = np.add.reduceat(valid.sum(1), starts)
    return rows, (both >> np.uint32(32 - CHAR_BITS))[valid].astype(np.int64), np.cumsum(count) - count


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, scoring of windows, and gradients."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, h = DIM, HIDDEN
        def make(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)
        self.w = {"word": make(WORD_ROWS, d, scale=.1), "char": make(1 << CHAR_BITS, d, scale=.1),
                  "in": make(2 * d, 6 * h, scale=.3), "bias": np.zeros(6 * h, np.float32),
                  "fwd": make(h, 3 * h, scale=.3), "bwd": make(h, 3 * h, scale=.3),
                  "att": make(2 * h, scale=.3), "out": make(2 * h, scale=.3), "off": np.zeros(1, np.float32)}
        self.platt = (1.0, 0.0)

    def vectors(self, rows, chars, first):
        n = np.diff(np.append(first, len(chars)))[:, None]
        return np.concatenate((self.w["word"][rows], np.add.reduceat(self.w["char"][chars], first) / n), 1)

    def gates(self, words: list[str]) -> np.ndarray:
        """Gate inputs of words for both directions: all that scoring needs of them."""
        return self.vectors(*features(words)) @ self.w["in"] + self.w["bias"]

    @staticmethod
    def _run(x, u, mask, keep=None):
        """Hidden states (time, window, h) of one direction over gate inputs x (time, window, 3h)."""
        h = u.shape[0]
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((x.shape[0], x.shape[1], h), np.float32)
        for t in range(x.shape[0]):
            g = state @ u[:, :2 * h]
            g += x[t, :, :2 * h]
            g *= .5                                  # logistic by tanh
            np.tanh(g, out=g)
            g += 1
            g *= .5
            z, r = g[:, :h], g[:, h:]
            rs = r * state
            c = np.tanh(x[t, :, 2 * h:] + rs @ u[:, 2 * h:])
            new = state + z * (c - state)
            if mask is not None:
                new = np.where(mask[t][:, None], new, state)
            if keep is not None:
                keep.append((state, z, r, rs, c))
            state = out[t] = new
        return out

    def logits(self, x, mask=None, keep=None):
        """Window logits of gate inputs x (time, window, 6h). mask (time, window): false where no word is."""
        h3 = 3 * HIDDEN
        kf, kb = ([], []) if keep is not None else (None, None)
        f = self._run(x[:, :, :h3], self.w["fwd"], mask, kf)
        b = self._run(x[::-1, :, h3:], self.w["bwd"], None if mask is None else mask[::-1], kb)[::-1]
        s = np.concatenate((f, b), 2)
        a = s @ self.w["att"]
        if mask is not None:
            a = np.where(mask, a, np.float32(-1e4))
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        v = s @ self.w["out"]
        if keep is not None:
            keep.append((kf, kb, s, a, v))
        return (a * v).sum(0) + self.w["off"]

    def gradients(self, x, mask, dlogit, kept):
        """Gradients of the weights, and of the gate inputs, from those of the logits."""
        (kf, kb, s, a, v), = kept
        g = {}
        out = (a * v).sum(0)
        dv = a * dlogit
        da = a * (v - out) * dlogit
        g["out"], g["att"] = np.einsum("tw,twk->k", dv, s), np.einsum("tw,twk->k", da, s)
        g["off"] = np.array([dlogit.sum()], np.float32)
        ds = dv[:, :, None] * self.w["out"] + da[:, :, None] * self.w["att"]
        h = HIDDEN
        df, g["fwd"] = self._back(ds[:, :, :h], self.w["fwd"], mask, kf)
        db, g["bwd"] = self._back(ds[::-1, :, h:], self.w["bwd"], mask[::-1], kb)
        return g, np.concatenate((df, db[::-1]), 2)

    @staticmethod
    def _back(ds, u, mask, kept):
        h = u.shape[0]
        du, dx = np.zeros_like(u), np.empty((*ds.shape[:2], 3 * h), np.float32)
        down = np.zeros(ds.shape[1:], np.float32)
        for t in range(ds.shape[0] - 1, -1, -1):
            state, z, r, rs, c = kept[t]
            d = ds[t] + down
            live = np.where(mask[t][:, None], d, 0)
            dc = live * z * (1 - c * c)
            dz = live * (c - state) * z * (1 - z)
            drs = dc @ u[:, 2 * h:].T
            dr = drs * state * r * (1 - r)
            dg = np.concatenate((dz, dr), 1)
            du[:, 2 * h:] += rs.T @ dc
            du[:, :2 * h] += state.T @ dg
            down = np.where(mask[t][:, None], d * (1 - z) + drs * r + dg @ u[:, :2 * h].T, d)
            dx[t] = np.concatenate((dg, dc), 1)
        return dx, du


def fit(read, epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """A network from labelled texts.

    ``read(net, best, other, salt)`` lists (label, best windows under ``net``,
    their logits, other windows) of every text; a window is a list of words.
    """
    net, r = Network(seed), np.random.default_rng(seed)
    docs = read(None, 0, FIRST_WINDOWS, 0)
    if len({d[0] for d in docs}) < 2:
        return None
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    step = 0
    positives = [i for i, d in enumerate(docs) if d[0]]
    negatives = [i for i, d in enumerate(docs) if not d[0]]
    for epoch in range(epochs):
        if epoch:
            docs = read(net, 2, 2, epoch)
        n = max(len(positives), len(negatives))      # both classes equally often
        order = np.column_stack([np.resize(r.permutation(c), n) for c in (positives, negatives)]).ravel().tolist()
        for k in range(0, len(order), BATCH_DOCS):
            wins, ys, weights = [], [], []
            for i in order[k:k + BATCH_DOCS]:
                y, best, known, other = docs[i]
                if not epoch:
                    pick = other
                    share = .3 if y else 1.          # most windows of a toxic text may be clean
                elif y:                              # clearly clean windows of toxic texts teach nothing
                    pick, share = best[:1] if len(best) < 2 or known[1] < 0 else best, 1.
                else:
                    pick, share = best + other, 1.
                wins += pick
                ys += [y] * len(pick)
                weights += [share / len(pick)] * len(pick)
            y, share = np.array(ys, np.float32), np.array(weights, np.float32)
            vocab: dict[str, int] = {}
            win = np.array([[vocab.setdefault(x, len(vocab)) for x in w] + [-1] * (WINDOW - len(w)) for w in wins], np.int64)
            rows, chars, first = features(list(vocab))
            vec, mask, at = net.vectors(rows, chars, first), (win >= 0).T, np.maximum(win, 0).T
            x = (vec @ net.w["in"] + net.w["bias"])[at]
            kept: list = []
            logit = net.logits(x, mask, kept)
            d = ((_sigmoid(logit) - y) * share / share.sum()).astype(np.float32)
            g, dx = net.gradients(x, mask, d, kept)
            per = np.zeros((len(rows), 6 * HIDDEN), np.float32)
            np.add.at(per, at.reshape(-1), dx.reshape(-1, 6 * HIDDEN))
            g["in"], g["bias"] = vec.T @ per, per.sum(0)
            dvec = per @ net.w["in"].T
            lengths = np.diff(np.append(first, len(chars)))
            g["word"], g["char"] = np.zeros_like(net.w["word"]), np.zeros_like(net.w["char"])
            np.add.at(g["word"], rows, dvec[:, :DIM])
            np.add.at(g["char"], chars, np.repeat(dvec[:, DIM:] / lengths[:, None], lengths, 0))
            step += 1
            for name, grad in g.items():
                m, v = moment[name]
                m += .1 * (grad - m)
                v += .001 * (grad * grad - v)
                net.w[name] -= RATE * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .999 ** step)) + 1e-7)
    docs = read(net, 1, 0, epochs)
    net.platt = _platt(np.array([d[2][0] for d in docs], np.float64), np.array([d[0] for d in docs], np.float64))
    return net


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through document logits, with smoothed targets (Newton steps)."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + b)
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - t) * x).sum() + 1e-3 * (a - 1), (p - t).sum()])
        hess = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        move = np.linalg.solve(hess, grad)
        a, b = a - float(np.clip(move[0], -1, 1)), b - float(np.clip(move[1], -2, 2))
        if abs(move).max() < 1e-6:
            break
    return max(a, 1e-3), b


def window_starts(n: int) -> list[int]:
    """First words of the windows over n words; the last window ends with the text."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def text_windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of every window; ``first`` are the first words of the texts and the end."""
    starts, owner = [], []
    for d, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        got = window_starts(b - a)
        starts += [a + s for s in got]
        owner += [d] * len(got)
    return np.array(starts, np.int64), np.array(owner, np.int64)


class Scorer:
    """Scores texts with a network; remembers words' gate inputs."""

    def __init__(self, net: Network):
        self.net = net
        self.row: dict[str, int] = {"": 0}                        # row 0: no word
        self.table = np.zeros((CACHE, 6 * HIDDEN), np.float32)

    def _rows(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.row]
        if len(self.row) + len(new) > len(self.table):            # begin anew, with room for this run of texts
            self.row = {"": 0}
            new = [w for w in words if w]
            if len(new) >= len(self.table):
                self.table = np.zeros((len(new) + 1, 6 * HIDDEN), np.float32)
        if new:
            at = len(self.row)
            for k in range(0, len(new), 4096):                    # a word has up to 256 bytes
                part = new[k:k + 4096]
                self.table[at + k:at + k + len(part)] = self.net.gates(part)
            self.row.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))

    def logits(self, rows: np.ndarray, first: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Logit of each window; ``rows`` are the words' rows of the table."""
        rows = np.concatenate((rows, np.zeros(WINDOW, np.int64)))
        length = np.minimum(first[owner + 1] - starts, WINDOW)
        out = np.empty(len(starts), np.float32)
        for full in (True, False):
            chosen = np.flatnonzero((length == WINDOW) == full)
            for k in range(0, len(chosen), 2048):
                w = chosen[k:k + 2048]
                at = rows[starts[w] + np.arange(WINDOW)[:, None]]
                mask = None
                if not full:
                    mask = (np.arange(WINDOW)[:, None] < length[w]) & (at > 0)
                out[w] = self.net.logits(self.table[at], mask)
        return out

    def __call__(self, texts: pa.Array) -> np.ndarray:
        codes, unique, first = split_words(texts)
        rows = self._rows(unique)[codes]
        starts, owner = text_windows(first)
        best = np.full(len(first) - 1, -np.inf, np.float32)
        np.maximum.at(best, owner, self.logits(rows, first, starts, owner))
        a, b = self.net.platt
        some = np.add.reduceat(np.append(rows, 0) > 0, first[:-1]) * (np.diff(first) > 0) > 0 if len(first) > 1 else np.zeros(0, bool)
        return np.where(some, _sigmoid(a * best.astype(np.float64) + b), 0.)

    def chosen(self, texts: pa.Array, best: int, other: int, salt: int) -> tuple[list, list, list]:
        """Each text's windows with the largest logits, these logits, and some windows by hash."""
        codes, unique, first = split_words(texts)
        starts, owner = text_windows(first)
        logits = self.logits(self._rows(unique)[codes], first, starts, owner) if best else np.zeros(len(starts), np.float32)
        ends = np.searchsorted(owner, np.arange(len(first))).tolist()
        out: tuple[list, list, list] = ([], [], [])
        for d, (i, j) in enumerate(zip(ends[:-1], ends[1:])):
            top = (i + np.argsort(-logits[i:j], kind="stable")[:best]).tolist()
            rest = heapq.nsmallest(other, range(i, j), key=lambda w: zlib.crc32(b"%d %d %d" % (salt, first[d + 1] - first[d], starts[w] - first[d])))
            said = [[" ".join(unique[c] for c in codes[starts[w]:min(starts[w] + WINDOW, first[d + 1])]) for w in ws] for ws in (top, rest)]
            for part, value in zip(out, (said[0], logits[top].tolist(), said[1])):
                part.append(value)
        return out


def _scorer(weights):
    return held(("toxicity", weights.id_), lambda: Scorer(weights.value))


def _score(weights, texts):
    if weights.value is None:
        return ([0.0] * len(texts),)
    return (pa.array(_scorer(weights)(texts), pa.float64()),)


class _Shared:
    """A broadcast value with an id that is its own, so that workers keep one scorer per fit."""

    def __init__(self, broadcast):
        self.broadcast, self.id_ = broadcast, broadcast._jbroadcast.id() if broadcast._jbroadcast else None

    def __getstate__(self):
        return self.broadcast, self.id_

    def __setstate__(self, state):
        self.broadcast, self.id_ = state

    @property
    def value(self):
        return self.broadcast.value


def fold(doc_id: str) -> Column:
    """The fold of a document; labels of fold 2 are held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def fit_sample(docs: DataFrame, labels: DataFrame, text: str = "text", fit_docs: int = FIT_DOCS):
    """What ``fit`` reads: up to ``fit_docs`` labelled documents of each class, every window of their texts."""
    rows = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .where(fold("doc_id") != 2)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows = rows.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = [rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs) for y in (0, 1)]
    ids = [(r.doc_id, r.toxic) for c in chosen for r in c.collect()]
    label = dict(ids)
    picked = docs.where(F.col("doc_id").isin(list(label))) if label else docs.limit(0)

    sample = staged(picked.select("doc_id", F.col(text).alias("t")), "labelled")
    fields = [("best", "array<string>"), ("logits", "array<double>"), ("other", "array<string>")]

    def read(net, best, other, salt):
        shared = _Shared(docs.sparkSession.sparkContext.broadcast(net))
        got = with_arrow(sample, ["t"], fields, lambda t: _scorer(shared).chosen(t, best, other, salt))
        rows = sorted(tuple(r) for r in got.select("doc_id", "best", "logits", "other").collect())
        shared.broadcast.destroy()
        return [(label[d], [w.split(" ") for w in b], x, [w.split(" ") for w in o]) for d, b, x, o in rows if (b or o)[0]]

    return read


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD, **how) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score >= threshold)."""
    net = fit(fit_sample(docs, labels, text, **how))
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(net))
    out = with_arrow(docs, [text], [("score", "double")], lambda t: _score(shared, t))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; the fold with remainder 2 is never trained on."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out"), "score", "predicted")
