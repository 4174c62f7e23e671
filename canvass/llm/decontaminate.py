"""Benchmark decontamination (operator 4): a generalised suffix automaton of the test items.

The benchmark's items, as normalised words, make one generalised suffix
automaton. The words of each document stream through it; the state and the
longest matching length at each word tell which 10-word windows end there, and
of which items. Words in runs of known words that are shorter than any window
cannot match and are stepped over.

Normal form: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (on
UTF-8 bytes this is the same, as all separators are ASCII). A window is 10
consecutive words of an item; a shorter item, but not an empty one, is one
window. A document word inside any occurrence of a window is hit.

Scale: documents are read once, without a shuffle. The automaton is broadcast,
so its size is bounded: items are counted first and dealt to shards of at most
``SHARD_WORDS`` words; each shard makes one automaton and one pass, and the
passes' spans are joined per document.

Defined cases: null or empty text has no words and no hits; items without text
or id are left out; an item id given twice is one item with the windows of
both; an empty benchmark hits nothing; repeated documents are judged alike;
other columns pass through, those named like the outputs are replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import read_table, set_aside, with_arrow

WINDOW = 10
SHARD_WORDS = 500_000   # words in one automaton, some 300 MB at most while it is built
MAX_COVERAGE = 0.8      # documents hit beyond this share go

# A-Z to a-z; other ASCII characters than 0-9 and a-z to a space
_TABLE = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
HITS = [("n_words", "bigint"), ("n_hit", "bigint"), ("items", "array<string>"),
        ("hit_spans", "array<struct<start:bigint,end:bigint>>")]


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class Automaton:
    """Generalised suffix automaton over word ids, with the windows of its items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for i, ws in items if ws]
        for _, ids in coded:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        # the state that stands for the last ``window`` words, for each state at least that long
        self.level = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[s] >= window:
                up = self.link[s]
                self.level[s] = s if self.length[up] < window else self.level[up]
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for name, ids in coded:
            s = 0
            for i, w in enumerate(ids):
                s = self.next[s][w]
                if i + 1 >= window:
                    self.items.setdefault(self.level[s], set()).add(name)
            if len(ids) < window:
                # a state may stand for several short items, one of each length
                self.short.setdefault(s, {}).setdefault(len(ids), set()).add(name)
        # the nearest state up the suffix links, itself included, at which a short item ends
        self.near = [0] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.near[s] = s if s in self.short else self.near[self.link[s]]
        self.least = min([window, *(len(ids) for _, ids in coded)])

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans [start, end) inside occurrences of windows, and the items."""
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        spans: list[list[int]] = []
        found: set[str] = set()
        for a, b in zip(known[::2].tolist(), known[1::2].tolist()):
            if b - a >= self.least:
                self._stream(ids[a:b].tolist(), a, spans, found)
        return [(a, b) for a, b in spans], found

    def _stream(self, ids: list[int], base: int, spans: list[list[int]], found: set[str]) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        s = matched = 0
        for i, w in enumerate(ids):
            while s and w not in nxt[s]:
                s = link[s]
                matched = length[s]
            if w in nxt[s]:
                s = nxt[s][w]
                matched += 1
            longest = 0
            if matched >= window:
                longest = window
                found |= self.items[self.level[s]]
            t = self.near[s]
            while t:
                for m, names in self.short[t].items():
                    if m <= matched:
                        longest = max(longest, m)
                        found |= names
                t = self.near[link[t]]
            if longest:
                a, b = base + i + 1 - longest, base + i + 1
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append([a, b])


def _merged(spans):
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _judge(automaton, texts):
    n_words, n_hit, items, spans = [], [], [], []
    a = automaton.value
    for text in texts.to_pylist():
        words = words_of(text)
        got, found = a.match(words) if len(words) >= a.least else ([], set())
        n_words.append(len(words))
        n_hit.append(sum(y - x for x, y in got))
        items.append(sorted(found))
        spans.append([{"start": x, "end": y} for x, y in got])
    return n_words, n_hit, items, spans


def benchmark_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
                   cut: str | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids as texts, sorted), hit_spans (word numbers) and, if named, ``cut``: the text without them.

    The text is cut in the last shard's pass: a pass of its own would keep a second Python worker beside each.
    """
    sc = docs.sparkSession.sparkContext
    more_fields = [(cut, docs.schema[text].dataType.simpleString())] if cut else []
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).dropna()
    size = F.length("text") - F.length(F.regexp_replace("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", "")) + 1
    total = rows.agg(F.sum(size)).first()[0] or 0   # separators + 1: at least the words
    shards = int(-(-total // shard_words)) or 1
    out = docs
    for k in range(shards):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == k).distinct().orderBy("id", "text").collect()
        automaton = sc.broadcast(Automaton([(r.id, words_of(r.text)) for r in part], window))
        last = more_fields if k == shards - 1 else []
        if k == 0:
            def first(t, a=automaton, last=last):
                got = _judge(a, t)
                return (*got, _cut(t, got[3])) if last else got
            out = with_arrow(docs, [text], HITS + last, first)
        else:
            def more(t, ids, spans, a=automaton, last=last):
                n_words, n_hit, new_ids, new_spans = _judge(a, t)
                ids = [sorted({*x, *y}) for x, y in zip(ids.to_pylist(), new_ids)]
                both = [_merged([(s["start"], s["end"]) for s in x + y]) for x, y in zip(spans.to_pylist(), new_spans)]
                hits = [[{"start": c, "end": b} for c, b in x] for x in both]
                got = n_words, [sum(b - c for c, b in x) for x in both], ids, hits
                return (*got, _cut(t, hits)) if last else got
            out = with_arrow(out, [text, "items", "hit_spans"], HITS + last, more)
    return out


def _cut(texts, spans):
    out = []
    for text, hit in zip(texts.to_pylist(), spans):
        if hit:
            raw = text.encode()
            at = [m.span() for m in _WORD.finditer(raw.translate(_TABLE))]
            kept, last = [], 0
            for s in hit:
                kept.append(raw[last:at[s["start"]][0]])
                last = at[s["end"] - 1][1]
            text = (b"".join(kept) + raw[last:]).decode()
        out.append(text)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", max_coverage: float = MAX_COVERAGE, **how) -> DataFrame:
    """The documents' own columns: hit spans cut from the text, documents hit beyond ``max_coverage`` left out."""
    apart, give_back = set_aside(docs, (text,))
    kept = benchmark_hits(apart, items, text, cut="__text", **how).where(F.col("n_hit") <= F.lit(max_coverage) * F.col("n_words"))
    return give_back(kept.drop(text).withColumnRenamed("__text", text))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark items in every whole document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = benchmark_hits(docs, read_table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents),
b as (
  select cast(item_id as varchar) as item, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from benchmark where text is not null and item_id is not null),
bw as (
  select distinct item, least(10, len(ws)) as n, ws[i:i + least(10, len(ws)) - 1] as win
  from (select item, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) as i from b where len(ws) > 0)),
lens as (select distinct n from bw),
dw as (
  select doc_id, n, i, ws[i:i + n - 1] as win
  from (select doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 1, 0) + 1)) as i from w, lens)),
m as (select doc_id, i, dw.n, item from dw join bw on dw.n = bw.n and dw.win = bw.win),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from m) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct doc_id, item from m) group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join h using (doc_id) left join its using (doc_id)
"""
