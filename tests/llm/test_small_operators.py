"""URL rules, chat formatting, personal data, decontamination: rules and edge cases against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from canvass.llm import chat_format as chat
from canvass.llm import decontaminate as decon
from canvass.llm import personal_data as pii
from canvass.llm import url_filter as urls


def rules_of(spark, rows):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def judge_plain(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1).translate({c: c + 32 for c in range(65, 91)}), m.group(2)) if m else ("", "")
    fits = [(-len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits) if fits else (0, None, default)
    return host, path, best[1], best[2]


def test_url_rules_against_plain(spark):
    r = random.Random(1)
    rules = [("net", "/", "block"), ("a.net", "/x/", "allow"), ("b.org", "/", "block"), ("c.b.org", "/y", "allow"), ("org", "/q/", "allow")]
    hosts = ["a.net", "A.NET", "z.a.net", "xa.net", "b.org", "c.b.org", "d.c.b.org", "org", "", "a.net:80", "net."]
    paths = ["", "/", "/x/", "/x", "/y", "/yy/z", "/q/1?x=/y", "#f", "?u=://b.org/"]
    data = [(i, r.choice(["http://", "://", "https://", ""]) + r.choice(hosts) + r.choice(paths)) for i in range(400)]
    data += [(900, None), (901, ""), (902, "x"), (903, "http://a\nb.net/\nx"), (0, data[0][1])]
    df = spark.createDataFrame(data, "page_id long, url string").withColumn("verdict", F.lit("old"))
    got = sorted(tuple(x) for x in urls.judge_urls(df, rules_of(spark, rules)).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == sorted(((i, *judge_plain(u, rules)) for i, u in data), key=lambda x: x[:3])


def test_url_rules_shuffled_filter_and_empty(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_BLOCKS", 0)
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    rules = [(f"h{i}.com", "/", "block") for i in range(300)]
    df = spark.createDataFrame([(i, f"http://w.h{i}.com/p") for i in range(0, 600, 7)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, rules_of(spark, rules)).collect()}
    assert got == {i: "block" if i < 300 else "allow" for i in range(0, 600, 7)}
    assert {r.verdict for r in urls.judge_urls(df, rules_of(spark, [])).collect()} == {"allow"}
    assert urls.judge_urls(df.limit(0), rules_of(spark, rules)).count() == 0


def test_chat_layouts_round_trip(spark):
    odd = "a<|im_end|>&amp;&lt;|x<|\n&nl;"
    df = spark.createDataFrame([
        (1, "hi", odd, None, None, None, None),
        (2, None, None, "do", "in", "out", None),
        (3, None, None, "do", None, "out", None),
        (4, None, None, None, None, None, [("user\nx", "q"), ("assistant", None), (None, odd), ("assistant", "z")]),
        (5, "only", None, None, None, None, None),
        (6, None, None, None, None, None, [])],
        "id int, prompt string, response string, instruction string, input string, output string, "
        "messages array<struct<role:string,content:string>>")
    done = chat.format_turns(chat.canonical_turns(df, ("id",)))
    got = {r.id: r for r in done.withColumns({
        "back": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("formatted"), F.col("loss_spans"))}).collect()}
    want = {1: ("prompt", [("user", "hi"), ("assistant", odd)]), 2: ("instruction", [("user", "do\nin"), ("assistant", "out")]),
            3: ("instruction", [("user", "do"), ("assistant", "out")]),
            4: ("messages", [("user\nx", "q"), ("assistant", ""), ("", odd), ("assistant", "z")]), 5: (None, []), 6: (None, [])}
    for i, (layout, turns) in want.items():
        assert got[i].layout == layout
        assert [tuple(t) for t in got[i].back] == turns == [tuple(t) for t in got[i].turns]
        assert got[i].loss == "".join(t for r, t in turns if r == "assistant")


def base_plain(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, m.start(), m.end()) for m in pii.EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in pii.IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, m.start(), m.end()) for m in pii.CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [(3, m.start(), m.end()) for m in pii.PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def test_base_spans_equal_plain_patterns():
    r = random.Random(2)
    for alphabet in ("0123456789+ ().-@ab%._\n1234", "4111 -1", "a@b.c1.-"):
        for _ in range(4000):
            t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
            assert pii.base_spans(t) == base_plain(t)


@pytest.mark.parametrize("text", ["JOHN [AT] EXAMPLE.COM", "john (At) example (dot) com", "so john[aT]example.com", "x [AT) EXAMPLE [DOT] COM"])
def test_written_out_addresses_in_any_case(text):
    spans = [(0, m.start(), m.end()) for m in pii._WRITTEN.finditer(text)]
    assert len(spans) == 1 and pii.candidates(text, []) == spans
    assert pii.candidates(text + " that cat) sat", []) == spans


def test_personal_data_adds_swallowed_spans(spark):
    clean = [(i, f"mail x{i}@mail.example.com or +1 (209) 555-{1000 + i} card 4041894974608795 ip 10.1.2.{i}") for i in range(60)]
    both = "so +1 (269) 555-3296 4041894974608795 was"
    junk = [(100 + i, f"token {i}7f5{i}9566113270ab") for i in range(20)]
    df = spark.createDataFrame([*clean, (90, both), *junk, (200, None), (201, ""), (0, clean[0][1])], "doc_id long, text string")
    got = [r.asDict() for r in pii.personal_data(df).collect()]
    assert len(got) == len(clean) + len(junk) + 4
    by = {r["doc_id"]: r for r in got}
    assert (by[5]["n_email"], by[5]["n_ip"], by[5]["n_card"], by[5]["n_phone"]) == (1, 1, 1, 1)
    assert by[90]["n_card"] == by[90]["n_phone"] == 0            # one run of digits to the base patterns
    assert by[90]["spans"] == "phone:3:20,card:21:37"
    assert by[100]["spans"] == "" and by[200]["spans"] == by[201]["spans"] == ""
    assert pii.personal_data(df.limit(0)).count() == 0


def hits_plain(text, items, n=10):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower())
    ws, hit, found = words(text or ""), set(), set()
    for name, t in items:
        iw = words(t)
        for w in ({tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if len(iw) >= n else {tuple(iw)} if iw else ()):
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(name)
    return len(ws), len(hit), sorted(found)


@pytest.mark.parametrize("shard", [10_000, 40])
def test_benchmark_hits_against_plain(spark, shard):
    r = random.Random(3)
    word = lambda: r.choice(["a", "b", "ab", "ü"])
    items = [(str(i), " ".join(word() for _ in range(r.choice([0, 1, 3, 4, 6, 9])))) for i in range(12)] + [("2", "b, B. a ab")]
    docs = [(i, " ".join(word() for _ in range(r.randint(0, 40))).replace(" ", r.choice([" ", ", ", "\n"]))) for i in range(80)]
    docs += [(98, None), (99, ""), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("old"))
    bench = spark.createDataFrame([*items, (None, "a a"), ("9", None)], "item_id string, text string")
    got = sorted((x.doc_id, x.n_words, x.n_hit, list(x["items"])) for x in decon.benchmark_hits(df, bench, window=4, shard_words=shard).collect())
    assert got == sorted((d, *hits_plain(t, items, 4)) for d, t in docs)


def test_decontaminate_cuts_and_drops(spark):
    item = "One two three four five six seven eight nine ten eleven."
    df = spark.createDataFrame([(1, f"Start here, {item} And then some more words follow it.", "x"), (2, item, "x"), (3, "clean text", "x"),
                                (4, None, "x")], "doc_id long, text string, n_hit string")
    got = {r.doc_id: r for r in decon.decontaminate(df, spark.createDataFrame([("7", item)], "item_id string, text string")).collect()}
    assert set(got) == {1, 3, 4}
    assert got[1].text == "Start here, . And then some more words follow it." and got[3].text == "clean text" and got[4].text is None
    assert got[1].n_hit == "x"
