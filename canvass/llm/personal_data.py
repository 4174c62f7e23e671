"""Personal data (operator 8): labelers vote, expectation-maximisation weighs them, a classifier decides.

Base spans are those of four fixed patterns (e-mail, IP address, card, phone;
see ``base_spans``) and always stay. Beside them every document yields candidate
spans: digit groups, identity numbers, written-out e-mail addresses. Seven
labelers vote on each base span and candidate (for, against, no opinion): shape,
check digits and ranges, gazetteers of endings and prefixes, context words before
and around, neighbouring characters, grouping. The votes of all documents are counted
by pattern; expectation-maximisation over the counts estimates how reliable
each labeler is, without labels. A logistic span classifier, fitted on the
resulting posteriors with the votes and further shape features, accepts or
rejects the candidates.

Scale: one narrow pass finds spans; the counts per pattern are one aggregate
whose size is bounded by the number of patterns (1.3 million, a few hundred in
practice), not by the data; the last pass reads the spans alone.

Defined cases: null and empty texts have no spans; repeated documents get the
same spans; a candidate that overlaps a base span is dropped; of overlapping
candidates the first in (start, kind) stays; without any span nothing is fitted.
Columns named like the outputs are replaced, the text itself is not carried.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import read_table, staged, with_arrow

KINDS = ("email", "ip", "card", "phone", "id")   # the first four have base patterns

# Base patterns: fixed values.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# The contract's pattern; from inside a digit run nothing can match that does not match from its start, so long runs are read once.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# All matches of the three number patterns lie inside one run of these characters.
_RUN = re.compile(r"[0-9+][0-9 ().+-]*")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_GROUPS = re.compile(r"(?:\([0-9]{2,5}\)|[0-9]+)(?:[ .-]{1,2}(?:\([0-9]{2,5}\)|[0-9]+))*")
_SHAPES = ((2, re.compile(r"(?<![0-9.])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])")),
           (3, re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])")))
_IDENTITY = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_WRITTEN = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_AT = re.compile(r"[\[(]at[\])]", re.I)   # in every match of _WRITTEN

# Gazetteers: fixed values.
ENDINGS = frozenset("com org net edu gov io info biz de fr es it uk us ch at nl be pt eu ca au example test".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
           "49", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38")
CUES = {"email": ("mail", "contact", "write", "correo", "kontakt", "courriel"), "ip": ("ip", "host", "server", "address", "login"),
        "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"), "phone": ("phone", "call", "tel", "mobile", "fax", "cell"),
        "id": ("ssn", "social", "security", "passport", "id")}
AGAINST = ("version", "page", "isbn", "order", "chapter", "section", "doi", "invoice", "no.", "#", "$", "€", "£", "§")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _numbers(run: str, at: int):
    """Base spans of the three number patterns in one run of number characters."""
    if run.count(".") >= 3:
        for m in IP.finditer(run):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                yield 1, at + m.start(), at + m.end()
    if len(run) >= 14:
        for m in CARD.finditer(run):
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                yield 2, at + m.start(), at + m.end()
    if "+" in run:
        for m in PHONE.finditer(run):
            if 10 <= len(_digits(m.group())) <= 15:
                yield 3, at + m.start(), at + m.end()


def _emails(text: str):
    """The e-mail pattern's matches, found from their @ signs."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = last + len(text[last:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield 0, start, m.end()
        last = m.end() if m else at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind: leftmost non-overlapping matches per kind that pass their test."""
    found = list(_emails(text))
    for m in _RUN.finditer(text):
        if m.end() - m.start() >= 7:
            found += _numbers(m.group(), m.start())
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that may be personal data and do not touch a base span."""
    found = []
    for m in _RUN.finditer(text):
        if m.end() - m.start() < 7:
            continue
        run, at = m.group(), m.start()
        for kind, shape in _SHAPES:      # a card or phone that a base match swallowed with its neighbours
            for g in shape.finditer(run):
                found.append((kind, at + g.start(), at + g.end()))
                run = run[:g.start()] + "\n" * len(g.group()) + run[g.end():]
        for g in _GROUPS.finditer(run):
            n = len(_digits(g.group()))
            if n >= 7:
                kind = 4 if _IDENTITY.fullmatch(g.group()) else 1 if IP.fullmatch(g.group()) else 2 if n >= 13 else 3
                found.append((kind, at + g.start(), at + g.end()))
    if _AT.search(text):
        found += [(0, m.start(), m.end()) for m in _WRITTEN.finditer(text)]
    kept, taken = [], sorted((a, b) for _, a, b in base)
    k, last = 0, 0
    for s in sorted(found, key=lambda s: (s[1], s[0])):
        while k < len(taken) and taken[k][1] <= s[1]:
            k += 1
        if s[1] >= last and not (k < len(taken) and taken[k][0] < s[2]):
            kept.append(s)
            last = s[2]
    return kept


LABELERS = 7


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> list[int]:
    """Each labeler's vote: 1 for, -1 against, 0 none."""
    span, name = text[start:end], KINDS[kind]
    digits = _digits(span)
    before, after = text[max(0, start - 40):start].lower(), text[end:end + 12].lower()
    shape = 1 if strict or any(k == kind and x.fullmatch(span) for k, x in _SHAPES) else 0
    if name == "email":
        ending = span.rsplit(".", 1)[-1].strip(" )]").lower()
        check = 1 if ending.isalpha() and len(ending) >= 2 else -1
        listed = 1 if ending in ENDINGS else 0
        group = 1 if "@" in span or "dot" in span.lower() else 0
    elif name == "ip":
        parts = span.split(".")
        check = 1 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        listed = -1 if parts[0] in ("0", "127", "255") else 0
        group = -1 if any(len(p) > 1 and p[0] == "0" for p in parts) else 1
    elif name == "card":
        check = 1 if luhn(digits) else -1
        listed = 1 if digits.startswith(ISSUERS) else 0
        group = 1 if re.fullmatch(r"[0-9]{4}([ -][0-9]{3,6}){2,4}", span) else 0
    elif name == "phone":
        check = 1 if 10 <= len(digits) <= 15 else -1 if len(digits) < 7 or len(digits) > 15 else 0
        listed = 1 if (span[0] == "+" and digits.startswith(CALLING)) or re.match(r"\(?0", span) else 0
        group = 1 if re.search(r"[0-9)][ .-][0-9(]", span) else -1 if len(set(digits)) == 1 else 0
    else:
        check = 1 if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000" else -1
        listed, group = 0, 1
    cue = 1 if any(c in before for c in CUES[name]) else 0
    near = -1 if any(c in before[-12:] for c in AGAINST) or after.startswith("%") else 0
    edge = -1 if before[-1:].isalnum() or after[:1].isalnum() else 0
    return [shape, check, listed, cue, near, edge, group]


def pattern(text: str, kind: int, start: int, end: int, strict: bool) -> int:
    """Kind, votes and shape features as one number."""
    code = kind
    for v in votes(text, kind, start, end, strict):
        code = code * 3 + v + 1
    n = sum(c.isdigit() for c in text[start:end])
    return (code * 4 + (0 if n < 8 else 1 if n < 10 else 2 if n < 13 else 3)) * 4 + min(3, len(re.findall(r"[^0-9A-Za-z]+", text[start:end])))


def unpack(patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes (0, 1, 2) and the two shape features."""
    extra = np.column_stack((patterns // 4 % 4, patterns % 4))
    code = patterns // 16
    cols = []
    for _ in range(LABELERS):
        cols.append(code % 3)
        code = code // 3
    return code, np.column_stack(cols[::-1]), extra


def reliabilities(kinds, vote, weight, rounds: int = 100):
    """Posterior of each pattern by expectation-maximisation: priors by kind, vote probabilities by labeler and class."""
    post = 1 / (1 + np.exp(-1.5 * (vote - 1).sum(1)))
    table = None
    for _ in range(rounds):
        prior = np.array([(weight[kinds == k] @ post[kinds == k] + 1) / (weight[kinds == k].sum() + 2) for k in range(len(KINDS))])
        table = np.empty((2, LABELERS, 3))
        for y, p in ((0, weight * (1 - post)), (1, weight * post)):
            for j in range(LABELERS):
                n = np.bincount(vote[:, j], p, 3) + 0.5
                table[y, j] = n / n.sum()
        score = np.log(prior / (1 - prior))[kinds]
        for j in range(LABELERS):
            score = score + np.log(table[1, j] / table[0, j])[vote[:, j]]
        new = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        done = abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return post, table


def classifier(kinds, vote, extra, post, weight, rounds: int = 200):
    """Probabilities by a logistic classifier on one-hot features, fitted on the posteriors (Newton steps, ridge 1)."""
    x = np.column_stack([np.eye(len(KINDS))[kinds]] + [np.eye(3)[vote[:, j]] for j in range(LABELERS)]
                        + [np.eye(4)[extra[:, j]] for j in range(extra.shape[1])])
    w = np.zeros(x.shape[1])
    share = weight / weight.sum() * 1e4          # the ridge weighs the same for any corpus size
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - post)) + w
        move = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), grad)
        w -= np.clip(move, -2, 2)
        if abs(move).max() < 1e-8:
            break
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def accepted_patterns(counts: list[tuple[int, int]]) -> frozenset[int]:
    """The patterns that the span classifier accepts, from (pattern, count) of all documents."""
    if not counts:
        return frozenset()
    counts = sorted(counts)
    patterns, weight = np.array([c[0] for c in counts]), np.array([c[1] for c in counts], float)
    kinds, vote, extra = unpack(patterns)
    post, _ = reliabilities(kinds, vote, weight)
    return frozenset(patterns[classifier(kinds, vote, extra, post, weight) >= .5].tolist())


_SPANS = "array<struct<kind:int,start:bigint,end:bigint,pattern:bigint>>"


def _find(texts):
    base, maybe = [], []
    for text in texts.to_pylist():
        b = base_spans(text) if text else []
        c = candidates(text, b) if text else []
        for out, spans, strict in ((base, b, True), (maybe, c, False)):
            out.append([{"kind": k, "start": x, "end": y, "pattern": pattern(text, k, x, y, strict)} for k, x, y in spans])
    return base, maybe


def _join(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


RESULT = [("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"),
          ("base_sha256", "string"), ("spans", "string")]


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text; the other columns but the text pass through."""
    found = staged(with_arrow(docs, [text], [("base", _SPANS), ("maybe", _SPANS)], _find).drop(text), "spans")
    seen = found.select(F.explode(F.concat("base.pattern", "maybe.pattern")).alias("pattern"))
    counts = [(r[0], r[1]) for r in seen.groupBy("pattern").count().collect()]
    accepted = docs.sparkSession.sparkContext.broadcast(accepted_patterns(counts))

    def finish(base, maybe):
        out = [[] for _ in RESULT]
        for b, m in zip(base.to_pylist(), maybe.to_pylist()):
            sure = [(s["start"], s["kind"], s["end"]) for s in b]
            more = [(s["start"], s["kind"], s["end"]) for s in m if s["pattern"] in accepted.value]
            row = [sum(k == i for _, k, _ in sure) for i in range(4)]
            row += [hashlib.sha256(_join(sure).encode()).hexdigest(), _join(sure + more)]
            for o, v in zip(out, row):
                o.append(v)
        return out

    return with_arrow(found, ["base", "maybe"], RESULT, finish).drop("base", "maybe")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document."""
    return personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
