"""Result report (AR1) against a plain-Python statement of the rules."""

import datetime as dt

from canvass.operators.report import result_report
from canvass.plans import event_jobs as ej

MAIN = ["Ann", "Bob", "Cid"]


def py_cells(ev, main):
    """The 59-cell rules written directly (reference semantics, plain Python)."""
    res = ev["results"] or []
    zero = ev["event_type"] in ("alignment", "realignment")
    cells = [ev["id"], ev["precinct_id"], ev["phone_number"], ev["event_type"], ev["created_fmt"],
             ev["notes"], ev["media_url"], ev["attendee_count"] or 0]
    hits = {}
    for r in res:
        if r["name"] in main:
            hits[r["name"]] = (r["caucusers"], r["delegates"])
    for m in main:
        cells += list(hits.get(m, (0, 0) if zero else (None, None)))
    w = [(r["name"], r["caucusers"], r["delegates"]) for r in res if r["name"] not in main]
    w = sorted(w, key=lambda x: -x[1])
    top = sorted(w[:5], key=lambda x: x[0])
    for x in top:
        cells += list(x)
    cells += [None] * 3 * (5 - len(top))
    over = w[5:]
    cells += ["; ".join(f"{a}: {b} -> {c}" for a, b, c in over) if over else None,
              sum(b for _, b, _ in over) if over else None, sum(c for _, _, c in over) if over else None]
    ties = {}
    for r in res:
        if r.get("tieStatus") == "won":
            ties.setdefault(" ".join(sorted([r["name"], *(r.get("ties") or [])])), set()).add(r["name"])
    tl = sorted((k, " ".join(sorted(v))) for k, v in ties.items())
    for k, v in tl[:3]:
        cells += [k, v]
    cells += [None] * 2 * (3 - len(tl[:3]))
    cells.append("; ".join(f"{k}: {v}" for k, v in tl[3:]) if tl[3:] else None)
    return ["" if c is None else str(c) for c in cells]


def _r(name, c, d, ties=None, status=None):
    return {"name": name, "caucusers": c, "delegates": d, "ties": ties, "tieStatus": status}


def test_fixture_events(spark):
    created = dt.datetime(2020, 2, 4, 2, 30, 0)
    evs = [
        {"id": "e1", "precinct_id": "p1", "phone_number": "5550001", "event_type": "alignment", "notes": None,
         "media_url": None, "attendee_count": None, "results": None},
        {"id": "e2", "precinct_id": "p2", "phone_number": "5550002", "event_type": "final", "notes": "n",
         "media_url": "http://m", "attendee_count": 12,
         "results": [_r("Ann", 10, 1), _r("Zed", 7, 0), _r("Yul", 9, 2), _r("Xia", 7, 1), _r("Wes", 3, 0),
                     _r("Vic", 9, 0), _r("Hot Dogs", 23, 230), _r("\U0001F32D", 22, 220),
                     _r("Bob", 4, 1, ["Cid"], "won"), _r("Cid", 4, 1, ["Bob"], "won"),
                     _r("Uma", 1, 0, ["Tom"], "won"), _r("Sal", 1, 0, ["Rae"], "won"),
                     _r("Quo", 1, 0, ["Pip"], "won")]},
    ]
    schema = ("id string, precinct_id string, phone_number string, event_type string, notes string, "
              "media_url string, attendee_count long, created_at timestamp, results array<struct<name:string,"
              "caucusers:long,delegates:long,ties:array<string>,tieStatus:string>>")
    rows = [(e["id"], e["precinct_id"], e["phone_number"], e["event_type"], e["notes"], e["media_url"],
             e["attendee_count"], created, e["results"]) for e in evs]
    df = spark.createDataFrame(rows, schema)
    got = {r["id"]: r["cells"] for r in result_report(df, MAIN).collect()}
    for e in evs:
        e["created_fmt"] = "02/03/2020 20:30:00"
        want = py_cells(e, MAIN)
        assert len(got[e["id"]]) == 8 + 2 * len(MAIN) + 15 + 3 + 6 + 1
        assert got[e["id"]] == want, e["id"]


def test_bound_query_matches_python(spark):
    base = "/root/testdata/sf0.001"
    events = ej.order_results(spark, base).orderBy("id").limit(200).collect()
    main = ej.report_brands()
    got = {r["id"]: r for r in ej.result_report(spark, base).collect()}
    assert len(got) == ej.order_results(spark, base).count()
    for ev in events:
        e = ev.asDict(recursive=True)
        e["created_fmt"] = (e["created_at"] - dt.timedelta(hours=6 if e["created_at"].month in (1, 2, 3, 11, 12)
                            or (e["created_at"].month == 3) else 5)).strftime("%m/%d/%Y %H:%M:%S")
        want = py_cells(e, main)
        row = got[e["id"]]
        cells = [row[f"c{i + 1:02d}"] for i in range(59)]
        assert cells[:4] == want[:4] and cells[5:] == want[5:], e["id"]
