"""Custom-field diff truth tables (D1 vs D2) against a direct Python reading of the rules."""

import itertools

from pyspark.sql import functions as F

from canvass.operators import diff as DF

OLD = [None, "", "0", "5", "5.0", "7", "junk"]
NEW = [None, 0.0, 5.0, 6.0]


def _num(o):
    try:
        return float(o)
    except (TypeError, ValueError):
        return None


def and3(a, b):
    if a is False or b is False:
        return False
    if a is None or b is None:
        return None
    return True


def or3(*xs):
    if any(x is True for x in xs):
        return True
    if any(x is None for x in xs):
        return None
    return False


def not3(a):
    return None if a is None else not a


def eq3(a, b):
    return None if a is None or b is None else a == b


def crm_rule(o, n):
    blank = o is None or o == ""
    zero_skip = and3(eq3(n, 0.0), blank)
    ne = None if _num(o) is None or n is None else _num(o) != n
    return and3(not3(zero_skip), or3(blank and n is not None, (not blank) and n is None, ne))


def sms_plain_rule(o, n):
    blank = o is None or o == ""
    zero_skip = and3(eq3(n, 0.0), o is None)
    ne = None if _num(o) is None or n is None else _num(o) != n
    return and3(not3(zero_skip), or3(blank and n is not None, (not blank) and n is None, ne))


def test_crm_and_sms_truth_tables(spark):
    cases = list(itertools.product(OLD, NEW))
    df = spark.createDataFrame([(i, o, n) for i, (o, n) in enumerate(cases)], "i int, o string, n double")
    r = df.select("i", DF.crm_needs_update(F.col("o"), F.col("n")).alias("crm"),
                  DF.sms_needs_update(F.col("o"), F.col("n"), DF.PLAIN).alias("sms")).collect()
    for row in r:
        o, n = cases[row["i"]]
        assert row["crm"] == crm_rule(o, n), (o, n)
        assert row["sms"] == sms_plain_rule(o, n), (o, n)
    # the documented difference: wanted 0, stored '' -> CRM skips, SMS pushes
    i = cases.index(("", 0.0))
    assert r[i]["crm"] is False and r[i]["sms"] is True


def test_diff_fields_keeps_rows_needing_push(spark):
    stored = spark.createDataFrame([(1, "5", "Yes"), (2, "5", None), (3, None, "No")], "k int, a string, b string")
    wanted = spark.createDataFrame([(1, 5.0, 1), (2, 6.0, None), (3, None, None)], "k int, a double, b int")
    rules = [DF.FieldRule("a", DF.INT), DF.FieldRule("b", DF.YESNO)]
    got = {r["k"] for r in DF.diff_fields(stored, wanted, "k", rules, sms=True).collect()}
    assert got == {2}
