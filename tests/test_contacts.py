"""Contact cleaning goldens (phone, postal code, names, city/state, has-value)."""

import math

import pytest
from pyspark.sql import functions as F

from canvass.functions import contacts as C


def one(spark, col_fn, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col_fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("212555017", None),
    ("2125550173", "12125550173"),
    ("12125550173", "12125550173"),
    ("+12125550173", "12125550173"),
    ("try 212 555 0173 after six", "12125550173"),
    ("(212) 555-0173!", "12125550173"),
    ("fax: 212.555.0173", "12125550173"),
    ("order 9921255501734410", None),
])
def test_extract_phone(spark, text, expected):
    assert one(spark, C.extract_phone, text) == expected


@pytest.mark.parametrize("text,expected", [("zip 60614!", "60614"), ("zip 6061 4", None), ("606145", "60614")])
def test_extract_postal_code(spark, text, expected):
    assert one(spark, C.extract_postal_code, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("dover, delaware", ("dover", "DE")),
    ("Dover, Delaware", ("Dover", "DE")),
    ("Dover, DE", ("Dover", "DE")),
    ("Dover de", ("Dover", "DE")),
    ("Grand Forks North Dakota", ("Grand Forks", "ND")),
    ("Grand Forks nd", ("Grand Forks", "ND")),
    ("zzz", (None, None)),
    ("Dover, Delawar", (None, None)),
])
def test_city_state(spark, text, expected):
    r = one(spark, C.city_state, text)
    assert (r["city"], r["state"]) == expected


@pytest.mark.parametrize("text,expected", [
    ("MARTA LIND-BERG", ("Marta Lind-Berg", "Marta", "Lind-Berg")),
    ("Marta LInd-Berg", ("Marta LInd-Berg", "Marta", "LInd-Berg")),
    ("prof. lee tran", ("Prof. Lee Tran", "Prof. Lee", "Tran")),
    ("Public, Jane", ("Jane Public", "Jane", "Public")),
    ("public, jane q", ("Jane Public", "Jane", "Public")),
    ("John Smith Jr", ("John Smith", "John", "Smith")),
    ("John Smith, III", ("John Smith", "John", "Smith")),
    ("jane van der berg", ("Jane van der Berg", "Jane", "van der Berg")),
    ("Rosa Maria de la Cruz", ("Rosa de la Cruz", "Rosa", "de la Cruz")),
    ("SEAN O'BRIEN", ("Sean O'Brien", "Sean", "O'Brien")),
    ("ann mcdonald", ("Ann McDonald", "Ann", "McDonald")),
    ("Ada", ("Ada", "Ada", "")),
    ("", ("", "", "")),
])
def test_split_name(spark, text, expected):
    r = one(spark, C.split_name, text)
    assert (r["full"], r["first"], r["last"]) == expected


def test_has_value(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.0,), (1.5,)], "v double")
    got = [r[0] for r in df.select(C.has_value("v")).collect()]
    assert got == [False, False, True, True]


def test_zip5_and_phone_checks(spark):
    df = spark.createDataFrame([("2145",), ("02145-1234",), ("ab123",)], "z string")
    assert [r[0] for r in df.select(C.zip5("z")).collect()] == ["02145", "02145", None]
    df = spark.createDataFrame([("4155550142",), ("14155550142",), ("1155550142",), ("415555014",)], "p string")
    assert [r[0] for r in df.select(C.is_valid_phone("p")).collect()] == [True, True, False, False]


def test_email_keys(spark):
    df = spark.createDataFrame([("  A.B@Ex.Com ",)], "e string")
    r = df.select(C.canon_email("e").alias("c"), C.email_key("e").alias("k")).first()
    assert (r["c"], r["k"]) == ("a.b@ex.com", "ab@excom")


def test_postal_text(spark):
    df = spark.createDataFrame([(2145.0,), (94801.0,)], "z double")
    assert [r[0] for r in df.select(C.postal_text("z")).collect()] == ["02145", "94801"]
    assert not math.isnan(2145.0)
