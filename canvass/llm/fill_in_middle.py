"""Fill-in-middle transformation (operator 12): one full match with a repeated capture.

A text's units are the words ``[A-Za-z]+`` and every other single character. One
``regex`` fullmatch of ``(unit)*`` keeps every repetition of its group, so the
ends of all captures are the offsets at which a text may be cut: their number is
n, and both cuts are looked up in them. No unit is iterated over in Python. The
loops of the pattern are possessive: nothing is ever tried twice, the match is
linear in the text.

Where a text is cut is decided by its id alone (sha256 of ``1:`` and the id), so
a rerun after a lost executor gives the same rows.

Scale: one narrow Arrow pass reads each text once and gives back three numbers;
pieces and their order are Column expressions. Nothing is shuffled. The captures
of one text take some 60 bytes a unit while it is matched.

Odd cases: a null or empty text has n = 0 and stays plain (output ""); a text
that holds one of the three markers stays plain, as it could not be read back; a
null id hashes as the empty string; rows repeat as they come; other columns stay,
those named like an output column are replaced.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import read_table, with_arrow

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # h3 % 100 from here on: left as it is
SPM_BELOW = 20   # h4 % 100 below: suffix first

_UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")


def _cuts(texts, first, second):
    """Units of each text, and the ends in characters of its first min and max (h % (n + 1)) units."""
    out = ([], [], [])
    for text, h, k in zip(texts.to_pylist(), first.to_pylist(), second.to_pylist()):
        ends = _UNITS.fullmatch(text or "").ends(1)
        n = len(ends)
        low, high = sorted((h % (n + 1), k % (n + 1)))
        out[0].append(n)
        out[1].append(ends[low - 1] if low else 0)
        out[2].append(ends[high - 1] if high else 0)
    return [pa.array(x, pa.int64()) for x in out]


def _draw(doc_id: str, group: int) -> Column:
    """The group-th eight hex digits of the id's hash, as a number."""
    hashed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(hashed, 1 + 8 * group, 8), 16, 10).cast("bigint")


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n, form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and fim_text."""
    docs = docs.drop("n", "form", "prefix_chars", "middle_chars", "fim_text")
    drawn = docs.withColumns({f"__h{i + 1}": _draw(doc_id, i) for i in range(4)})
    cut = with_arrow(drawn, [text, "__h1", "__h2"], [("n", "bigint"), ("__low", "bigint"), ("__high", "bigint")], _cuts)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plain = (whole == "") | whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE) | (F.pmod("__h3", F.lit(100)) >= PLAIN_FROM)
    form = F.when(plain, "plain").when(F.pmod("__h4", F.lit(100)) < SPM_BELOW, "spm").otherwise("psm")
    low, high = F.col("__low").cast("int"), F.col("__high").cast("int")
    prefix, middle = F.substring(whole, F.lit(1), low), F.substring(whole, low + 1, high - low)
    suffix = F.substring(whole, high + 1, F.length(whole))
    formed = cut.withColumn("form", form)
    is_plain = F.col("form") == "plain"
    out = (F.when(is_plain, whole)
           .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
           .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)))
    formed = formed.withColumns({
        "prefix_chars": F.when(~is_plain, F.col("__low")), "middle_chars": F.when(~is_plain, F.col("__high") - F.col("__low")),
        "fim_text": out})
    return formed.drop("__h1", "__h2", "__h3", "__h4", "__low", "__high")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from.

    The pieces hold no marker and a marker begins with its only ``<``, so the
    first marker found in each place is the one that was put there.
    """
    def pieces(second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
        one = F.substring_index(rest, second, 1)
        rest = F.substring(rest, F.length(one) + len(second) + 1, F.length(rest))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(rest))

    prefix, suffix, middle = pieces(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = pieces(PREFIX)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-middle training, with digests of the output and of the text read back from it."""
    docs = fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restored(F.col("fim_text"), F.col("form"))
    return docs.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


# The twin lists all units of a text and joins the first of them again.
OP12_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
units AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM drawn),
cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
         greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
pieces AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:], '') AS s
  FROM cuts)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM pieces
"""
