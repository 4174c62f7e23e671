"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``.

Defined cases are the operators'. Beyond them: a document that line dedup leaves
without any text, though it had some, goes with its last line; near-dedup keeps one
document of each group (the smallest doc_id), documents without doc_id stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import empty_workers, read_table, set_aside, staged
from canvass.llm.decontaminate import decontaminate
from canvass.llm.line_dedup import EXACT_CHARS, dedup_lines
from canvass.llm.near_duplicates import BROADCAST_IDS, near_duplicates
from canvass.llm.packing import pack, pieces
from canvass.llm.toxicity import score_toxicity

CACHED_WORDS = 100_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    empty_workers(spark)
    apart, give_back = set_aside(docs, ("doc_id", "text"))
    return give_back(score_toxicity(apart, read_table(spark, sf_dir, "labels")).where("predicted = 0"))


def _with_text(docs: DataFrame, text: str, changed) -> DataFrame:
    """The new text and, where it changed, its length as n_chars."""
    n_chars = F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns({"n_chars": n_chars, "text": F.col(text)})


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go. No Python runs here: toxicity's workers have emptied themselves."""
    apart, give_back = set_aside(docs, ("doc_id", "text", "n_chars"))
    done = dedup_lines(apart, exact_chars=EXACT_CHARS).where("n_removed = 0 or length(deduped) > 0")
    return give_back(_with_text(done, "deduped", F.col("n_removed") > 0))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    empty_workers(spark)
    gone = staged(near_duplicates(docs).where("not kept").select("doc_id").distinct(), "copies")
    # a broadcast list of bounded size leaves the texts in place
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are little else go."""
    empty_workers(spark)
    apart, give_back = set_aside(docs, ("doc_id", "text", "n_chars"))
    cut = decontaminate(apart.withColumn("was", F.length("text")), read_table(spark, sf_dir, "benchmark"))
    return give_back(_with_text(cut, "text", F.length("text") != F.col("was")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    empty_workers(spark)
    # the last stage runs in executors that earlier ones have filled: a small memory of words
    return pack(pieces(docs, cache=CACHED_WORDS, slice_bytes=512 << 10))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

# A trained classifier, edit distances and a tokeniser have no SQL form; tests
# hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
