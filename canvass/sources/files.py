"""File sources (SRC3, SRC4, SRC5): saved API pages and exported sheets.

Explicit schemas everywhere; one-vs-many XML children are normalised by
declaring the child as an array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()


def _st(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S, True) for n in names])


MESSAGE = T.StructType([T.StructField(n, _S, True) for n in
                        ("id", "message_type", "message_template_id", "status", "body", "when")]
                       + [T.StructField("campaign", _st("id", "active"), True)])
PROFILE_SCHEMA = T.StructType([
    *[T.StructField(n, _S, True) for n in ("id", "first_name", "last_name", "phone_number", "email", "status",
                                           "created_at", "updated_at", "opted_out_at", "opted_out_source")],
    T.StructField("source", _st("type", "name", "id"), True),
    T.StructField("address", _st("street1", "street2", "city", "state", "postal_code", "country"), True),
    T.StructField("custom_columns", T.StructType([T.StructField(
        "custom_column", T.ArrayType(_st("name", "created_at", "updated_at", "value")), True)]), True),
    T.StructField("subscriptions", T.StructType([T.StructField(
        "subscription", T.ArrayType(_st("campaign_id", "campaign_name", "campaign_description", "opt_in_path_id",
                                        "status", "opt_in_source", "created_at", "activated_at", "opted_out_at",
                                        "opt_out_source")), True)]), True),
    T.StructField("messages", T.StructType([T.StructField("message", T.ArrayType(MESSAGE), True)]), True),
])


def read_profiles_xml(spark: SparkSession, path: str, row_tag: str = "profile") -> DataFrame:
    """SRC3: downloaded profile pages (XML). A single child and a list of
    children both arrive as an array; a missing container is null (the
    flattener turns it into an empty list)."""
    return (spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "_")
            .schema(PROFILE_SCHEMA).load(path).select(F.struct("*").alias("profile")))


def profiles_from_xml_strings(df: DataFrame, col: str) -> DataFrame:
    """SRC3 for XML already held in a string column (e.g. saved replies)."""
    return df.select(F.from_xml(F.col(col), PROFILE_SCHEMA).alias("profile"))


def read_tags(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """SRC4: ``conversation_id,tags`` CSV -> one row per (conversation, tag)."""
    raw = spark.read.schema("conversation_id string, tags string").option("header", True).csv(path)
    return (raw.select("conversation_id", F.explode(F.split(F.col("tags"), _escape(sep))).alias("tag"))
            .filter(F.col("tag") != ""))


def read_sheet(spark: SparkSession, path: str, columns: list[str], header_rows: int = 1) -> DataFrame:
    """SRC5: exported sheet; the first of ``header_rows`` rows names the
    columns, further header rows are skipped; keep only listed columns that
    exist. ``path`` may be a folder of sheets, each with its own header rows."""
    raw = spark.read.option("header", True).option("inferSchema", False)
    if header_rows > 1:
        # multiLine keeps a file whole, so its rows are numbered in order
        x = raw.option("multiLine", True).csv(path).withColumns(
            {"_file": F.input_file_name(), "_i": F.monotonically_increasing_id()})
        first = F.min("_i").over(Window.partitionBy("_file"))
        raw = x.withColumn("_first", first).filter(F.col("_i") - F.col("_first") >= header_rows - 1).drop("_file", "_i", "_first")
    else:
        raw = raw.csv(path)
    keep = [c for c in columns if c in raw.columns]
    return raw.select(*keep)


def _escape(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in sep)
