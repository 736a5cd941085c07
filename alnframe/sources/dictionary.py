"""IO3: sequence dictionary files (``.dict``): header line, then one @SQ line per contig.

A dictionary is header-scale (one line per contig), so the whole file is read as one value
and split into lines; the index is the line order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sequence_dict(spark: SparkSession, path: str) -> DataFrame:
    """Skip line 1; name = text after ':' of the 2nd whitespace field, length = of the 3rd
    (0 when unparsable); ``seq_index`` = line order."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), "value")
    lines = whole.select("source", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    lines = lines.filter((F.col("line_no") > 0) & (F.length(F.trim("line")) > 0))
    f = F.split(F.trim("line"), r"\s+")
    def after_colon(c):
        return F.when(c.contains(":"), F.regexp_extract(c, r"^[^:]*:(.*)$", 1)).otherwise(c)
    return lines.select(
        (F.col("line_no") - 1).cast("int").alias("seq_index"),
        after_colon(F.get(f, 1)).alias("name"),
        F.coalesce(after_colon(F.get(f, 2)).try_cast("int"), F.lit(0)).alias("length"),
        "source")


def dict_lines(sequences: DataFrame) -> DataFrame:
    """Text lines of a ``.dict`` file for a sequences table (header first)."""
    spark = sequences.sparkSession
    head = spark.range(1).select(F.lit(-1).cast("int").alias("seq_index"),
                                 F.lit("@HD\tVN:1.0\tSO:unsorted").alias("value"))
    body = sequences.select(F.col("seq_index").cast("int"),
                            F.concat(F.lit("@SQ\tSN:"), F.col("name"), F.lit("\tLN:"),
                                     F.col("length").cast("string")).alias("value"))
    return head.unionByName(body)


def write_sequence_dict(sequences: DataFrame, path: str) -> None:
    """One small text file (header-scale)."""
    dict_lines(sequences).orderBy("seq_index").coalesce(1).select("value").write.mode("overwrite").text(path)
