"""IO7, IO8: BED and Picard-style region files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BED_SCHEMA = T.StructType([
    T.StructField("ref_name", T.StringType()),
    T.StructField("start0", T.LongType()),
    T.StructField("end0", T.LongType()),
    T.StructField("name", T.StringType()),
])


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """BED (0-based, half-open) -> 1-based inclusive (ref_name, start, end, name).
    ``#``, ``track`` and ``browser`` lines are skipped; extra columns beyond name dropped."""
    lines = spark.read.text(path).filter(
        ~F.col("value").startswith("#") & ~F.col("value").startswith("track")
        & ~F.col("value").startswith("browser") & (F.length(F.trim("value")) > 0))
    f = F.split("value", "\t", -1)
    return lines.select(F.get(f, 0).alias("ref_name"), (F.get(f, 1).try_cast("int") + 1).alias("start"),
                        F.get(f, 2).try_cast("int").alias("end"), F.get(f, 3).alias("name"))


def bed_line(name="ref_name", start="start", end="end", half_open: bool = False):
    """Region line ``name<TAB>start-1<TAB>end-1`` as the region writer emits it; with
    ``half_open`` the standard ``end`` (one past the last base)."""
    e = F.col(end) if half_open else F.col(end) - 1
    return F.concat_ws("\t", F.col(name), (F.col(start) - 1).cast("string"), e.cast("string"))


def write_bed(intervals: DataFrame, path: str, half_open: bool = False, order=("ref_index", "start", "end"),
              name: str = "ref_name") -> None:
    """IO7: sorted region lines, range-partitioned parts in order."""
    (intervals.orderBy(*order).select(bed_line(name, "start", "end", half_open).alias("value"))
     .write.mode("overwrite").text(path))


def picard_line(name="ref_name", start="start", end="end"):
    """IO8: ``name:start-end`` (1-based)."""
    return F.concat(F.col(name), F.lit(":"), F.col(start).cast("string"), F.lit("-"), F.col(end).cast("string"))


def write_picard_regions(intervals: DataFrame, path: str, order=("ref_index", "start", "end")) -> None:
    (intervals.orderBy(*order).select(picard_line().alias("value")).write.mode("overwrite").text(path))
