"""Streaming ingest of SAM text.

The reference processes finished batches only (no watermark, state or event time), so
nothing stateful is built here. The one streaming entry point is ingest: SAM text files
arriving in a folder are parsed with the same expressions as the batch reader and can be
appended to the Parquet store (IO6) with ``foreachBatch``. Streaming sources have no
per-row file offset, so ``record_no`` is NULL and file order is (source, split_start)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sam import parse_sam_records


def stream_sam_records(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of parsed SAM records (header lines dropped) from a folder."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(folder).select(
        "value", F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.lit(None).cast("bigint").alias("record_no"))
    return parse_sam_records(lines)
