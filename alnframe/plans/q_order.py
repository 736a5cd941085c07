"""Registered queries whose result shows the order of what was written, and the place of sequences in a dictionary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as FL
from ..operators import intervals as IV
from ..operators import sorts as SO
from ..operators import windows as WN
from ..session import shared_dir
from ..sources import adapter as A
from ..sources import bed as BED
from ..sources import sam as SAM
from .catalog import register
from .oracle_views import READS, READS_X, with_views
from .q_io import _W1_CORE


def _in_order(rows, sort_key, columns: list[str]):
    """``columns`` of rows read from a folder, and whether each row follows the one before it. Blocks are the splits of
    the files, then the files (so many as tasks wrote)."""
    split = F.struct("source", "split_start")
    rows = rows.withColumn("_at", F.struct("source", "split_start", "record_no"))
    bad = WN.check_sorted(rows, "_at", [split, F.col("source")], sort_key).select("_at", F.lit(False).alias("in_order"))
    return rows.join(bad, "_at", "left").select(*columns, F.coalesce("in_order", F.lit(True)).alias("in_order"))


# --------------------------------------------------------------------------- IO8

_REGIONS_SQL = with_views(READS, READS_X) + "," + _W1_CORE + """
SELECT ref_name || ':' || CAST(start AS VARCHAR) || '-' || CAST("end" AS VARCHAR) AS value, true AS in_order FROM iv
"""


@register("region_lines", _REGIONS_SQL)
def region_lines(spark, sf_dir):
    """W1 regions written as ``name:start-end`` lines, and the order of the lines in the files."""
    path = shared_dir(spark, "region-lines")
    BED.write_picard_regions(IV.merge_read_intervals(FL.callable_reads(A.reads(spark, sf_dir))), path)
    place = A.sequences(spark).select(F.col("name").alias("contig"), "seq_index")  # 25 rows
    lines = (SAM.read_lines(spark, path).withColumn("contig", F.substring_index("value", ":", 1)).join(place, "contig")
             .withColumn("start", F.regexp_extract("value", ":([0-9]+)-", 1).cast("int")))
    return _in_order(lines, F.struct("seq_index", "start"), ["value"])


# --------------------------------------------------------------------------- S1-S3: order of the written rows

def _written(spark, rows, name):
    path = shared_dir(spark, name)
    rows.write.parquet(path)
    back = spark.read.parquet(path)
    return back.select("*", F.col("_metadata.file_path").alias("source"),
                       F.col("_metadata.file_block_start").alias("split_start"), F.monotonically_increasing_id().alias("record_no"))


_ORDERED_SQL = with_views(READS) + """
SELECT read_id, true AS in_order FROM reads
"""


@register("coordinate_order", _ORDERED_SQL)
def coordinate_order(spark, sf_dir):
    reads = A.reads(spark, sf_dir).select("read_id", "read_name", "flag", "ref_index", "pos")
    back = _written(spark, SO.sort_coordinate(reads), "coordinate-order")
    return _in_order(back, WN.coordinate_sort_key(), ["read_id"])


@register("queryname_order", _ORDERED_SQL)
def queryname_order(spark, sf_dir):
    reads = A.reads(spark, sf_dir).select("read_id", "read_name", "flag", "ref_index", "pos")
    back = _written(spark, SO.sort_queryname(reads), "queryname-order")
    return _in_order(back, F.struct("read_name"), ["read_id"])


# --------------------------------------------------------------------------- W6

_W6_SQL = """
SELECT n_nationkey, 'c' || n_regionkey AS name, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS seq_index,
  count(*) OVER (PARTITION BY n_regionkey) > 1 AS duplicate_name
FROM nation
"""


@register("sequence_index", _W6_SQL)
def sequence_index(spark, sf_dir):
    """A dictionary with a line per nation, named by its region, so that names repeat."""
    lines = A.table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("c"), F.col("n_regionkey").cast("string")).alias("name"))
    return WN.assign_sequence_index(lines, "n_nationkey").select("n_nationkey", "name", "seq_index", "duplicate_name")
