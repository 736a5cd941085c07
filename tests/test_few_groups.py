"""Tables of a few regions or groups are joined to reads without a shuffle of the reads."""

from pyspark.sql import functions as F

from alnframe.operators import joins as JN
from alnframe.operators import windows as WN
from alnframe.session import cut_lineage


def _reads(spark):
    return spark.range(40).select(F.col("id").cast("string").alias("read_id"), (F.col("id") % 4).cast("int").alias("ref_index"), (F.col("id") % 4).cast("int").alias("region"),
                                  F.col("id").cast("int").alias("pos"), F.when(F.col("id") % 4 == 3, "@JTh").otherwise("IIII").alias("qual"))


def test_the_encoding_of_groups_shuffles_no_reads(spark):
    plan = cut_lineage(spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 2)], "region int, partition int"))
    got = WN.region_quality_encoding(JN.assign_partitions(_reads(spark), JN.held(plan), repartition=False))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text  # both joins were sort-merge joins
    rows = got.groupBy("partition", "encoding", "qual").agg(F.count("*").alias("n")).collect()
    assert sorted(map(tuple, rows)) == [(0, "SANGER", "IIII", 20), (1, "SANGER", "IIII", 10), (2, "ILLUMINA", "!+5I", 10)]


def test_a_long_table_gets_no_hint(spark, monkeypatch):
    monkeypatch.setattr(JN, "HELD_ROWS", 3)
    assert "broadcast" not in JN.held(spark.range(4))._jdf.queryExecution().logical().toString()
    assert "broadcast" in JN.held(spark.range(3))._jdf.queryExecution().logical().toString()
