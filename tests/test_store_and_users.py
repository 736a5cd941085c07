"""Presorted writing, stored headers, long limits, user functions, and the scans of the pipeline."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from alnframe.operators import userfn as UF
from alnframe.plans import pipeline as PL
from alnframe.session import shared_dir
from alnframe.sources import adapter as A
from alnframe.sources import ordered as OR
from alnframe.sources import sam as SAM

from .conftest import SF_SMALL

READS = "record string, read_id string, read_name string, ref_index int, pos int, flag int, cigar string"


def _reads(spark, order):
    rows = [(f"{k:04d}", f"r{k}", name, ref, pos, 0, "10M") for k, (name, ref, pos) in enumerate(order)]
    return spark.createDataFrame(rows, READS).repartitionByRange(3, "record").sortWithinPartitions("record")


def blocks():
    return [F.substring("record", 1, 3), F.substring("record", 1, 2)]


def test_presorted_write_and_header(spark):
    path = shared_dir(spark, "t")
    order = [("b", 0, 5), ("a", 0, 5), ("c", 0, 9), *[("d", 1, k) for k in range(30)], ("z", -1, 0)]
    header = {"sequences": A.sequences(spark), "programs": spark.createDataFrame([("p", 1)], "id string, ord int")}
    OR.write_presorted(_reads(spark, order), path, header, "coordinate", "record", blocks())
    back = spark.read.parquet(path)
    assert back.count() == len(order) and "bin" in back.columns and {r.ref_index for r in back.select("ref_index").distinct().collect()} == {0, 1, -1}
    got = OR.read_stored_header(spark, path)
    assert set(got) == {"hd", "sequences", "programs"} and got["hd"].first().sort_order == "coordinate" and got["sequences"].count() == 25
    with pytest.raises(ValueError):
        OR.write_presorted(_reads(spark, order), path, {"genes": header["programs"]}, "unsorted", "record", blocks())


@pytest.mark.parametrize("order,rows,first", [
    ("coordinate", [("a", 0, 5), ("b", 1, 1), ("c", 0, 6), ("d", 0, 1)], "r2"),
    ("coordinate", [("a", 0, 5), ("b", -1, 0), ("c", 0, 6)], "r2"),
    ("queryname", [("a", 3, 5), ("b", 1, 1), ("aa", 0, 6)], "r2"),
])
def test_unsorted_reads_are_refused(spark, order, rows, first):
    path = shared_dir(spark, "t")
    with pytest.raises(OR.OutOfOrder) as refused:
        OR.write_presorted(_reads(spark, rows), path, {}, order, "record", blocks())
    assert refused.value.row.record == f"{int(first[1:]):04d}"
    local = path.removeprefix("file:")
    assert not os.path.exists(local)
    OR.write_presorted(_reads(spark, rows), path, {}, "unsorted", "record", blocks())
    assert spark.read.parquet(path).count() == len(rows)


def test_first_records(spark):
    reads = spark.range(0, 3000, numPartitions=5).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("k"), "id")
    by = [F.substring("k", 1, 4), F.substring("k", 1, 2)]
    for n in (0, 1, 10, 11, 1499, 2990, 2999, 3000, 5000):
        got = SAM.first_records(reads, n, "k", by)
        assert sorted(r.id for r in got.collect()) == list(range(min(n, 3000)))
    assert SAM.first_records(reads.limit(0), 5, "k", by).count() == 0


def test_map_reads_keeps_state_and_checks_the_schema(spark):
    reads = spark.range(0, 100, numPartitions=2).select(F.col("id").cast("string").alias("read_id"))

    def numbered():
        seen = {"n": 0}

        def step(batch):
            first = seen["n"]
            seen["n"] += batch.num_rows
            yield pa.table({"k": list(range(first, seen["n"])), "read_id": batch.column("read_id")})

        return step

    got = UF.map_reads(reads, numbered, "read_id string, k int")
    assert got.columns == ["read_id", "k"] and sorted(r.k for r in got.collect()) == sorted(2 * list(range(50)))
    with pytest.raises(Exception, match="lacks"):
        UF.map_reads(reads, lambda: lambda b: pa.table({"x": [1]}), "y int").collect()


def test_hot_groups_are_split(spark):
    rows = spark.range(0, 3000, numPartitions=4).select(F.col("id").cast("string").alias("read_id"), F.when(F.col("id") < 2000, 1).when(F.col("id") < 2900, F.col("id") % 7).alias("g"))

    def count(t):
        return pa.table({"g": t.column("g").slice(0, 1), "n": [t.num_rows], "most": [t.num_rows]})

    def merge(t):
        return pa.table({"g": t.column("g").slice(0, 1), "n": [sum(t.column("n").to_pylist())], "most": [max(t.column("most").to_pylist())]})

    got = {r.g: (r.n, r.most) for r in UF.map_groups(rows, ["g"], count, merge, "g long, n long, most long", "g long, n long, most long", rows_per_part=100).collect()}
    want = {r.g: r["count"] for r in rows.groupBy("g").count().collect()}
    assert {g: n for g, (n, _) in got.items()} == want and None in got and got[1][0] > 2000
    assert all(most < 200 for _, most in got.values())


def test_pipeline_scans_the_reads_three_times(spark):
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    plain = A.reads(spark, SF_SMALL).drop("tags").withColumn("pos", (1 + F.col("pos") % 2000).cast("int"))
    reads = plain.mapInArrow(counted, plain.schema).withColumn("tags", F.expr("CAST(NULL AS MAP<STRING, STRUCT<type: STRING, s: STRING, i: BIGINT, f: FLOAT, bytes: BINARY, ia: ARRAY<BIGINT>, fa: ARRAY<FLOAT>, atype: STRING>>)"))
    targets = spark.createDataFrame([(k, 1, 3000) for k in range(25)], "ref_index int, s int, e int")
    out = PL.call_variants(reads, A.sequences(spark), targets, A.reference_chunks(spark, chunk=4096), A.known_sites(spark, SF_SMALL), min_qual=1, chunk=4096)
    assert out["calls"].count() > 0 and out["recal"].count() > 0
    assert passed.value <= 3 * plain.count()


def test_unsorted_writing_keeps_the_order_given(spark):
    reads = spark.createDataFrame([(f"r{(i * 37) % 60:02d}", 4, "*", 0, 0, "*", "*", 0, 0, "ACGT", "IIII") for i in range(60)],
                                  "read_name string, flag int, ref_name string, pos int, mapq int, cigar string, mate_ref_name string, mate_pos int, isize int, seq string, qual string")
    path = shared_dir(spark, "unsorted")
    SAM.write_sam(reads.withColumn("read_id", F.col("read_name")), path, A.sequences(spark), order="unsorted")
    lines = [r.value for r in spark.read.text(path).select("value", "_metadata.file_name", F.monotonically_increasing_id().alias("k")).orderBy("file_name", "k").collect()]
    assert lines[0].startswith("@HD") and lines[0].endswith("SO:unsorted")
    assert [x.split("\t")[0] for x in lines if not x.startswith("@")] == [r.read_name for r in reads.collect()]
