import pytest
from pyspark.sql import functions as F

from alnframe.functions import tags as TG
from alnframe.operators import windows as WN
from alnframe.operators.validate import validate_header
from alnframe.session import shared_dir
from alnframe.sources import sam as SAM

from .conftest import one


def _sam(spark, *lines):
    path = shared_dir(spark, "test-rules")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_reference_name_rules(spark):
    rest = ["60", "4M", "*", "0", "0", "ACGT", "IIII"]
    line = lambda name, ref: "\t".join([name, "0", ref, "5", *rest])
    body = [line("a", "c1"), line("b", "c9"), line("c", "=")]
    reads = SAM.read_sam(spark, _sam(spark, "@SQ\tSN:c1\tLN:100", *body))
    got = {r.read_name: [e.message for e in r.line_errors] for r in reads.select("read_name", "line_errors").collect()}
    assert got["a"] == [] and got["b"] == ["RNAME is not in the dictionary"]
    assert "RNAME is =" in got["c"]
    no_header = SAM.read_sam(spark, _sam(spark, *body[:2])).select("line_errors").collect()
    assert [list(r.line_errors) for r in no_header] == [[], []]


def test_strict_getters_raise(spark):
    tags = spark.range(1).select(TG.set_tag(TG.empty_tags(), "NM", TG.int_tag(F.lit(300).cast("bigint"))).alias("t"))
    assert one(tags.select(TG.tag_int("t", "NM", strict=True).alias("v"))).v == 300
    assert one(tags.select(TG.tag_int_ranged("t", "NM", -128, 127).alias("v"))).v is None
    assert one(tags.select(TG.tag_string("t", "XX", strict=True).alias("v"))).v is None
    for bad in (TG.tag_string("t", "NM", strict=True), TG.tag_int_ranged("t", "NM", -128, 127, strict=True),
                TG.tag_float_array("t", "NM", strict=True), TG.tag_char("t", "NM", strict=True)):
        with pytest.raises(Exception, match="tag NM is not"):
            tags.select(bad.alias("v")).collect()


def test_empty_array_tag_is_an_error(spark):
    v = TG._value(F.lit("B"), ia=F.array().cast("array<bigint>"), atype=F.lit("S"))
    with pytest.raises(Exception, match="needs elements"):
        spark.range(1).select(TG.set_tag(TG.empty_tags(), "XS", v).alias("t")).collect()


def test_header_rules_all_fire(spark):
    path = _sam(spark, "@HD\tSO:unsorted", "@SQ\tSN:c1", "@SQ\tSN:c2\tLN:x", "@SQ\tSN:c2\tLN:5", "@RG\tID:r\tPI:x\tDT:never",
                "@PG\tPN:p", "@XX\tAA:1", "@RG\tID:q\tSM:s\tSM:t")
    got = {r.message for r in validate_header(SAM.read_sam_header(spark, path)["records"]).collect()}
    assert got == {"@HD missing required tag VN", "@SQ missing required tag LN", "non-numeric LN", "duplicate id c2", "@RG missing required tag SM",
                   "non-numeric PI", "unparsable DT", "@PG missing required tag ID", "unknown header record type", "conflicting values for a tag"}


@pytest.mark.parametrize("levels", [["b3"], ["b1", "b2"], ["b1", "b2", "b3"]])
def test_sort_check_levels_agree_with_one_window(spark, levels):
    rows = spark.range(3000).select(F.col("id").alias("ord"), (F.xxhash64("id") % 50).alias("k"), (F.col("id") / 7).cast("int").alias("b1"),
                                    (F.col("id") / 70).cast("int").alias("b2"), (F.col("id") / 700).cast("int").alias("b3"))
    got = [r.ord for r in WN.check_sorted(rows, "ord", [F.col(c) for c in levels], F.col("k")).orderBy("ord").collect()]
    keys = [r.k for r in rows.orderBy("ord").collect()]
    assert got == [i for i in range(1, len(keys)) if keys[i] < keys[i - 1]]
