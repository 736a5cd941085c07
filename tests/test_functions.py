"""Golden vectors worked by hand from the reference's rules (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from alnframe.functions import bases as BQ
from alnframe.functions import bins as B
from alnframe.functions import cigar as C
from alnframe.functions import flags as FLG
from alnframe.functions import tags as TG
from alnframe.operators import validate as VA
from alnframe.sources import bed as BED

from .conftest import one


def test_cigar_lengths_and_clipped_ends(spark):
    df = spark.createDataFrame([("3H10S80M10S", 100, 0)], "cigar string, pos int, flag int")
    ops = C.parse_cigar("cigar")
    r = one(df.select(C.ref_length(ops).alias("ref"), C.read_length(ops).alias("rd"),
                      C.alignment_end("flag", "pos", ops).alias("end"),
                      C.unclipped_start("pos", ops).alias("us"), C.unclipped_end("flag", "pos", ops).alias("ue"),
                      C.format_cigar(ops).alias("back")))
    assert (r.ref, r.rd, r.end, r.us, r.ue, r.back) == (80, 100, 179, 87, 189, "3H10S80M10S")


def test_alignment_blocks_and_read_to_ref(spark):
    df = spark.createDataFrame([("50M2I48M", 100)], "cigar string, pos int")
    b = C.alignment_blocks("pos", C.parse_cigar("cigar"))
    r = one(df.select(b.alias("b"), *[C.ref_pos_at_read_pos(b, F.lit(o)).alias(f"o{o}") for o in (50, 51, 53, 0)]))
    assert [tuple(x) for x in r.b] == [(1, 100, 50), (53, 150, 48)]
    assert (r.o50, r.o51, r.o53, r.o0) == (149, 0, 150, 0)


def test_clip_cigar(spark):
    df = spark.createDataFrame([(-1, 10, 100), (95, 10, 100), (300, 10, 100)], "s int, n int, l int")
    got = [r.c for r in df.select(C.clip_cigar("s", "n", "l").alias("c")).collect()]
    assert got == ["2S8M", "6M4S", None]


def test_reg2bin(spark):
    df = spark.createDataFrame([(0, 1), (16383, 16385), (131071, 131073)], "b int, e int")
    assert [r.x for r in df.select(B.reg2bin("b", "e").alias("x")).collect()] == [4681, 585, 73]


def test_bin_loci_and_region_bins(spark):
    r = one(spark.range(1).select(B.bin_first_locus(F.lit(4681)).alias("f"), B.bin_last_locus(F.lit(4681)).alias("l"),
                                  B.bin_level(F.lit(73)).alias("lv")))
    assert (r.f, r.l, r.lv) == (1, 16384, 3)
    assert B.region_bin_ranges(1, 16384)[-1] == (4681, 4681)
    assert B.region_bin_ranges(10, 5) is None


def test_cycle(spark):
    r = one(spark.range(1).select(C.cycle(F.lit(False), F.lit(100), F.lit(0)).alias("p"),
                                  C.cycle(F.lit(True), F.lit(100), F.lit(0)).alias("m")))
    assert (r.p, r.m) == (1, 100)


def test_bases(spark):
    df = spark.createDataFrame([("ACGTNa",)], "s string")
    r = one(df.select(BQ.reverse_complement("s").alias("rc"), BQ.gc_content(F.lit("ACGTN")).alias("gc"),
                      BQ.phred_scores(F.lit("I!")).alias("ph"), BQ.normalize_bases(F.lit("ac.g")).alias("nb")))
    assert r.rc == "tNACGT" and abs(r.gc - 0.4) < 1e-12 and list(r.ph) == [40, 0] and r.nb == "ACNG"
    assert one(df.select(BQ.reverse_complement(BQ.reverse_complement("s")).alias("x"))).x == "ACGTNa"


def test_illumina_fix(spark):
    df = spark.createDataFrame([(chr(64 + 33) + chr(71 + 33),), (chr(30 + 33),)], "q string")
    got = [r.x for r in df.select(BQ.phred_scores(BQ.fix_illumina_quals("q")).alias("x")).collect()]
    assert list(got[0]) == [33, 40] and got[1] is None


def test_bisulfite(spark):
    df = spark.createDataFrame([(False, "T", "C"), (True, "A", "G"), (False, "A", "G")], "neg boolean, r string, f string")
    assert [x.e for x in df.select(BQ.bisulfite_bases_equal("neg", "r", "f").alias("e")).collect()] == [True, True, False]


def test_reference_from_md(spark):
    rows = [("ACGTACGT", "4M1D4M", "2A1^C4"), ("ACGTACGT", "4M1D4M", "2A1^CC4"), ("ACGTACGT", "2S3M2N2I1M", "1t2"), ("ACGT", "4M", "3"),
            ("ACGT", "4M", "2?2"), ("ACGT", "4M", None), (None, "4M", "4"), ("AC", "1M1D1M", "2"), ("ACGT", "4M", "2^A2")]
    df = spark.createDataFrame(rows, "s string, c string, m string")
    got = df.select(BQ.reference_from_md("s", "c", "m", True).alias("a"), BQ.reference_from_md("s", "c", "m", False).alias("b")).collect()
    assert [r.a for r in got] == ["ACATCACGT", None, "00GTANN--T", None, None, None, None, None, None]
    assert [r.b for r in got[:3]] == ["ACATACGT", None, "00GTA--T"]


def test_sq_bytes(spark):
    r = one(spark.range(1).select(BQ.sq_encode(F.lit(2), F.lit(10)).alias("b"),
                                  BQ.sq_complement(BQ.sq_encode(F.lit(2), F.lit(10))).alias("c")))
    assert (r.b, r.c) == (138, 74)


def test_tags_parse_and_format(spark):
    df = spark.createDataFrame([(["XX:B:S,1,65535", "NM:i:3", "RG:Z:g1"],), (["XX:B:c,200"],)], "f array<string>")
    rows = df.select(TG.tags_from_fields("f").alias("t")).collect()
    assert list(rows[0].t["XX"].ia) == [1, 65535] and rows[0].t["NM"].i == 3
    assert "XX" not in rows[1].t  # 200 is outside the signed byte range
    txt = one(df.limit(1).select(TG.format_tags(TG.tags_from_fields("f")).alias("x"))).x
    assert txt == "NM:i:3\tRG:Z:g1\tXX:B:S,1,65535"


def test_flags(spark):
    df = spark.createDataFrame([(4,), (65,)], "flag int")
    rows = df.select(FLG.is_first("flag").alias("f"), FLG.is_unmapped("flag").alias("u")).collect()
    assert (rows[0].f, rows[0].u) == (None, True) and (rows[1].f, rows[1].u) == (True, False)


def test_cigar_validation_vectors(spark):
    df = spark.createDataFrame([("5M3H5M",), ("2H3S5M",), ("3I2I5M",)], "c string")
    got = [r.n for r in df.select(F.size(VA.cigar_structure_errors(C.parse_cigar("c"))).alias("n")).collect()]
    assert got[0] > 0 and got[1] == 0 and got[2] > 0


def test_bed_line(spark):
    df = spark.createDataFrame([("chr1", 100, 349)], "ref_name string, start int, end int")
    r = one(df.select(BED.bed_line().alias("a"), BED.bed_line(half_open=True).alias("b")))
    assert r.a == "chr1\t99\t348" and r.b == "chr1\t99\t349"


def test_iso_dates(spark):
    df = spark.createDataFrame([("2011-03-04T05:06:07.891Z",), ("2011-03-04",), ("junk",)], "t string")
    got = [r.x for r in df.select(TG.format_utc(TG.parse_iso8601("t")).alias("x")).collect()]
    assert got == ["2011-03-04 05:06:07", "2011-03-04 00:00:00", None]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        again = [r.x for r in df.select(TG.format_utc(TG.parse_iso8601("t")).alias("x")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert again == got


def test_repeated_tag_keeps_first(spark):
    df = spark.createDataFrame([(["NM:i:1", "NM:i:2", "XX:i:notanint"],)], "f array<string>")
    t = one(df.select(TG.tags_from_fields("f").alias("t"))).t
    assert t["NM"].i == 1 and "XX" not in t
