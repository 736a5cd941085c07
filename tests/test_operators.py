"""Operators: golden vectors, properties against brute force on small inputs, plan shapes."""

import pandas as pd
from pyspark.sql import functions as F

from alnframe.operators import aggs as AG
from alnframe.operators import intervals as IV
from alnframe.operators import joins as JN
from alnframe.operators import sorts as SO
from alnframe.operators import windows as WN
from alnframe.sources import adapter as A
from alnframe.sources.generate import make_reads

from .conftest import SF_SMALL


def _islands_bruteforce(rows, slack):
    out = []
    for ref, s, e in sorted(rows):
        if out and out[-1][0] == ref and s <= out[-1][2] + slack:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([ref, s, e])
    return [tuple(x) for x in out]


def test_merge_read_intervals_golden(spark):
    df = spark.createDataFrame([(1, 100, 199), (1, 250, 349), (1, 401, 500)], "ref_index int, s int, e int")
    got = sorted(tuple(r) for r in IV.merge_intervals(df, ["ref_index"], "s", "e", slack=51).collect())
    assert got == [(1, 100, 349), (1, 401, 500)]


def test_two_level_merge_equals_single_pass(spark):
    reads = make_reads(spark, 4000, seed=3).filter("flag & 4 = 0")
    r = IV.with_alignment_end(reads).select("ref_index", "pos", "align_end")
    rows = [tuple(x) for x in r.collect()]
    # Small blocks force many level-one islands to be stitched by level two.
    got = sorted(tuple(x) for x in IV.merge_intervals(r, ["ref_index"], "pos", "align_end", slack=51,
                                                       block_shift=12).collect())
    assert got == _islands_bruteforce(rows, 51)
    gaps = pd.DataFrame(got, columns=["r", "s", "e"]).sort_values(["r", "s"])
    for _, g in gaps.groupby("r"):
        assert ((g.s.values[1:] - g.e.values[:-1]) > 51).all()


def test_padded_merge_golden(spark):
    df = spark.createDataFrame([("chr1", 100, 199), ("CHR1", 208, 300), ("chr1", 311, 400)],
                               "ref_name string, start int, end int")
    got = sorted((r.start, r.end) for r in IV.merge_intervals_padded(df, 10).collect())
    assert got == [(90, 300), (301, 400)]


def test_balance_golden(spark):
    counts = spark.createDataFrame([(1, 100), (2, 80), (3, 60), (4, 50)], "region int, n_reads long")
    got = {r.region: r.partition for r in AG.balance_regions(counts, 2).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_balance_loads_sum(spark):
    counts = AG.reads_per_region(make_reads(spark, 3000, seed=5).filter("flag & 4 = 0").withColumn("region", F.col("ref_index")))
    plan = AG.balance_regions(counts, 4).toPandas()
    assert plan.n_reads.sum() == 3000 - make_reads(spark, 3000, seed=5).filter("flag & 4 <> 0").count()
    assert set(plan.partition) <= {0, 1, 2, 3}


def test_coordinate_sort_puts_unplaced_last(spark):
    reads = make_reads(spark, 500, seed=7)
    rows = SO.sort_coordinate(reads, key="read_id").select("ref_index", "pos").collect()
    refs = [r.ref_index for r in rows]
    first_unplaced = refs.index(-1)
    assert all(x == -1 for x in refs[first_unplaced:])
    placed = [(r.ref_index, r.pos) for r in rows[:first_unplaced]]
    assert placed == sorted(placed)


def test_check_sorted_on_sorted_input_is_empty(spark):
    reads = make_reads(spark, 800, seed=9).filter("ref_index >= 0")
    srt = SO.sort_coordinate(reads, key="read_id").withColumn("ord", F.monotonically_increasing_id())
    ordered = spark.createDataFrame(srt.select("ord", "ref_index", "pos").collect())
    bad = WN.check_sorted(ordered, "ord", F.floor(F.col("ord") / 64), WN.coordinate_sort_key())
    assert bad.count() == 0
    shuffled = ordered.withColumn("ord", -F.col("ord"))
    assert WN.check_sorted(shuffled, "ord", F.floor(F.col("ord") / 64), WN.coordinate_sort_key()).count() > 0


def test_mark_duplicates_matches_bruteforce(spark):
    reads = make_reads(spark, 3000, seed=11).withColumn("pos", (1 + F.col("pos") % 50).cast("int"))
    got = {r.read_id: r.is_duplicate for r in WN.mark_duplicates(reads).select("read_id", "is_duplicate").collect()}
    pdf = reads.select("read_id", "read_name", "flag", "ref_index", "pos", "qual", "mate_ref_index", "mate_pos").toPandas()
    pdf["score"] = pdf.qual.map(lambda q: sum(ord(c) - 33 for c in q if ord(c) - 33 >= 15))
    pdf["rev"] = (pdf.flag & 16) != 0
    pdf["five"] = pdf.pos + pdf.rev * 35  # 36M reads: unclipped end = pos + 35
    elig = pdf[((pdf.flag & 4) == 0) & ((pdf.flag & 256) == 0)].sort_values(["score", "read_name", "read_id"],
                                                                          ascending=[False, True, True])
    best = set(elig.groupby(["ref_index", "five", "rev", "mate_ref_index", "mate_pos"]).head(1).read_id)
    expect = {rid: (rid in set(elig.read_id) and rid not in best) for rid in pdf.read_id}
    assert got == expect


def test_range_joins_avoid_cartesian(spark):
    reads = FLfilter = A.reads(spark, SF_SMALL).filter("flag & 4 = 0")
    targets = A.targets(spark, SF_SMALL)
    for df in (IV.reads_in_targets(reads, targets), IV.intersect_intervals(targets, targets)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_reads_in_targets_bruteforce(spark):
    reads = IV.with_alignment_end(make_reads(spark, 2000, seed=13).filter("flag & 4 = 0"))
    tg = spark.createDataFrame([(r, s, s + 20000) for r in range(25) for s in (1, 300000, 900000)],
                               "ref_index int, s int, e int")
    got = sorted(r.read_id for r in IV.reads_in_targets(reads, tg).collect())
    pr = reads.select("read_id", "ref_index", "pos", "align_end").toPandas()
    tv = tg.toPandas()
    exp = sorted(x.read_id for x in pr.itertuples()
                 if ((tv.ref_index == x.ref_index) & (tv.s <= x.align_end) & (tv.e >= x.pos)).any())
    assert got == exp


def test_with_mate_counts(spark):
    p = A.pairs(spark, SF_SMALL).withColumn("k", F.concat_ws("|", "read_name", F.col("flag").cast("string")))
    m = JN.with_mate(p, key="k").toPandas()
    assert (m.mate_count <= 1).all()
    assert ((m.mate_count == 1) == m.mate_flag.notna()).all()


def test_hot_duplicate_key(spark):
    """A third of the reads share one duplicate key: the result still matches brute force,
    and the best read per key comes from a partial aggregate, not a window over the key."""
    reads = make_reads(spark, 3000, seed=17).filter("flag & 4 = 0")
    hot = reads.withColumn("pos", F.when(F.col("record_no") % 3 == 0, F.lit(777)).otherwise(F.col("pos"))) \
               .withColumn("ref_index", F.when(F.col("record_no") % 3 == 0, F.lit(5)).otherwise(F.col("ref_index"))) \
               .withColumn("flag", F.when(F.col("record_no") % 3 == 0, F.col("flag").bitwiseAND(~16)).otherwise(F.col("flag"))) \
               .withColumn("mate_ref_index", F.when(F.col("record_no") % 3 == 0, F.lit(-1)).otherwise(F.col("mate_ref_index"))) \
               .withColumn("mate_pos", F.when(F.col("record_no") % 3 == 0, F.lit(0)).otherwise(F.col("mate_pos")))
    marked = WN.mark_duplicates(hot)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
    got = marked.filter("is_duplicate").count()
    pdf = hot.select("read_id", "flag", "ref_index", "pos", "mate_ref_index", "mate_pos").toPandas()
    pdf["five"] = pdf.pos + ((pdf.flag & 16) != 0) * 35
    pdf = pdf[(pdf.flag & 256) == 0]
    keys = pdf.groupby(["ref_index", "five", (pdf.flag & 16) != 0, "mate_ref_index", "mate_pos"]).size()
    assert got == int((keys - 1).sum())
    assert keys.max() >= 900


def test_hot_contig_merge_is_blocked(spark):
    """W1's first level windows over (contig, block): a hot contig is split by block."""
    reads = A.reads(spark, SF_SMALL).filter("flag & 4 = 0")
    plan = IV.merge_read_intervals(reads)._jdf.queryExecution().executedPlan().toString()
    assert "_blk" in plan and "Window" in plan


def test_index_stats_counts_no_coordinate_reads(spark):
    reads = make_reads(spark, 2000, seed=41)
    stats = {(r.seq_index, r.name): (r.aligned, r.unaligned) for r in AG.index_stats(reads, A.sequences(spark)).collect()}
    pdf = reads.select("ref_index", "pos", "flag").toPandas()
    assert stats[(None, "NoCoordinateCount")][1] == int((pdf.pos == 0).sum())
    placed = pdf[pdf.pos != 0]
    for (idx, name), (al, un) in stats.items():
        if idx is not None and al is not None:
            assert al == int(((placed.ref_index == idx) & ((placed.flag & 4) == 0)).sum())


def test_diff_dictionaries_md5_as_number(spark):
    a = spark.createDataFrame([(0, "chr1", 100, "00ABcd"), (1, "chr2", 50, "ff"), (2, "chr3", 0, None)],
                              "seq_index int, name string, length int, md5 string")
    b = spark.createDataFrame([(0, "chr1", 100, "abcd"), (1, "chr2", 50, "fe"), (2, "chrX", 70, None)],
                              "seq_index int, name string, length int, md5 string")
    got = {r.seq_index: r.difference for r in JN.diff_dictionaries(a, b).collect()}
    assert got == {1: "md5", 2: "name"}


def test_region_query_open_end(spark):
    from alnframe.operators import filters as FLT
    reads = IV.with_alignment_end(make_reads(spark, 1500, seed=43))
    whole = FLT.query_overlapping(reads, 3, 0, 0, use_bins=False).count()
    assert whole == reads.filter("ref_index = 3").count()
    tail = FLT.query_overlapping(reads, 3, 500000, 0, use_bins=False).select("read_id").collect()
    pdf = reads.filter("ref_index = 3").select("read_id", "pos", "align_end", "flag").toPandas()
    end = pdf.align_end.where((pdf.flag & 4) == 0, pdf.pos)
    assert sorted(r.read_id for r in tail) == sorted(pdf.read_id[end >= 500000])


def test_clip_to_contig(spark):
    from alnframe.functions import cigar as CG
    from alnframe.plans.pipeline import clip_to_contig
    df = spark.createDataFrame([("100M", 951), ("3H10S80M10S", 961), ("50M2I48M", 1000), ("40M3D60M", 990)],
                               "cigar string, pos int")
    got = [r.c for r in df.select(CG.format_cigar(clip_to_contig(CG.parse_cigar("cigar"), "pos", F.lit(1000))).alias("c"))
           .collect()]
    assert got == ["50M50S", "3H10S40M50S", "1M99S", "11M89S"]
