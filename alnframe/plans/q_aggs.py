"""Queries for aggregations (AG1-AG7), windows (W3-W7) and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar as C
from ..operators import aggs as AG
from ..operators import filters as FL
from ..operators import joins as JN
from ..operators import sorts as SO
from ..operators import windows as WN
from ..session import cut_lineage
from ..sources import adapter as A
from .catalog import register
from .oracle_views import READS, READS_X, SEQUENCES, with_views

NUM_PARTITIONS = 8  # partition groups of the pipeline (8 instances in the run configuration)

_CALLABLE = "flag & 4 = 0 AND ref_index BETWEEN 1 AND 24"

# --------------------------------------------------------------------------- AG1 / S5

_AG1_SQL = with_views(READS) + f"""
SELECT ref_index AS region, count(*) AS n_reads FROM reads WHERE {_CALLABLE} GROUP BY ref_index
"""


@register("reads_per_region", _AG1_SQL)
def reads_per_region(spark, sf_dir):
    return AG.reads_per_region(FL.callable_reads(A.reads(spark, sf_dir)))


_S5_SQL = with_views(READS) + f"""
SELECT ref_index AS region, count(*) AS n_reads FROM reads WHERE {_CALLABLE}
GROUP BY ref_index ORDER BY n_reads DESC, region LIMIT 5
"""


@register("top_regions", _S5_SQL)
def top_regions(spark, sf_dir):
    """S5 as a top-5 report (the limit is the feature)."""
    return AG.top_regions(AG.reads_per_region(FL.callable_reads(A.reads(spark, sf_dir))), 5)


# --------------------------------------------------------------------------- AG2

_AG2_SQL = with_views(READS) + f""",
cnt AS (SELECT ref_index AS region, count(*) AS n FROM reads WHERE {_CALLABLE} GROUP BY ref_index),
ranked AS (SELECT region, n, row_number() OVER (ORDER BY n DESC, region) AS rk FROM cnt),
st AS (
  SELECT * FROM (
    WITH RECURSIVE walk(i, loads, region, part, n) AS (
      SELECT 0, list_transform(range({NUM_PARTITIONS}), lambda j: CAST(0 AS BIGINT)), NULL::INTEGER, NULL::INTEGER, NULL::BIGINT
      UNION ALL
      SELECT w.i + 1,
        list_transform(range({NUM_PARTITIONS}), lambda j: CASE WHEN j = list_position(w.loads, list_min(w.loads)) - 1
                                              THEN w.loads[j + 1] + r.n ELSE w.loads[j + 1] END),
        CAST(r.region AS INTEGER), CAST(list_position(w.loads, list_min(w.loads)) - 1 AS INTEGER), r.n
      FROM walk w JOIN ranked r ON r.rk = w.i + 1)
    SELECT region, part, n FROM walk WHERE i > 0))
SELECT region, part AS partition, n AS n_reads FROM st
"""


@register("balance_regions", _AG2_SQL)
def balance_regions(spark, sf_dir):
    counts = AG.reads_per_region(FL.callable_reads(A.reads(spark, sf_dir)))
    return AG.balance_regions(counts, NUM_PARTITIONS)


# --------------------------------------------------------------------------- AG4

_AG4_SQL = with_views(READS, SEQUENCES) + """,
placed AS (SELECT ref_index, count_if(flag & 4 = 0) AS aligned, count_if(flag & 4 <> 0) AS unaligned
           FROM reads WHERE pos <> 0 GROUP BY ref_index)
SELECT s.seq_index, s.name, s.length, p.aligned, p.unaligned
FROM sequences s LEFT JOIN placed p ON s.seq_index = p.ref_index
UNION ALL
SELECT NULL, 'NoCoordinateCount', NULL, NULL, count_if(pos = 0) FROM reads
"""


@register("index_stats", _AG4_SQL)
def index_stats(spark, sf_dir):
    return AG.index_stats(A.reads(spark, sf_dir), A.sequences(spark))


# --------------------------------------------------------------------------- AG5

_AG5_SQL = with_views(READS, READS_X) + """,
b AS (SELECT ref_index, pos - 1 AS b0,
        CASE WHEN flag & 4 <> 0 OR pos + ref_len - 1 <= 0 THEN pos ELSE pos + ref_len - 1 END - 1 AS e0
      FROM reads_x WHERE pos <> 0)
SELECT ref_index,
  CAST(CASE WHEN b0 >> 14 = e0 >> 14 THEN 4681 + (b0 >> 14) WHEN b0 >> 17 = e0 >> 17 THEN 585 + (b0 >> 17)
       WHEN b0 >> 20 = e0 >> 20 THEN 73 + (b0 >> 20) WHEN b0 >> 23 = e0 >> 23 THEN 9 + (b0 >> 23)
       WHEN b0 >> 26 = e0 >> 26 THEN 1 + (b0 >> 26) ELSE 0 END AS INTEGER) AS bin,
  count(*) AS n_reads
FROM b GROUP BY ALL
"""


@register("bin_histogram", _AG5_SQL)
def bin_histogram(spark, sf_dir):
    return AG.bin_histogram(A.reads(spark, sf_dir))


# --------------------------------------------------------------------------- AG6 + W5

_LINEAR_SQL = with_views(READS, READS_X) + """,
w AS (SELECT ref_index, read_id,
        CASE WHEN flag & 4 <> 0 THEN (greatest(pos - 1, 1) - 1) >> 14 ELSE (greatest(pos, 1) - 1) >> 14 END AS w0,
        CASE WHEN flag & 4 <> 0 THEN (greatest(pos - 1, 1) - 1) >> 14 ELSE (greatest(pos + ref_len - 1, 1) - 1) >> 14 END AS w1
      FROM reads_x WHERE pos <> 0),
x AS (SELECT ref_index, read_id, unnest(generate_series(w0, greatest(w0, w1))) AS win FROM w),
firsts AS (SELECT ref_index, win, min(read_id) AS first_record FROM x GROUP BY ALL),
scaffold AS (SELECT ref_index, unnest(generate_series(0, max(win))) AS win FROM firsts GROUP BY ref_index),
joined AS (SELECT s.ref_index, s.win, f.first_record FROM scaffold s
           LEFT JOIN firsts f ON s.ref_index = f.ref_index AND s.win = f.win)
SELECT ref_index, CAST(win AS INTEGER) AS "window",
  last_value(first_record IGNORE NULLS) OVER (PARTITION BY ref_index ORDER BY win
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_record
FROM joined
"""


@register("linear_index", _LINEAR_SQL)
def linear_index(spark, sf_dir):
    firsts = AG.window_first_record(A.reads(spark, sf_dir), record_key="read_id")
    return AG.fill_window_index(firsts).select("ref_index", F.col("window").cast("int").alias("window"),
                                               "first_record")


# --------------------------------------------------------------------------- AG7

_AG7_SQL = with_views(READS) + """
SELECT CAST(sum(length) AS BIGINT) AS reference_length, count(*) AS n_sequences
FROM (SELECT ref_index, max(pos) + 100 AS length FROM reads GROUP BY ref_index)
"""


@register("reference_length", _AG7_SQL)
def reference_length(spark, sf_dir):
    """AG7 over the whole dictionary of contigs observed in the reads, each as long as its reads reach."""
    seqs = A.reads(spark, sf_dir).groupBy(F.col("ref_index").alias("seq_index")).agg((F.max("pos") + 100).alias("length"))
    return AG.reference_length(seqs)


# --------------------------------------------------------------------------- W3

def _dup_input(spark, sf_dir):
    # Positions folded to 1..5000 so that duplicate keys occur (FIXTURES note).
    return A.reads(spark, sf_dir).withColumn("pos", (1 + F.col("pos") % 5000).cast("int"))


_W3_SQL = with_views(READS, READS_X) + r""",
r AS (SELECT read_id, read_name, flag, ref_index, mate_ref_index, mate_pos, qual, cigar, ref_len,
        CAST(1 + pos % 5000 AS INTEGER) AS pos FROM (SELECT *, -1 AS mate_ref_index, 0 AS mate_pos FROM reads_x)),
k AS (SELECT *,
  CASE WHEN flag & 16 <> 0
    THEN pos + ref_len - 1 + CAST(coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '((\d+[SH])*)$', 1), '(\d+)', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER)
    ELSE pos - CAST(coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '^((\d+[SH])*)', 1), '(\d+)', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) END AS five,
  (flag & 16) <> 0 AS strand,
  list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END)) AS score,
  (flag & 4) = 0 AND (flag & 256) = 0 AS eligible
  FROM r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ref_index, five, strand, mate_ref_index, mate_pos
                                        ORDER BY score DESC, read_name, read_id) AS rn FROM k WHERE eligible)
SELECT k.read_id, CAST(CASE WHEN coalesce(ranked.rn, 1) > 1 THEN k.flag | 1024 ELSE k.flag END AS INTEGER) AS flag,
  coalesce(ranked.rn, 1) > 1 AS is_duplicate
FROM k LEFT JOIN ranked ON k.read_id = ranked.read_id
"""


@register("mark_duplicates", _W3_SQL)
def mark_duplicates(spark, sf_dir):
    return WN.mark_duplicates(_dup_input(spark, sf_dir)).select("read_id", "flag", "is_duplicate")


# --------------------------------------------------------------------------- W4

_W4_SQL = with_views(READS) + """,
k AS (SELECT read_id, ref_index, pos, CASE WHEN ref_index = -1 THEN 1 ELSE 0 END AS u FROM reads),
l AS (SELECT *, lag(u) OVER (ORDER BY read_id) AS pu, lag(ref_index) OVER (ORDER BY read_id) AS pr,
        lag(pos) OVER (ORDER BY read_id) AS pp FROM k)
SELECT read_id, ref_index, pos FROM l
WHERE pu IS NOT NULL AND (u < pu OR (u = pu AND (ref_index < pr OR (ref_index = pr AND pos < pp))))
"""


@register("check_sorted", _W4_SQL)
def check_sorted(spark, sf_dir):
    """W4 in read_id order (the adapter's record order) against coordinate order."""
    r = A.reads(spark, sf_dir).select("read_id", "ref_index", "pos")
    # the finer blocks grow with the order keys; of the coarser ones (prefixes of digits) there are a thousand or so at any size
    blocks = [F.substring("read_id", 1, 6), F.substring("read_id", 1, 3)]
    bad = WN.check_sorted(r, "read_id", blocks, WN.coordinate_sort_key())
    return bad.select("read_id", "ref_index", "pos")


# --------------------------------------------------------------------------- W7 (with AG2 + JN5)

_W7_SQL = _AG2_SQL.replace("SELECT region, part AS partition, n AS n_reads FROM st", """,
assign AS (SELECT region, part AS partition FROM st),
rq AS (SELECT r.read_id, r.ref_index, r.pos, r.qual, a.partition,
         list_max(list_transform(string_split(r.qual, ''), lambda c: ascii(c) - 33)) AS mx
       FROM reads r JOIN assign a ON r.ref_index = a.region WHERE r.flag & 4 = 0 AND r.ref_index BETWEEN 1 AND 24),
firsts AS (SELECT partition, arg_min(mx, (ref_index, pos, read_id)) AS first_max FROM rq GROUP BY partition)
SELECT rq.read_id, rq.partition, CASE WHEN f.first_max <= 60 THEN 'SANGER' ELSE 'ILLUMINA' END AS encoding,
  f.first_max > 60 AND regexp_matches(rq.qual, '[\\x00-\\x3f]') AS quality_error
FROM rq JOIN firsts f ON rq.partition = f.partition
""")


@register("region_quality_encoding", _W7_SQL)
def region_quality_encoding(spark, sf_dir):
    reads = FL.callable_reads(A.reads(spark, sf_dir))
    plan = JN.held(cut_lineage(AG.balance_regions(AG.reads_per_region(reads), NUM_PARTITIONS)))
    parted = JN.assign_partitions(reads, plan, repartition=False)
    return WN.region_quality_encoding(parted).select("read_id", "partition", "encoding", "quality_error")


# --------------------------------------------------------------------------- S1-S3

_SORT_SQL = with_views(READS) + """
SELECT read_id, ref_index, pos, flag, read_name FROM reads
"""


@register("sort_by_region", _SORT_SQL)
def sort_by_region(spark, sf_dir):
    return SO.sort_by_region(A.reads(spark, sf_dir).select("read_id", "ref_index", "pos", "flag", "read_name"))


@register("sort_coordinate", _SORT_SQL)
def sort_coordinate(spark, sf_dir):
    r = A.reads(spark, sf_dir)
    return SO.sort_coordinate(r).select("read_id", "ref_index", "pos", "flag", "read_name")


@register("sort_queryname", _SORT_SQL)
def sort_queryname(spark, sf_dir):
    r = A.reads(spark, sf_dir)
    return SO.sort_queryname(r).select("read_id", "ref_index", "pos", "flag", "read_name")
