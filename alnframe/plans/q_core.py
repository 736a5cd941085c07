"""Headline queries: read intervals (W1), callable reads (F1), region balance (AG1/AG2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as FL
from ..operators import intervals as IV
from ..sources import adapter as A
from .catalog import register
from .oracle_views import READS, READS_X, with_views

_W1_SQL = with_views(READS, READS_X) + r""",
r AS (SELECT ref_index, ref_name, pos, pos + ref_len - 1 AS e FROM reads_x
      WHERE flag & 4 = 0 AND ref_index BETWEEN 1 AND 24),
w AS (SELECT *, max(e) OVER (PARTITION BY ref_index ORDER BY pos, e
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM r),
g AS (SELECT *, sum(CASE WHEN m IS NULL OR pos > m + 51 THEN 1 ELSE 0 END) OVER (PARTITION BY ref_index
        ORDER BY pos, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM w)
SELECT ref_index, ref_name, CAST(min(pos) AS INTEGER) AS start, CAST(max(e) AS INTEGER) AS "end"
FROM g GROUP BY ref_index, ref_name, island
"""


@register("merge_read_intervals", _W1_SQL)
def merge_read_intervals(spark, sf_dir):
    """Minimum slice: adapter reads -> F1 -> CIGAR end -> W1 regions."""
    return IV.merge_read_intervals(FL.callable_reads(A.reads(spark, sf_dir)))


# --------------------------------------------------------------------------- W2

_W2_SQL = _W1_SQL.replace('''SELECT ref_index, ref_name, CAST(min(pos) AS INTEGER) AS start, CAST(max(e) AS INTEGER) AS "end"
FROM g GROUP BY ref_index, ref_name, island''', ''',
iv AS (SELECT ref_index, ref_name, CAST(min(pos) AS INTEGER) AS start, CAST(max(e) AS INTEGER) AS "end"
        FROM g GROUP BY ref_index, ref_name, island),
w2 AS (SELECT *, max("end") OVER (PARTITION BY lower(ref_name) ORDER BY start, "end"
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m2 FROM iv),
g2 AS (SELECT *, sum(CASE WHEN m2 IS NULL OR start - 10 >= m2 THEN 1 ELSE 0 END) OVER (PARTITION BY lower(ref_name)
         ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island2 FROM w2)
SELECT min(ref_name) AS ref_name, CAST(greatest(min(start) - 10, 1) AS INTEGER) AS start, CAST(max("end") AS INTEGER) AS "end"
FROM g2 GROUP BY lower(ref_name), island2''')


@register("merge_regions_padded", _W2_SQL)
def merge_regions_padded(spark, sf_dir):
    """The W1 regions padded by 10 and merged when start - 10 < open end."""
    iv = IV.merge_read_intervals(FL.callable_reads(A.reads(spark, sf_dir)))
    return IV.merge_intervals_padded(iv, 10)


# --------------------------------------------------------------------------- F2, F6

_F2_SQL = with_views(READS) + """
SELECT read_id, flag FROM reads WHERE flag & 256 = 0
"""


@register("primary_reads", _F2_SQL)
def primary_reads(spark, sf_dir):
    return FL.primary_only(A.reads(spark, sf_dir)).select("read_id", "flag")


_F6_SQL = with_views(READS) + """
SELECT read_id, read_name FROM reads WHERE mapq = 13
"""


@register("unmapped_reads", _F6_SQL)
def unmapped_reads(spark, sf_dir):
    """F6 after JN1: reads whose contig name is not in the dictionary (index -1)."""
    from ..operators import joins as JN
    r = A.reads(spark, sf_dir).withColumn(
        "ref_name", F.when(F.col("mapq") == 13, F.lit("chrUn")).otherwise(F.col("ref_name")))
    return FL.query_unmapped(JN.with_ref_index(r, A.sequences(spark))).select("read_id", "read_name")
