"""Queries for reference-aware operators and the re-aimed pipeline stages:
JN8-JN10, AG12, AG13, AG10, PL3, AG11, PL1, PL2, AG9, IO9/IO10, PL4."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import filters as FL
from ..operators import recal as RC
from ..operators import reference as RF
from ..operators import windows as WN
from ..session import shared_dir
from ..sources import adapter as A
from ..sources import vcf as VCF
from . import pipeline as PL
from .catalog import register
from .oracle_views import CONTIG, KNOWN_SITES, READS, READS_X, REF_BASE, SEQUENCES, TARGETS, with_views

# Per-base explosion of the aligned blocks in DuckDB (independent of the Spark walk).
_BASES_CTE = r""",
el AS (
  SELECT read_id, pos, flag, seq, qual, mapq, unnest(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')) AS e,
         unnest(generate_series(1, len(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')))) AS i
  FROM src WHERE flag & 4 = 0),
el2 AS (SELECT read_id, pos, flag, seq, qual, mapq, i, CAST(regexp_extract(e, '(\d+)', 1) AS INTEGER) AS n, right(e, 1) AS op FROM el),
cum AS (SELECT *,
    coalesce(sum(CASE WHEN op IN ('M','I','S','=','X') THEN n ELSE 0 END) OVER (PARTITION BY read_id ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS read_before,
    coalesce(sum(CASE WHEN op IN ('M','D','N','=','X') THEN n ELSE 0 END) OVER (PARTITION BY read_id ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ref_before
  FROM el2),
blk AS (SELECT read_id, flag, seq, qual, mapq, 1 + read_before AS rs, pos + ref_before AS fs, n FROM cum WHERE op IN ('M','=','X')),
b AS (SELECT read_id, flag, seq, qual, mapq, fs + k AS p, rs + k - 1 AS ri0,
        substr(seq, CAST(rs + k AS INTEGER), 1) AS base,
        ascii(substr(qual, CAST(rs + k AS INTEGER), 1)) - 33 AS q
      FROM (SELECT *, unnest(generate_series(0, n - 1)) AS k FROM blk))"""


def _src(filter_sql: str = "", pos_expr: str = "pos") -> str:
    return (f",\nsrc AS (SELECT read_id, read_name, flag, CAST({pos_expr} AS INTEGER) AS pos, cigar, seq, qual, mapq, ref_index "
            f"FROM reads {filter_sql})")


def _reference(spark):
    return A.reference_chunks(spark, chunk=RF.SWEEP_CHUNK)


# --------------------------------------------------------------------------- JN8-JN10

def _mismatch_sql(bisulfite: bool) -> str:
    rb = REF_BASE.format(r="s.ref_index", p="b.p")
    if bisulfite:
        diff = (f"NOT (upper(b.base) = upper({rb}) OR ((b.flag & 16) <> 0 AND upper({rb}) = 'G' AND upper(b.base) = 'A')"
                f" OR ((b.flag & 16) = 0 AND upper({rb}) = 'C' AND upper(b.base) = 'T'))")
    else:
        diff = f"upper(b.base) <> upper({rb})"
    return with_views(READS, READS_X) + _src() + _BASES_CTE + f""",
x AS (SELECT b.read_id, CASE WHEN {diff} THEN 1 ELSE 0 END AS mm, CASE WHEN {diff} THEN b.q ELSE 0 END AS mq
      FROM b JOIN src s ON b.read_id = s.read_id WHERE b.p <= 1000000),
indel AS (SELECT read_id, CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[ID]', 1), lambda v: CAST(v AS INTEGER))), 0) AS INTEGER) AS nid FROM src WHERE flag & 4 = 0)
SELECT indel.read_id, CAST(coalesce(sum(mm), 0) AS INTEGER) AS mismatches, CAST(coalesce(sum(mq), 0) AS INTEGER) AS mismatch_qual_sum,
  CAST(coalesce(sum(mm), 0) + min(indel.nid) AS INTEGER) AS nm
FROM indel LEFT JOIN x ON x.read_id = indel.read_id GROUP BY indel.read_id
"""


@register("mismatch_stats", _mismatch_sql(False))
def mismatch_stats(spark, sf_dir):
    return RF.mismatch_stats(A.reads(spark, sf_dir), _reference(spark), chunk=RF.SWEEP_CHUNK)


@register("bisulfite_mismatch_stats", _mismatch_sql(True))
def bisulfite_mismatch_stats(spark, sf_dir):
    return RF.mismatch_stats(A.reads(spark, sf_dir), _reference(spark), bisulfite=True, chunk=RF.SWEEP_CHUNK)


# --------------------------------------------------------------------------- AG12 / AG13

_FOLD = "1 + pos % 2000"   # positions folded so that sites are deep (all reads kept)


def _folded_reads(spark, sf_dir):
    return A.reads(spark, sf_dir).withColumn("pos", (1 + F.col("pos") % 2000).cast("int"))


_PILE_CTE = with_views(READS, READS_X) + _src("WHERE flag & 256 = 0 AND flag & 1024 = 0", _FOLD) + _BASES_CTE + """,
pile AS (SELECT s.ref_index, CAST(b.p AS INTEGER) AS pos, upper(b.base) AS base, count(*) AS depth, sum(b.q) AS qual_sum
         FROM b JOIN src s ON b.read_id = s.read_id GROUP BY ALL)"""

_PILE_SQL = _PILE_CTE + """
SELECT ref_index, pos, base, depth, CAST(qual_sum AS BIGINT) AS qual_sum FROM pile
"""


@register("pileup", _PILE_SQL)
def pileup(spark, sf_dir):
    p = RF.pileup(_folded_reads(spark, sf_dir))
    return p.select("ref_index", F.col("pos").cast("int").alias("pos"), "base", "depth",
                    F.col("qual_sum").cast("bigint").alias("qual_sum"))


_CALLS_CTE = _PILE_CTE + f""",
site AS (SELECT ref_index, pos, sum(depth) AS dp, {REF_BASE.format(r="ref_index", p="pos")} AS ref_base FROM pile GROUP BY ref_index, pos),
alts AS (SELECT p.ref_index, p.pos, p.base, p.depth, p.qual_sum,
           row_number() OVER (PARTITION BY p.ref_index, p.pos ORDER BY p.qual_sum DESC, p.base) AS rk
         FROM pile p JOIN site s ON p.ref_index = s.ref_index AND p.pos = s.pos
         WHERE p.base <> upper(s.ref_base) AND p.base IN ('A','C','G','T')),
refd AS (SELECT p.ref_index, p.pos, sum(p.depth) AS rd FROM pile p JOIN site s ON p.ref_index = s.ref_index AND p.pos = s.pos
         WHERE p.base = upper(s.ref_base) GROUP BY ALL),
calls AS (SELECT s.ref_index, s.pos, upper(s.ref_base) AS ref, a.base AS alt, CAST(a.qual_sum AS DOUBLE) AS qual,
            a.depth * 1.0 / s.dp AS af, s.dp, coalesce(r.rd, 0) AS rd, a.depth AS ad
          FROM site s JOIN alts a ON s.ref_index = a.ref_index AND s.pos = a.pos AND a.rk = 1
          LEFT JOIN refd r ON s.ref_index = r.ref_index AND s.pos = r.pos
          WHERE a.qual_sum >= 30 AND a.depth * 1.0 / s.dp >= 0.2)"""

_CALLS_SQL = _CALLS_CTE + """
SELECT ref_index, CAST(pos AS INTEGER) AS pos, ref, alt, qual, round(af, 6) AS af, CAST(dp AS BIGINT) AS dp,
  CASE WHEN af >= 0.8 THEN '1/1' ELSE '0/1' END || ':' || CAST(rd AS VARCHAR) || ',' || CAST(ad AS VARCHAR) || ':' || CAST(dp AS VARCHAR) AS sample
FROM calls
"""


def _calls(spark, sf_dir):
    return RF.call_snvs(RF.site_pileup(_folded_reads(spark, sf_dir)), A.reference_chunks(spark), A.sequences(spark))


@register("call_snvs", _CALLS_SQL)
def call_snvs(spark, sf_dir):
    c = _calls(spark, sf_dir)
    return c.select("ref_index", F.col("pos").cast("int").alias("pos"), "ref", "alt", "qual",
                    F.round("af", 6).alias("af"), F.col("dp").cast("bigint").alias("dp"), "sample")


_VCF_SQL = _CALLS_CTE + """
SELECT CASE WHEN ref_index = 23 THEN 23 WHEN ref_index = 24 THEN 24 WHEN ref_index BETWEEN 1 AND 22 THEN ref_index END AS chrom_no,
  """ + "CASE WHEN ref_index=0 THEN 'chrM' WHEN ref_index BETWEEN 1 AND 22 THEN 'chr'||CAST(ref_index AS VARCHAR) WHEN ref_index=23 THEN 'chrX' WHEN ref_index=24 THEN 'chrY' END" + """ AS chrom,
  CAST(pos AS INTEGER) AS pos, ref, alt, qual
FROM calls
"""


@register("vcf_roundtrip", _VCF_SQL)
def vcf_roundtrip(spark, sf_dir):
    """AG13 calls written as an ordered VCF (IO10, S4) and read back (IO9, F7)."""
    path = shared_dir(spark, "vcf")
    VCF.write_vcf(_calls(spark, sf_dir), path)
    back = VCF.read_vcf_body(spark, path)
    return back.select("chrom_no", "chrom", "pos", "ref", "alt", "qual")


# --------------------------------------------------------------------------- AG10 / PL3

_RECAL_CTE = with_views(READS, READS_X, KNOWN_SITES) + _src() + _BASES_CTE + f""",
obs AS (SELECT 'rg' || CAST(s.ref_index % 2 AS VARCHAR) AS read_group, b.q AS qual,
          CAST(CASE WHEN b.flag & 16 <> 0 THEN length(b.seq) - b.ri0 ELSE b.ri0 + 1 END AS INTEGER) AS cycle,
          CASE WHEN b.ri0 > 0 THEN upper(substr(b.seq, CAST(b.ri0 AS INTEGER), 1)) || upper(b.base) END AS dinuc,
          CASE WHEN upper(b.base) <> upper({REF_BASE.format(r="s.ref_index", p="b.p")}) THEN 1 ELSE 0 END AS mm
        FROM b JOIN src s ON b.read_id = s.read_id
        WHERE b.flag & 256 = 0 AND b.flag & 1024 = 0 AND b.p <= 1000000
          AND NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.ref_index = s.ref_index AND k.pos = b.p)),
tab AS (SELECT read_group, CAST(qual AS INTEGER) AS qual, cycle, dinuc, count(*) AS observations, CAST(sum(mm) AS BIGINT) AS mismatches,
          -10 * log10((sum(mm) + 1) / (count(*) + 2)) AS empirical_q FROM obs GROUP BY ALL)"""

_RECAL_SQL = _RECAL_CTE + """
SELECT read_group, qual, cycle, dinuc, observations, mismatches, round(empirical_q, 6) AS empirical_q FROM tab
"""


def _rg_reads(spark, sf_dir):
    return A.reads(spark, sf_dir).withColumn(
        "read_group", F.concat(F.lit("rg"), (F.col("ref_index") % 2).cast("string")))


@register("recal_table", _RECAL_SQL)
def recal_table(spark, sf_dir):
    t = RC.recal_table(_rg_reads(spark, sf_dir), _reference(spark), A.known_sites(spark, sf_dir), chunk=RF.SWEEP_CHUNK)
    return t.select("read_group", F.col("qual").cast("int").alias("qual"), F.col("cycle").cast("int").alias("cycle"),
                    "dinuc", "observations", F.col("mismatches").cast("bigint").alias("mismatches"),
                    F.round("empirical_q", 6).alias("empirical_q"))


_APPLY_SQL = _RECAL_CTE + """,
allb AS (SELECT r.read_id, 'rg' || CAST(r.ref_index % 2 AS VARCHAR) AS read_group, k AS ri0,
           ascii(substr(r.qual, CAST(k + 1 AS INTEGER), 1)) - 33 AS q,
           CAST(CASE WHEN r.flag & 16 <> 0 THEN length(r.seq) - k ELSE k + 1 END AS INTEGER) AS cycle,
           CASE WHEN k > 0 THEN upper(substr(r.seq, CAST(k AS INTEGER), 1)) || upper(substr(r.seq, CAST(k + 1 AS INTEGER), 1)) END AS dinuc
         FROM (SELECT *, unnest(generate_series(0, length(qual) - 1)) AS k FROM reads) r),
newq AS (SELECT a.read_id, a.ri0,
           CASE WHEN t.empirical_q IS NULL THEN a.q ELSE least(greatest(CAST(round(t.empirical_q) AS INTEGER), 1), 93) END AS nq
         FROM allb a LEFT JOIN tab t ON a.read_group = t.read_group AND a.q = t.qual AND a.cycle = t.cycle
           AND a.dinuc IS NOT DISTINCT FROM t.dinuc)
SELECT read_id, string_agg(chr(CAST(nq + 33 AS INTEGER)), '' ORDER BY ri0) AS qual FROM newq GROUP BY read_id
"""


@register("apply_recalibration", _APPLY_SQL)
def apply_recalibration(spark, sf_dir):
    reads = _rg_reads(spark, sf_dir)
    t = RC.recal_table(reads, _reference(spark), A.known_sites(spark, sf_dir), chunk=RF.SWEEP_CHUNK)
    return RC.apply_recalibration(reads, t).select("read_id", "qual")


# --------------------------------------------------------------------------- AG11

_INDEL_SQL = with_views(READS) + r""",
el AS (SELECT read_id, ref_index, pos, unnest(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')) AS e,
         unnest(generate_series(1, len(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')))) AS i FROM reads WHERE flag & 4 = 0),
el2 AS (SELECT *, CAST(regexp_extract(e, '(\d+)', 1) AS INTEGER) AS n, right(e, 1) AS op FROM el),
cum AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M','D','N','=','X') THEN n ELSE 0 END) OVER (PARTITION BY read_id ORDER BY i
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM el2),
iv AS (SELECT ref_index, pos + off AS s, pos + off + n AS e FROM cum WHERE op IN ('I','D')),
w AS (SELECT *, max(e) OVER (PARTITION BY ref_index ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM iv),
g AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY ref_index ORDER BY s, e
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM w)
SELECT ref_index, CAST(min(s) AS INTEGER) AS start, CAST(max(e) AS INTEGER) AS "end", count(*) AS support FROM g GROUP BY ref_index, island
"""


@register("indel_targets", _INDEL_SQL)
def indel_targets(spark, sf_dir):
    t = PL.indel_targets(A.reads(spark, sf_dir))
    return t.select("ref_index", "start", "end", F.col("support").cast("bigint").alias("support"))


# --------------------------------------------------------------------------- PL1

_CLEAN_SQL = with_views(READS) + r""",
el AS (SELECT read_id, flag, pos, mapq, cigar, unnest(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')) AS e,
         unnest(generate_series(1, len(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')))) AS i FROM reads),
el2 AS (SELECT *, CAST(regexp_extract(e, '(\d+)', 1) AS INTEGER) AS n, right(e, 1) AS op FROM el),
c1 AS (SELECT *, pos + coalesce(sum(CASE WHEN op IN ('M','D','N','=','X') THEN n ELSE 0 END) OVER (PARTITION BY read_id ORDER BY i
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rp FROM el2),
c2 AS (SELECT *, greatest(1000000 - rp + 1, 0) AS avail FROM c1),
c3 AS (SELECT *, CASE WHEN op IN ('M','=','X') THEN least(n, avail) END AS keep,
         -- clipping started before this element: an earlier aligned element was cut, or we are past the end
         coalesce(max(CASE WHEN op IN ('M','=','X') AND least(n, avail) < n THEN 1 ELSE 0 END) OVER (PARTITION BY read_id ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 OR rp > 1000000 AS clipping,
         coalesce(count_if(op NOT IN ('S','H')) OVER (PARTITION BY read_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before
       FROM c2),
c4 AS (SELECT *,
  CASE WHEN op IN ('M','=','X') AND keep > 0 THEN CAST(keep AS VARCHAR) || op
       WHEN op IN ('D','N') AND NOT clipping AND rp + n - 1 <= 1000000 THEN CAST(n AS VARCHAR) || op
       WHEN op IN ('I','P') AND NOT clipping THEN CAST(n AS VARCHAR) || op
       WHEN op IN ('S','H') AND n_before = 0 THEN CAST(n AS VARCHAR) || op END AS piece,
  CASE WHEN op IN ('M','=','X') THEN n - keep WHEN op = 'I' AND clipping THEN n WHEN op = 'S' AND n_before > 0 THEN n ELSE 0 END AS clip,
  CASE WHEN op = 'H' AND n_before > 0 THEN n ELSE 0 END AS hard
  FROM c3),
agg AS (SELECT read_id, min(flag) AS flag, min(pos) AS pos, min(mapq) AS mapq, min(cigar) AS cigar,
          string_agg(piece, '' ORDER BY i) AS body, sum(clip) AS clip, sum(hard) AS hard,
          max(rp + CASE WHEN op IN ('M','D','N','=','X') THEN n ELSE 0 END) - 1 AS end_pos
        FROM c4 GROUP BY read_id)
SELECT read_id,
  CASE WHEN flag & 4 = 0 AND end_pos > 1000000
       THEN coalesce(body, '') || CASE WHEN clip > 0 THEN CAST(clip AS VARCHAR) || 'S' ELSE '' END
            || CASE WHEN hard > 0 THEN CAST(hard AS VARCHAR) || 'H' ELSE '' END
       ELSE cigar END AS cigar,
  CAST(CASE WHEN flag & 4 <> 0 THEN 0 ELSE mapq END AS INTEGER) AS mapq
FROM agg
"""


@register("clean_reads", _CLEAN_SQL)
def clean_reads(spark, sf_dir):
    return PL.clean_reads(A.reads(spark, sf_dir), A.sequences(spark)).select("read_id", "cigar", "mapq")


# --------------------------------------------------------------------------- PL2, W3 + AG9

_PL2_SQL = with_views(READS) + """
SELECT read_id, 'GROUP1' AS rg, 'LIB1' AS library FROM reads
"""


@register("set_read_group", _PL2_SQL)
def set_read_group(spark, sf_dir):
    out, _ = PL.set_read_group(A.reads(spark, sf_dir))
    return out.select("read_id", F.col("tags").getItem("RG").s.alias("rg"), "library")


_AG9_SQL = with_views(READS, READS_X) + r""",
r AS (SELECT read_id, read_name, flag, ref_index, qual, cigar, ref_len, CAST(1 + pos % 5000 AS INTEGER) AS pos FROM reads_x),
k AS (SELECT *,
  CASE WHEN flag & 16 <> 0
    THEN pos + ref_len - 1 + CAST(coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '((\d+[SH])*)$', 1), '(\d+)', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER)
    ELSE pos - CAST(coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '^((\d+[SH])*)', 1), '(\d+)', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) END AS five,
  list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END)) AS score,
  (flag & 4) = 0 AND (flag & 256) = 0 AS eligible FROM r),
ranked AS (SELECT read_id, row_number() OVER (PARTITION BY ref_index, five, (flag & 16) <> 0 ORDER BY score DESC, read_name, read_id) AS rn
           FROM k WHERE eligible),
m AS (SELECT k.flag, coalesce(ranked.rn, 1) > 1 AS dup FROM k LEFT JOIN ranked ON k.read_id = ranked.read_id)
SELECT 'LIB1' AS library, count_if(flag & 4 = 0 AND flag & 256 = 0) AS examined, count_if(flag & 4 <> 0) AS unmapped,
  count_if(dup) AS duplicates, round(count_if(dup) * 1.0 / count_if(flag & 4 = 0 AND flag & 256 = 0), 6) AS duplicate_fraction
FROM m
"""


@register("duplicate_metrics", _AG9_SQL)
def duplicate_metrics(spark, sf_dir):
    reads = A.reads(spark, sf_dir).withColumn("pos", (1 + F.col("pos") % 5000).cast("int"))
    with_rg, _ = PL.set_read_group(reads)
    m = PL.duplicate_metrics(WN.mark_duplicates(with_rg))
    return m.select("library", "examined", "unmapped", "duplicates",
                    F.round("duplicate_fraction", 6).alias("duplicate_fraction"))


# --------------------------------------------------------------------------- PL4

_PL4_SQL = with_views(READS, TARGETS, KNOWN_SITES) + rf""",
c0 AS (SELECT read_id, read_name, flag, ref_index, CAST({_FOLD} AS INTEGER) AS pos, cigar, seq, qual, mapq,
         CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MDN=X]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS ref_len
       FROM reads WHERE flag & 4 = 0 AND ref_index BETWEEN 1 AND 24),
w0 AS (SELECT ref_index, pos AS s, pos + ref_len - 1 AS e,
         max(pos + ref_len - 1) OVER (PARTITION BY ref_index ORDER BY pos, ref_len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM c0),
w1 AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m + {S.READ_INTERVAL_SLACK} THEN 1 ELSE 0 END)
         OVER (PARTITION BY ref_index ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM w0),
region_ AS (SELECT ref_index, min(s) AS s, max(e) AS e FROM w1 GROUP BY ref_index, island),
bed AS (SELECT DISTINCT t.ref_index, greatest(t.s, r.s) AS s, least(t.e, r.e) AS e
        FROM targets t JOIN region_ r ON t.ref_index = r.ref_index AND t.s <= r.e AND t.e >= r.s),
c1 AS (SELECT * FROM c0 WHERE EXISTS (SELECT 1 FROM bed WHERE bed.ref_index = c0.ref_index AND bed.s <= c0.pos + c0.ref_len - 1 AND bed.e >= c0.pos)),
k AS (SELECT *,
  CASE WHEN flag & 16 <> 0
    THEN pos + ref_len - 1 + CAST(coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '((\d+[SH])*)$', 1), '(\d+)', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER)
    ELSE pos - CAST(coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '^((\d+[SH])*)', 1), '(\d+)', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) END AS five,
  list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END)) AS score
  FROM c1 WHERE flag & 256 = 0),
src AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ref_index, five, (flag & 16) <> 0 ORDER BY score DESC, read_name, read_id) AS rn
        FROM k) WHERE rn = 1)""" + _BASES_CTE + rf""",
obs AS (SELECT b.q AS qual, CAST(CASE WHEN b.flag & 16 <> 0 THEN length(b.seq) - b.ri0 ELSE b.ri0 + 1 END AS INTEGER) AS cycle,
          CASE WHEN b.ri0 > 0 THEN upper(substr(b.seq, CAST(b.ri0 AS INTEGER), 1)) || upper(b.base) END AS dinuc,
          CASE WHEN upper(b.base) <> upper({REF_BASE.format(r="s.ref_index", p="b.p")}) THEN 1 ELSE 0 END AS mm
        FROM b JOIN src s ON b.read_id = s.read_id
        WHERE NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.ref_index = s.ref_index AND k.pos = b.p)),
tab AS (SELECT qual, cycle, dinuc, -10 * log10((sum(mm) + 1) / (count(*) + 2)) AS empirical_q FROM obs GROUP BY ALL),
nb AS (SELECT s.ref_index, CAST(b.p AS INTEGER) AS pos, upper(b.base) AS base,
         CASE WHEN t.empirical_q IS NULL THEN b.q ELSE least(greatest(CAST(round(t.empirical_q) AS INTEGER), 1), 93) END AS q
       FROM b JOIN src s ON b.read_id = s.read_id
       LEFT JOIN tab t ON t.qual = b.q AND t.cycle = CASE WHEN b.flag & 16 <> 0 THEN length(b.seq) - b.ri0 ELSE b.ri0 + 1 END
         AND t.dinuc IS NOT DISTINCT FROM CASE WHEN b.ri0 > 0 THEN upper(substr(b.seq, CAST(b.ri0 AS INTEGER), 1)) || upper(b.base) END),
pile AS (SELECT ref_index, pos, base, count(*) AS depth, sum(q) AS qual_sum FROM nb GROUP BY ALL),
""" + _CALLS_CTE[_CALLS_CTE.index("site AS ("):] + """
SELECT ref_index AS chrom_no, """ + CONTIG.format(r="ref_index") + """ AS chrom, CAST(pos AS INTEGER) AS pos, ref, alt, qual,
  CASE WHEN af >= 0.8 THEN '1/1' ELSE '0/1' END || ':' || CAST(rd AS VARCHAR) || ',' || CAST(ad AS VARCHAR) || ':' || CAST(dp AS VARCHAR) AS sample
FROM calls
"""


@register("call_variants", _PL4_SQL)
def call_variants(spark, sf_dir):
    """PL4 end to end over the adapter reads (positions folded into 1..2000 as for the
    pileup, so that sites have depth; every read is processed), targets, reference and
    known sites."""
    out = PL.call_variants(_folded_reads(spark, sf_dir), A.sequences(spark), A.targets(spark, sf_dir),
                           _reference(spark), A.known_sites(spark, sf_dir), chunk=RF.SWEEP_CHUNK)
    return out["calls"].select("chrom_no", "chrom", F.col("pos").cast("int").alias("pos"), "ref", "alt", "qual", "sample")
