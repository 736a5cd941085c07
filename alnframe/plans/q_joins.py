"""Queries for joins: JN1-JN7, JN11, JN12."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import tags as TG
from ..operators import aggs as AG
from ..operators import filters as FL
from ..operators import intervals as IV
from ..operators import joins as JN
from ..sources import adapter as A
from .catalog import register
from .oracle_views import KNOWN_SITES, PAIRS, READS, READS_X, SEQUENCES, TARGETS, with_views
from .q_io import _W1_CORE

# --------------------------------------------------------------------------- JN1

_JN1_SQL = with_views(READS, READS_X, SEQUENCES) + """,
r AS (SELECT read_id, CASE WHEN mapq = 13 THEN 'chrUn' ELSE ref_name END AS rname,
        CASE WHEN mapq % 3 = 0 THEN '=' WHEN mapq % 3 = 1 THEN 'chr' || CAST(mapq AS VARCHAR) ELSE '*' END AS mname
      FROM reads_x)
SELECT r.read_id, CAST(coalesce(a.seq_index, -1) AS INTEGER) AS ref_index, CAST(coalesce(b.seq_index, -1) AS INTEGER) AS mate_ref_index
FROM r LEFT JOIN sequences a ON r.rname = a.name
LEFT JOIN sequences b ON (CASE WHEN r.mname = '=' THEN r.rname ELSE r.mname END) = b.name
"""


@register("with_ref_index", _JN1_SQL)
def with_ref_index(spark, sf_dir):
    r = A.reads(spark, sf_dir)
    r = r.withColumns({
        "ref_name": F.when(F.col("mapq") == 13, F.lit("chrUn")).otherwise(F.col("ref_name")),
        "mate_ref_name": F.when(F.col("mapq") % 3 == 0, F.lit("="))
        .when(F.col("mapq") % 3 == 1, F.concat(F.lit("chr"), F.col("mapq").cast("string"))).otherwise(F.lit("*")),
    })
    return JN.with_ref_index(r, A.sequences(spark)).select("read_id", "ref_index", "mate_ref_index")


# --------------------------------------------------------------------------- JN2

def read_groups_from_nations(spark, sf_dir):
    """A read group per nation; the reads also name groups that no nation has."""
    n = A.table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("rg"), F.col("n_nationkey").cast("string")).alias("id"),
                    F.col("n_name").alias("sample"), F.concat(F.lit("lib"), F.col("n_regionkey").cast("string")).alias("library"),
                    F.lit("ILLUMINA").alias("platform"))


_JN2_SQL = with_views(READS) + """,
rg AS (SELECT 'rg' || CAST(n_nationkey AS VARCHAR) AS id, n_name AS sample, 'lib' || CAST(n_regionkey AS VARCHAR) AS library
       FROM nation)
SELECT r.read_id, rg.id AS rg_id, rg.sample AS rg_sample, rg.library AS rg_library
FROM reads r LEFT JOIN rg ON 'rg' || CAST(r.mapq % 30 AS VARCHAR) = rg.id
"""


@register("with_read_group", _JN2_SQL)
def with_read_group(spark, sf_dir):
    r = A.reads(spark, sf_dir)
    r = r.withColumn("tags", TG.set_tag("tags", "RG", TG.string_tag(F.concat(F.lit("rg"), (F.col("mapq") % 30).cast("string")))))
    j = JN.with_read_group(r, read_groups_from_nations(spark, sf_dir))
    return j.select("read_id", "rg_id", "rg_sample", "rg_library")


# --------------------------------------------------------------------------- JN3

_JN3_SQL = with_views(PAIRS) + """,
cand AS (SELECT read_name AS mn, ref_index AS mr, CASE WHEN ref_index = -1 THEN 0 ELSE pos END AS mp,
           (flag & 64) <> 0 AS mfirst, count(*) AS cnt, min(flag) AS mflag FROM pairs GROUP BY ALL)
SELECT p.read_name, p.flag, p.pos, CAST(coalesce(c.cnt, 0) AS BIGINT) AS mate_count, c.mflag AS mate_flag,
  CASE WHEN p.flag & 1 = 0 THEN 'read is not paired'
       WHEN ((p.flag & 64) <> 0) = ((p.flag & 128) <> 0) THEN 'both or neither end bits set'
       WHEN c.cnt > 1 THEN 'more than one mate' END AS mate_error
FROM pairs p LEFT JOIN cand c ON p.read_name = c.mn AND p.mate_ref_index = c.mr
  AND (CASE WHEN p.mate_ref_index = -1 THEN 0 ELSE p.mate_pos END) = c.mp AND c.mfirst = NOT ((p.flag & 64) <> 0)
"""


@register("with_mate", _JN3_SQL)
def with_mate(spark, sf_dir):
    p = A.pairs(spark, sf_dir).withColumn("pair_key", F.concat_ws("|", "read_name", F.col("flag").cast("string")))
    j = JN.with_mate(p, key="pair_key")
    return j.select("read_name", "flag", "pos", "mate_count", "mate_flag", "mate_error")


# --------------------------------------------------------------------------- JN4

_JN4_SQL = with_views(READS, READS_X, TARGETS) + "," + _W1_CORE + """
SELECT t.ref_index, CAST(greatest(t.s, iv.start) AS INTEGER) AS s, CAST(least(t.e, iv."end") AS INTEGER) AS e, t.target_id
FROM targets t JOIN iv ON t.ref_index = iv.ref_index AND t.s <= iv."end" AND t.e >= iv.start
"""


@register("intersect_targets", _JN4_SQL)
def intersect_targets(spark, sf_dir):
    """JN4: targets intersected with the covered regions (W1) of callable reads."""
    iv = IV.merge_read_intervals(FL.callable_reads(A.reads(spark, sf_dir)))
    b = iv.select("ref_index", F.col("start").alias("s"), F.col("end").alias("e"))
    return IV.intersect_intervals(A.targets(spark, sf_dir), b)


# --------------------------------------------------------------------------- JN5

from .q_aggs import NUM_PARTITIONS, _AG2_SQL  # noqa: E402

_JN5_SQL = _AG2_SQL.replace("SELECT region, part AS partition, n AS n_reads FROM st", """
SELECT r.read_id, s.part AS partition FROM reads r JOIN st s ON r.ref_index = s.region
WHERE r.flag & 4 = 0 AND r.ref_index BETWEEN 1 AND 24
""")


@register("assign_partitions", _JN5_SQL)
def assign_partitions(spark, sf_dir):
    reads = FL.callable_reads(A.reads(spark, sf_dir))
    plan = AG.balance_regions(AG.reads_per_region(reads), NUM_PARTITIONS)
    return JN.assign_partitions(reads, plan).select("read_id", "partition")


# --------------------------------------------------------------------------- JN6

_JN6_SQL = with_views(READS, READS_X, TARGETS) + """
SELECT r.read_id, r.ref_index, r.pos FROM reads_x r
WHERE r.flag & 4 = 0 AND r.ref_index BETWEEN 1 AND 24
  AND EXISTS (SELECT 1 FROM targets t WHERE t.ref_index = r.ref_index AND t.s <= r.pos + r.ref_len - 1 AND t.e >= r.pos)
"""


@register("reads_in_targets", _JN6_SQL)
def reads_in_targets(spark, sf_dir):
    reads = FL.callable_reads(A.reads(spark, sf_dir))
    return IV.reads_in_targets(reads, A.targets(spark, sf_dir)).select("read_id", "ref_index", "pos")


# --------------------------------------------------------------------------- JN7

_JN7_SQL = with_views(READS, KNOWN_SITES) + """
SELECT r.read_id, r.ref_index, r.pos FROM reads r
WHERE r.flag & 4 = 0 AND NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.ref_index = r.ref_index AND k.pos = 1 + r.pos % 1000)
"""


@register("exclude_known_sites", _JN7_SQL)
def exclude_known_sites(spark, sf_dir):
    """JN7 on read start observations folded to 1..1000 so known sites are hit."""
    obs = (A.reads(spark, sf_dir).filter(F.col("flag").bitwiseAND(S.FLAG_UNMAPPED) == 0)
           .select("read_id", "ref_index", F.col("pos").alias("start"), (1 + F.col("pos") % 1000).cast("int").alias("pos")))
    return JN.exclude_known_sites(obs, A.known_sites(spark, sf_dir)).select("read_id", "ref_index", F.col("start").alias("pos"))


# --------------------------------------------------------------------------- JN11

_JN11_SQL = with_views(READS, READS_X, SEQUENCES) + """,
obs AS (SELECT CASE WHEN ref_index = 5 THEN 105 ELSE ref_index END AS seq_index, CASE WHEN ref_index = 7 THEN 'other' ELSE ref_name END AS name,
        CASE WHEN ref_index = 7 THEN 0 ELSE CAST(max(pos + ref_len - 1) AS INTEGER) END AS length
        FROM reads_x WHERE flag & 4 = 0 GROUP BY ref_index, ref_name),
j AS (SELECT coalesce(a.seq_index, b.seq_index) AS seq_index, a.name AS a_name, b.name AS b_name,
        a.length AS a_length, b.length AS b_length FROM sequences a FULL OUTER JOIN obs b ON a.seq_index = b.seq_index)
SELECT CAST(seq_index AS INTEGER) AS seq_index, a_name, b_name, a_length, b_length,
  CASE WHEN a_name IS NULL THEN 'missing in first' WHEN b_name IS NULL THEN 'missing in second'
       WHEN a_length <> 0 AND b_length <> 0 AND a_length <> b_length THEN 'length'
       WHEN a_name <> b_name THEN 'name' END AS difference
FROM j WHERE a_name IS NULL OR b_name IS NULL OR (a_length <> 0 AND b_length <> 0 AND a_length <> b_length) OR a_name <> b_name
"""


@register("diff_dictionaries", _JN11_SQL)
def diff_dictionaries(spark, sf_dir):
    """JN11: the adapter dictionary against one observed from the reads: furthest end per contig, contig 5 at another
    index, contig 7 under another name and of unknown length."""
    r = IV.with_alignment_end(A.reads(spark, sf_dir)).filter(F.col("flag").bitwiseAND(S.FLAG_UNMAPPED) == 0)
    i = F.col("ref_index")
    obs = (r.groupBy("ref_index", "ref_name").agg(F.max("align_end").alias("length"))
           .select(F.when(i == 5, 105).otherwise(i).alias("seq_index"), F.when(i == 7, "other").otherwise(F.col("ref_name")).alias("name"),
                   F.when(i == 7, 0).otherwise(F.col("length")).alias("length"), F.lit(None).cast("string").alias("md5")))
    d = JN.diff_dictionaries(A.sequences(spark), obs)
    return d.select("seq_index", "a_name", "b_name", "a_length", "b_length", "difference")


# --------------------------------------------------------------------------- JN12

def programs_from_nations(spark, sf_dir):
    """A program chain per region: PG<n> follows PG<n-5>."""
    n = A.table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("ord"), F.concat(F.lit("PG"), F.col("n_nationkey").cast("string")).alias("id"),
                    F.col("n_name").alias("name"),
                    F.when(F.col("n_nationkey") >= 5, F.concat(F.lit("PG"), (F.col("n_nationkey") - 5).cast("string")))
                    .alias("previous_id"))


_JN12_SQL = """
WITH p AS (SELECT n_nationkey AS ord, 'PG' || CAST(n_nationkey AS VARCHAR) AS id,
             CASE WHEN n_nationkey >= 5 THEN 'PG' || CAST(n_nationkey - 5 AS VARCHAR) END AS previous_id FROM nation)
SELECT 'PGnew' AS id, arg_min(id, ord) AS previous_id FROM p
WHERE id <> 'PGnew' AND id NOT IN (SELECT previous_id FROM p WHERE previous_id IS NOT NULL)
"""


@register("chain_program", _JN12_SQL)
def chain_program(spark, sf_dir):
    return JN.chain_program(programs_from_nations(spark, sf_dir), "PGnew")
