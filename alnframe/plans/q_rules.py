"""Registered queries in which every validation rule and every typed tag getter meets rows it is about."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import tags as TG
from ..operators import validate as VA
from ..sources import adapter as A
from .catalog import register
from .oracle_views import CONTIG, READS, READS_X, with_views
from .q_io import tagged_reads
from .q_joins import read_groups_from_nations

# --------------------------------------------------------------------------- V1-V19, V21


def _broken_reads(spark, sf_dir):
    """The adapter reads with flags, places, sizes, texts and tags altered by position and mapping quality."""
    m, p = F.col("mapq"), F.col("pos")
    mate = F.when(m % 5 < 2, S.NO_REF_INDEX).otherwise((F.col("ref_index") + 1) % 25)
    t = F.col("tags")
    for name, when in (("FZ", F.col("ref_index") % 4 == 0), ("CS", F.col("ref_index") % 4 == 1), ("CQ", F.col("ref_index") % 4 != 3)):
        t = F.when(when, TG.set_tag(t, name, TG.string_tag(F.lit("0")))).otherwise(t)
    t = (F.when(m % 9 == 0, TG.set_tag(t, "RG", TG.string_tag(F.lit("rgX"))))
         .when(m % 9 == 1, TG.set_tag(t, "RG", TG.string_tag(F.lit("rg1")))).otherwise(t))
    return A.reads(spark, sf_dir).withColumns({
        "flag": (p % 2048).cast("int"),
        "ref_name": F.when(m % 10 == 0, "*").when(m % 10 == 1, "chrUn").otherwise(F.col("ref_name")),
        "ref_index": F.when(m % 10 < 2, S.NO_REF_INDEX).otherwise(F.col("ref_index")),
        "pos": F.when(m % 7 == 0, 0).when(m % 7 == 1, p + 500000).otherwise(p),
        "mate_ref_name": F.when(m % 5 == 0, "*").when(m % 5 == 1, "chrUn").otherwise(A.contig_name(mate)),
        "mate_ref_index": mate,
        "mate_pos": F.when(m % 3 == 0, 0).when(m % 3 == 1, 5).otherwise(2000000),
        "isize": F.when(m % 11 == 0, 600000000).when(m % 11 == 1, -600000000).otherwise(10),
        "mapq": F.when(m % 4 == 0, 0).otherwise(m * 8),
        "cigar": F.when(m % 13 == 0, "*").when(m % 13 == 1, "10Q").otherwise(F.col("cigar")),
        "seq": F.when(m % 6 == 0, "*").otherwise(F.col("seq")),
        "qual": F.when(m % 8 == 0, F.substring("qual", 1, 90)).when(m % 8 == 1, "*").otherwise(F.col("qual")),
        "tags": t,
    })


def _rules_sql(n_contigs: int, missing_group: str) -> str:
    return with_views(READS, READS_X) + f""",
m AS (SELECT *, CASE WHEN mapq % 5 < 2 THEN -1 ELSE (ref_index + 1) % 25 END AS mate FROM reads_x),
b AS (SELECT read_id, pos % 2048 AS flag, ref_len, {n_contigs} AS ds, ref_index % 4 AS color, mapq % 9 AS rg,
  CASE WHEN mapq % 10 = 0 THEN '*' WHEN mapq % 10 = 1 THEN 'chrUn' ELSE ref_name END AS rname,
  CASE WHEN mapq % 10 < 2 THEN -1 ELSE ref_index END AS rix,
  CASE WHEN mapq % 7 = 0 THEN 0 WHEN mapq % 7 = 1 THEN pos + 500000 ELSE pos END AS pos,
  CASE WHEN mapq % 5 = 0 THEN '*' WHEN mapq % 5 = 1 THEN 'chrUn' ELSE {CONTIG.format(r="mate")} END AS mname, mate AS mix,
  CASE WHEN mapq % 3 = 0 THEN 0 WHEN mapq % 3 = 1 THEN 5 ELSE 2000000 END AS mpos,
  CASE WHEN mapq % 11 < 2 THEN 600000000 ELSE 10 END AS size,
  CASE WHEN mapq % 4 = 0 THEN 0 ELSE mapq * 8 END AS mq,
  CASE WHEN mapq % 13 = 0 THEN '*' WHEN mapq % 13 = 1 THEN '10Q' ELSE cigar END AS cigar,
  CASE WHEN mapq % 6 = 0 THEN 0 ELSE 100 END AS bases,
  CASE WHEN mapq % 8 = 0 THEN 90 WHEN mapq % 8 = 1 THEN NULL ELSE 100 END AS quals FROM m),
f AS (SELECT *, flag & 1 <> 0 AS paired, flag & 4 = 0 AS mapped, cigar NOT IN ('*', '10Q') AS good FROM b),
e AS (SELECT read_id, list_filter([
  CASE WHEN NOT paired AND flag & 2 <> 0 THEN 'ERROR:INVALID_FLAG_PROPER_PAIR' END,
  CASE WHEN NOT paired AND flag & 8 <> 0 THEN 'ERROR:INVALID_FLAG_MATE_UNMAPPED' END,
  CASE WHEN NOT paired AND flag & 32 <> 0 THEN 'ERROR:INVALID_FLAG_MATE_NEG_STRAND' END,
  CASE WHEN NOT paired AND flag & 64 <> 0 THEN 'ERROR:INVALID_FLAG_FIRST_OF_PAIR' END,
  CASE WHEN NOT paired AND flag & 128 <> 0 THEN 'ERROR:INVALID_FLAG_SECOND_OF_PAIR' END,
  CASE WHEN NOT paired AND mname <> '*' THEN 'ERROR:INVALID_MATE_REF_INDEX' END,
  CASE WHEN paired AND (mname = '*') = (mpos <> 0) THEN 'ERROR:INVALID_ALIGNMENT_START' END,
  CASE WHEN paired AND mname <> '*' AND ds > 0 AND mix = -1 THEN 'ERROR:INVALID_REFERENCE_INDEX' END,
  CASE WHEN paired AND mix <> -1 AND ds > 0 AND mpos > 1000000 THEN 'ERROR:INVALID_ALIGNMENT_START' END,
  CASE WHEN paired AND mname = '*' AND flag & 8 = 0 THEN 'ERROR:INVALID_FLAG_MATE_UNMAPPED' END,
  CASE WHEN paired AND flag & 192 = 0 THEN 'WARNING:PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND' END,
  CASE WHEN size > 536870912 THEN 'ERROR:INVALID_INSERT_SIZE' END,
  CASE WHEN NOT mapped AND flag & 256 <> 0 THEN 'ERROR:INVALID_FLAG_NOT_PRIM_ALIGNMENT' END,
  CASE WHEN (NOT mapped AND mq <> 0) OR (mapped AND mq > 255) THEN 'ERROR:INVALID_MAPPING_QUALITY' END,
  CASE WHEN mapped AND cigar = '*' THEN 'ERROR:INVALID_CIGAR' END,
  CASE WHEN mapped AND cigar = '10Q' THEN 'ERROR:INVALID_CIGAR' END,
  CASE WHEN mapped AND ds = 0 THEN 'ERROR:MISSING_SEQUENCE_DICTIONARY' END,
  CASE WHEN mapped AND rname = '*' THEN 'ERROR:INVALID_FLAG_READ_UNMAPPED' END,
  CASE WHEN {missing_group} THEN 'ERROR:READ_GROUP_NOT_FOUND' END,
  CASE WHEN (rname = '*') = (pos <> 0) THEN 'ERROR:INVALID_ALIGNMENT_START' END,
  CASE WHEN rname <> '*' AND ds > 0 AND rix = -1 THEN 'ERROR:INVALID_REFERENCE_INDEX' END,
  CASE WHEN rix <> -1 AND ds > 0 AND pos > 1000000 THEN 'ERROR:INVALID_ALIGNMENT_START' END,
  CASE WHEN bases = 0 AND flag & 256 = 0 AND color <> 0
         AND (color <> 1 OR (mapped AND cigar <> '10Q' AND NOT (good AND regexp_matches(cigar, '[ID]')))) THEN 'ERROR:EMPTY_READ' END,
  CASE WHEN quals <> bases THEN 'ERROR:MISMATCH_READ_LENGTH_AND_QUALS_LENGTH' END,
  CASE WHEN mapped AND good AND rix <> -1 AND ds > 0 AND pos + ref_len - 1 > 1000000 THEN 'ERROR:CIGAR_MAPS_OFF_REFERENCE' END
  ], lambda x: x IS NOT NULL) AS errs FROM f)
SELECT read_id, CAST(len(errs) AS INTEGER) AS n_errors, array_to_string(list_sort(errs), ',') AS error_types FROM e
"""


def _types(validated):
    types = F.array_sort(F.transform("errors", lambda x: F.concat(x.severity, F.lit(":"), x.type)))
    return validated.select("read_id", F.size("errors").alias("n_errors"), F.array_join(types, ",").alias("error_types"))


@register("validation_rules", _rules_sql(25, "rg = 0"))
def validation_rules(spark, sf_dir):
    """Every rule on single reads but those on the structure of a CIGAR (see cigar_validation)."""
    return _types(VA.validate_reads(_broken_reads(spark, sf_dir), A.sequences(spark), read_groups_from_nations(spark, sf_dir)))


@register("validation_no_dictionary", _rules_sql(0, "rg < 2"))
def validation_no_dictionary(spark, sf_dir):
    """The same reads under a header without contigs and read groups."""
    return _types(VA.validate_reads(_broken_reads(spark, sf_dir), A.sequences(spark).filter(F.lit(False))))


# --------------------------------------------------------------------------- TG3, TG4

_TAGS_SQL = with_views(READS) + """
SELECT read_id, 'rg' || CAST(ref_index % 4 AS VARCHAR) AS rg, CAST(mapq % 7 AS BIGINT) AS nm,
  CASE WHEN mapq % 7 <= 3 THEN CAST(mapq % 7 AS BIGINT) END AS nm_ranged, CAST(mapq / 4.0 AS FLOAT) AS xf,
  CAST(pos % 65536 AS VARCHAR) || ',' || CAST(mapq AS VARCHAR) AS xs, CAST(NULL AS VARCHAR) AS nm_as_string,
  CASE WHEN mapq % 2 = 0 THEN 'NM,RG,XC,XF,XS' ELSE 'RG,XC,XF,XS' END AS names,
  CASE WHEN mapq % 2 = 0 THEN 'F' ELSE 'R' END AS xc
FROM reads
"""


@register("typed_tags", _TAGS_SQL)
def typed_tags(spark, sf_dir):
    """Typed getters; a tag set, and one removed from the reads of odd mapping quality."""
    r = tagged_reads(spark, sf_dir)
    even = F.col("mapq") % 2 == 0
    t = TG.set_tag("tags", "XC", TG.string_tag(F.when(even, "F").otherwise("R")))
    edited = F.when(even, t).otherwise(TG.remove_tag(t, "NM"))
    return r.select("read_id", TG.tag_string("tags", "RG", strict=True).alias("rg"), TG.tag_int("tags", "NM", strict=True).alias("nm"),
                    TG.tag_int_ranged("tags", "NM", 0, 3).alias("nm_ranged"), TG.tag_float("tags", "XF", strict=True).alias("xf"),
                    F.array_join(TG.tag_int_array("tags", "XS", strict=True).cast("array<string>"), ",").alias("xs"),
                    TG.tag_string("tags", "NM").alias("nm_as_string"), F.array_join(TG.list_tags(edited), ",").alias("names"),
                    TG.tag_string(edited, "XC").alias("xc"))
