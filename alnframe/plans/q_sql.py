"""Queries that call the scalar layer and the region queries from SQL (UD2)."""

from __future__ import annotations

from ..functions import sql as SQL
from ..sources import adapter as A
from .catalog import register
from .oracle_views import READS, READS_X, with_views

_CALLS = """
  aln_is_paired(flag) AS f1, aln_is_proper_pair(flag) AS f2, aln_is_unmapped(flag) AS f3, aln_is_mate_unmapped(flag) AS f4, aln_is_reverse(flag) AS f5,
  aln_is_mate_reverse(flag) AS f6, aln_is_first(flag) AS f7, aln_is_second(flag) AS f8, aln_is_secondary(flag) AS f9, aln_fails_vendor_qc(flag) AS f10,
  aln_is_duplicate(flag) AS f11, aln_set_flag(flag, 1024, pos % 2 = 0) AS f12,
  aln_format_cigar(aln_parse_cigar(cigar)) AS c1, aln_cigar_ref_length(cigar) AS c3, aln_cigar_padded_ref_length(cigar) AS c4, aln_cigar_read_length(cigar) AS c5,
  aln_alignment_end(flag, pos, cigar) AS c6, aln_unclipped_start(pos, cigar) AS c7, aln_unclipped_end(flag, pos, cigar) AS c8,
  aln_inserted_bases(cigar) AS c11, aln_deleted_bases(cigar) AS c11d, aln_maps_no_bases(cigar) AS c0, aln_reg2bin(pos - 1, pos + mapq * 40) AS c14,
  aln_bin_level(mapq * 300) AS c16, aln_bin_first_locus(mapq * 300) AS c16f, aln_bin_last_locus(mapq * 300) AS c16l, aln_window_16k(pos) AS c17,
  aln_interval_length(pos, pos + mapq) AS c18, aln_start_from_end(pos, mapq) AS c18s, aln_end_from_start(pos, mapq) AS c18e,
  aln_overlaps(pos, pos + 50, 500000, 500000 + mapq * 9000) AS c19, aln_encloses(500000, 500000 + mapq * 9000, pos, pos + 50) AS c19e,
  aln_overlap_length(pos, pos + 50, 500000, 500000 + mapq * 9000) AS c19l, aln_cycle(flag & 16 <> 0, 100, mapq) AS c20,
  aln_complement(seq) AS b1, aln_reverse_complement(seq) AS b1r, aln_reverse_qualities(qual) AS b2, aln_bases_equal(substring(seq, 1, 1), lower(substring(seq, 2, 1))) AS b4,
  aln_is_no_call(substring(seq, 1, 1)) AS b5, aln_is_valid_base(substring(seq, 1, 1)) AS b5v, round(aln_gc_content(seq), 6) AS b6,
  aln_normalize_bases(translate(lower(seq), 'n', '.')) AS b7, aln_valid_read_bases(concat(seq, CASE WHEN mapq % 5 = 0 THEN '!' ELSE '' END)) AS b8,
  array_join(aln_phred_scores(qual), ',') AS b9, aln_phred_to_fastq(aln_phred_scores(qual)) AS b9q, aln_max_phred(qual) AS b11m,
  aln_guess_quality_encoding(CASE WHEN mapq % 2 = 0 THEN qual ELSE concat(qual, '~') END) AS b11, aln_fix_illumina_quals(CASE WHEN mapq % 3 = 0 THEN '@Jh~' ELSE qual END) AS b12,
  aln_bisulfite_bases_equal(flag & 16 <> 0, substring(seq, 3, 1), substring(seq, 4, 1)) AS b13,
  aln_sq_base(pos % 256) AS b15, aln_sq_ratio(pos % 256) AS b15r, aln_sq_encode(mapq % 4, pos % 100) AS b15e, aln_sq_complement(pos % 256) AS b15c,
  aln_sq_scaled_ratio(mapq / 51, mapq / 510) AS b16"""

_BIN = ("CASE WHEN {b} >> 14 = {e} >> 14 THEN 4681 + ({b} >> 14) WHEN {b} >> 17 = {e} >> 17 THEN 585 + ({b} >> 17) WHEN {b} >> 20 = {e} >> 20 THEN 73 + ({b} >> 20) "
        "WHEN {b} >> 23 = {e} >> 23 THEN 9 + ({b} >> 23) WHEN {b} >> 26 = {e} >> 26 THEN 1 + ({b} >> 26) ELSE 0 END").format(b="(pos - 1)", e="(pos + mapq * 40 - 1)")
_CLIP = "CAST(coalesce(list_sum(list_transform(regexp_extract_all(regexp_extract(cigar, '{p}'), '(\\d+)', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER)"
_SUM = "CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+){op}', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER)"
_SQ = "(pos % 256)"

_LAYER_SQL = with_views(READS, READS_X) + """,
l AS (SELECT *, mapq * 300 AS bin, CASE WHEN mapq * 300 >= 4681 THEN 5 WHEN mapq * 300 >= 585 THEN 4 WHEN mapq * 300 >= 73 THEN 3 WHEN mapq * 300 >= 9 THEN 2
        WHEN mapq * 300 >= 1 THEN 1 ELSE 0 END AS lev FROM reads_x),
m AS (SELECT *, [0, 1, 9, 73, 585, 4681][lev + 1] AS first_bin, CAST(536870912 >> (3 * lev) AS BIGINT) AS span FROM l)
SELECT read_id, flag & 1 <> 0 AS f1, CASE WHEN flag & 1 <> 0 THEN flag & 2 <> 0 END AS f2, flag & 4 <> 0 AS f3, CASE WHEN flag & 1 <> 0 THEN flag & 8 <> 0 END AS f4,
  flag & 16 <> 0 AS f5, CASE WHEN flag & 1 <> 0 THEN flag & 32 <> 0 END AS f6, CASE WHEN flag & 1 <> 0 THEN flag & 64 <> 0 END AS f7,
  CASE WHEN flag & 1 <> 0 THEN flag & 128 <> 0 END AS f8, flag & 256 <> 0 AS f9, flag & 512 <> 0 AS f10, flag & 1024 <> 0 AS f11,
  CAST(CASE WHEN pos % 2 = 0 THEN flag | 1024 ELSE flag & ~1024 END AS INTEGER) AS f12,
  cigar AS c1, ref_len AS c3, ref_len AS c4, read_len AS c5, CAST(CASE WHEN flag & 4 <> 0 THEN 0 ELSE pos + ref_len - 1 END AS INTEGER) AS c6,
  CAST(pos - """ + _CLIP.format(p=r"^(\d+[SH])+") + """ AS INTEGER) AS c7,
  CAST(CASE WHEN flag & 4 <> 0 THEN 0 ELSE pos + ref_len - 1 END + """ + _CLIP.format(p=r"(\d+[SH])+$") + """ AS INTEGER) AS c8,
  """ + _SUM.format(op="I") + " AS c11, " + _SUM.format(op="D") + """ AS c11d, false AS c0, CAST(""" + _BIN + """ AS INTEGER) AS c14,
  CAST(lev AS INTEGER) AS c16, CAST((bin - first_bin) * span + 1 AS INTEGER) AS c16f, CAST((bin - first_bin + 1) * span AS INTEGER) AS c16l,
  CAST((greatest(pos, 1) - 1) >> 14 AS INTEGER) AS c17, CAST(mapq + 1 AS INTEGER) AS c18, CAST(pos - mapq + 1 AS INTEGER) AS c18s, CAST(pos + mapq - 1 AS INTEGER) AS c18e,
  500000 <= pos + 50 AND 500000 + mapq * 9000 >= pos AS c19, pos >= 500000 AND pos + 50 <= 500000 + mapq * 9000 AS c19e,
  CAST(least(pos + 50, 500000 + mapq * 9000) - greatest(pos, 500000) + 1 AS INTEGER) AS c19l, CAST(CASE WHEN flag & 16 <> 0 THEN 100 - mapq ELSE mapq + 1 END AS INTEGER) AS c20,
  translate(seq, 'ACGT', 'TGCA') AS b1, reverse(translate(seq, 'ACGT', 'TGCA')) AS b1r, reverse(qual) AS b2, substr(seq, 1, 1) = substr(seq, 2, 1) AS b4,
  substr(seq, 1, 1) = 'N' AS b5, substr(seq, 1, 1) <> 'N' AS b5v, round(length(regexp_replace(seq, '[^CG]', '', 'g')) / CAST(length(seq) AS DOUBLE), 6) AS b6,
  seq AS b7, mapq % 5 <> 0 AS b8, array_to_string(list_transform(string_split(qual, ''), lambda x: ascii(x) - 33), ',') AS b9, qual AS b9q,
  CAST(list_max(list_transform(string_split(qual, ''), lambda x: ascii(x) - 33)) AS INTEGER) AS b11m, CASE WHEN mapq % 2 = 0 THEN 'SANGER' ELSE 'ILLUMINA' END AS b11,
  CASE WHEN mapq % 3 = 0 THEN '!+I_' WHEN NOT regexp_matches(qual, '[\\x00-\\x3f]') THEN qual END AS b12,
  substr(seq, 3, 1) = substr(seq, 4, 1) OR (flag & 16 <> 0 AND substr(seq, 4, 1) = 'G' AND substr(seq, 3, 1) = 'A') OR (flag & 16 = 0 AND substr(seq, 4, 1) = 'C' AND substr(seq, 3, 1) = 'T') AS b13,
  CAST({q} >> 6 AS INTEGER) AS b15, CAST({q} & 63 AS INTEGER) AS b15r, CAST(((mapq % 4) << 6) | least(pos % 100, 63) AS INTEGER) AS b15e,
  CAST(((3 - ({q} >> 6)) << 6) | ({q} & 63) AS INTEGER) AS b15c, CASE WHEN mapq / 51 < 1 AND mapq > 0 THEN 10 END AS b16
FROM m
""".replace("{q}", _SQ)


@register("sql_function_layer", _LAYER_SQL)
def sql_function_layer(spark, sf_dir):
    """Every flag, CIGAR, bin, interval, base and quality function from SQL."""
    SQL.register_sql_functions(spark)
    A.reads(spark, sf_dir).createOrReplaceTempView("aln_layer_reads")
    return spark.sql(f"SELECT read_id, {_CALLS} FROM aln_layer_reads")


_REGION_SQL = with_views(READS, READS_X) + """
SELECT 'overlapping' AS kind, read_id, ref_index, pos, flag FROM reads_x
WHERE ref_index = 3 AND (CASE WHEN flag & 4 <> 0 THEN pos ELSE pos + ref_len - 1 END) >= 200000 AND pos <= 700000
UNION ALL SELECT 'contained', read_id, ref_index, pos, flag FROM reads_x
WHERE ref_index = 7 AND pos >= 100000 AND (CASE WHEN flag & 4 <> 0 THEN pos ELSE pos + ref_len - 1 END) <= 900000
UNION ALL SELECT 'to the end', read_id, ref_index, pos, flag FROM reads_x WHERE ref_index = 11 AND (CASE WHEN flag & 4 <> 0 THEN pos ELSE pos + ref_len - 1 END) >= 500000
UNION ALL SELECT 'starting', read_id, ref_index, pos, flag FROM reads_x WHERE (ref_index, pos) IN (SELECT (ref_index, min(pos)) FROM reads WHERE ref_index < 25 GROUP BY ref_index)
"""


@register("sql_region_functions", _REGION_SQL)
def sql_region_functions(spark, sf_dir):
    """F3 to F5 as table functions; the last joined to a table, one call for each row."""
    SQL.register_sql_functions(spark)
    A.reads(spark, sf_dir).createOrReplaceTempView("aln_region_reads")
    columns = {"read_id": "STRING", "ref_index": "INT", "pos": "INT", "flag": "INT"}
    SQL.register_region_functions(spark, "aln_region_reads", columns)
    return spark.sql("""
        SELECT 'overlapping' AS kind, * FROM aln_reads_overlapping(3, 200000, 700000)
        UNION ALL SELECT 'contained', * FROM aln_reads_contained(7, 100000, 900000)
        UNION ALL SELECT 'to the end', * FROM aln_reads_overlapping(11, 500000, 0)
        UNION ALL SELECT 'starting', r.* FROM (SELECT ref_index AS c, min(pos) AS p FROM aln_region_reads GROUP BY ref_index) f, LATERAL aln_reads_starting_at(f.c, f.p) r""")
