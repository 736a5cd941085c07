"""UD2: the scalar layer exposed to Spark SQL as SQL functions.

``register_sql_functions(spark)`` creates temporary SQL functions whose bodies are plain
SQL expressions, so Catalyst inlines them into the plan like any built-in expression (no
Python at run time)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import schema as S
from . import bases as BQ

PREFIX = "aln_"

def _sum(ops: str) -> str:
    """Summed lengths of the given CIGAR operators."""
    return rf"aggregate(regexp_extract_all(c, '(\\d+)[{ops}]', 1), 0, (a, x) -> a + cast(x AS INT))"


def _bit(bit: int, of_pairs: bool = False) -> tuple[str, str, str]:
    test = f"(flag & {bit}) <> 0"
    return "flag INT", "BOOLEAN", f"CASE WHEN (flag & 1) <> 0 THEN {test} END" if of_pairs else test


def _levels(column: str, values: list) -> str:
    """The value of the bin level in ``column``."""
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"


_STARTS, _SHIFTS = S.BIN_LEVEL_STARTS, S.BIN_LEVEL_SHIFTS
_REG2BIN = "CASE " + " ".join(f"WHEN b >> {shift} = (e - 1) >> {shift} THEN {start} + (b >> {shift})"
                              for start, shift in sorted(zip(_STARTS[1:], _SHIFTS[1:], strict=True), reverse=True)) + " ELSE 0 END"
_LEVEL = "CASE " + " ".join(f"WHEN b >= {start} THEN {k}" for k, start in reversed(list(enumerate(_STARTS)))) + " END"
_SPAN = _levels(f"({_LEVEL})", [S.BIN_GENOMIC_SPAN >> (3 * k) for k in range(6)])
_FIRST = _levels(f"({_LEVEL})", list(_STARTS))
_END = f"CASE WHEN (flag & 4) <> 0 THEN 0 ELSE pos + {_sum('MDN=X')} - 1 END"
_LEADING, _TRAILING = (f"aggregate(regexp_extract_all(regexp_extract(c, '{p}', 0), '(\\\\d+)', 1), 0, (a, x) -> a + cast(x AS INT))"
                       for p in (r"^(\\d+[SH])+", r"(\\d+[SH])+$"))
_ELEMENTS = "ARRAY<STRUCT<len: INT, op: STRING>>"
_PHRED = "transform(split(q, ''), x -> ascii(x) - 33)"
_MAX_PHRED = "ascii(array_max(split(q, ''))) - 33"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# name -> (signature, return type, body)
SQL_FUNCTIONS = {
    # flags
    "is_paired": _bit(1), "is_proper_pair": _bit(2, True), "is_unmapped": _bit(4), "is_mate_unmapped": _bit(8, True), "is_reverse": _bit(16),
    "is_mate_reverse": _bit(32, True), "is_first": _bit(64, True), "is_second": _bit(128, True), "is_secondary": _bit(256),
    "fails_vendor_qc": _bit(512), "is_duplicate": _bit(1024),
    "set_flag": ("flag INT, bit INT, value BOOLEAN", "INT", "CASE WHEN value THEN flag | bit ELSE flag & ~bit END"),
    # CIGAR and coordinates
    "parse_cigar": ("c STRING", _ELEMENTS, r"CASE WHEN c = '*' THEN cast(array() AS " + _ELEMENTS + r") WHEN c RLIKE '^(?:\\d+[MIDNSHP=X])+$' THEN transform("
                    r"regexp_extract_all(c, '(\\d+[MIDNSHP=X])', 1), x -> named_struct('len', cast(substring(x, 1, length(x) - 1) AS INT), 'op', right(x, 1))) END"),
    "format_cigar": (f"o {_ELEMENTS}", "STRING", "CASE WHEN size(o) = 0 THEN '*' ELSE array_join(transform(o, x -> concat(x.len, x.op)), '') END"),
    "cigar_ref_length": ("c STRING", "INT", _sum("MDN=X")),
    "cigar_padded_ref_length": ("c STRING", "INT", _sum("MDN=XP")),
    "cigar_read_length": ("c STRING", "INT", _sum("MIS=X")),
    "inserted_bases": ("c STRING", "INT", _sum("I")),
    "deleted_bases": ("c STRING", "INT", _sum("D")),
    "alignment_end": ("flag INT, pos INT, c STRING", "INT", _END),
    "unclipped_start": ("pos INT, c STRING", "INT", f"pos - {_LEADING}"),
    "unclipped_end": ("flag INT, pos INT, c STRING", "INT", f"({_END}) + {_TRAILING}"),
    "maps_no_bases": ("c STRING", "BOOLEAN", r"NOT (c RLIKE '\\d[M=X]')"),
    "reg2bin": ("b INT, e INT", "INT", _REG2BIN),
    "bin_level": ("b INT", "INT", _LEVEL),
    "bin_first_locus": ("b INT", "INT", f"(b - {_FIRST}) * ({_SPAN}) + 1"),
    "bin_last_locus": ("b INT", "INT", f"(b - {_FIRST} + 1) * ({_SPAN})"),
    "window_16k": ("p INT", "INT", "(greatest(p, 1) - 1) >> 14"),
    "interval_length": ("s INT, e INT", "INT", "e - s + 1"),
    "start_from_end": ("e INT, n INT", "INT", "e - n + 1"),
    "end_from_start": ("s INT, n INT", "INT", "s + n - 1"),
    "overlaps": ("s1 INT, e1 INT, s2 INT, e2 INT", "BOOLEAN", "s2 <= e1 AND e2 >= s1"),
    "encloses": ("s1 INT, e1 INT, s2 INT, e2 INT", "BOOLEAN", "s2 >= s1 AND e2 <= e1"),
    "overlap_length": ("s1 INT, e1 INT, s2 INT, e2 INT", "INT", "least(e1, e2) - greatest(s1, s2) + 1"),
    "cycle": ("negative BOOLEAN, n INT, i INT", "INT", "CASE WHEN negative THEN n - i ELSE i + 1 END"),
    # bases and qualities
    "complement": ("s STRING", "STRING", "translate(s, 'ACGTacgt', 'TGCAtgca')"),
    "reverse_complement": ("s STRING", "STRING", "reverse(translate(s, 'ACGTacgt', 'TGCAtgca'))"),
    "reverse_qualities": ("q STRING", "STRING", "reverse(q)"),
    "bases_equal": ("a STRING, b STRING", "BOOLEAN", "upper(a) = upper(b)"),
    "is_no_call": ("b STRING", "BOOLEAN", "b IN ('N', 'n', '.')"),
    "is_valid_base": ("b STRING", "BOOLEAN", "b IN ('A', 'C', 'G', 'T', 'a', 'c', 'g', 't')"),
    "gc_content": ("s STRING", "DOUBLE",
                   "try_divide(cast(length(regexp_replace(s, '[^CGcg]', '')) AS DOUBLE), cast(length(s) AS DOUBLE))"),
    "normalize_bases": ("s STRING", "STRING", "translate(upper(s), '.', 'N')"),
    "valid_read_bases": ("s STRING", "BOOLEAN", f"s RLIKE '{BQ.READ_BASES_RE}'"),
    "phred_scores": ("q STRING", "ARRAY<INT>", f"CASE WHEN q = '' THEN cast(array() AS ARRAY<INT>) WHEN NOT (q RLIKE '{BQ.NO_PHRED_RE}') THEN {_PHRED} END"),
    "phred_to_fastq": ("p ARRAY<INT>", "STRING", f"get(transform(array(array_join(transform(p, x -> CASE WHEN x >= 0 AND x <= {BQ.MAX_PHRED} THEN char(x + 33) END), '', ' ')), "
                       "q -> CASE WHEN NOT contains(q, ' ') THEN q END), 0)"),
    "max_phred": ("q STRING", "INT", _MAX_PHRED),
    "guess_quality_encoding": ("q STRING", "STRING", f"CASE WHEN {_MAX_PHRED} <= {BQ.SANGER_MAX_QUAL} THEN 'SANGER' ELSE 'ILLUMINA' END"),
    "fix_illumina_quals": ("q STRING", "STRING", rf"CASE WHEN NOT (q RLIKE '[\\x00-\\x3f]') THEN translate(q, {_literal(BQ._ILLUMINA_FROM)}, {_literal(BQ._ILLUMINA_TO)}) END"),
    "bisulfite_bases_equal": ("negative BOOLEAN, a STRING, r STRING", "BOOLEAN", "upper(a) = upper(r) OR (negative AND upper(r) = 'G' AND upper(a) = 'A') "
                              "OR (NOT negative AND upper(r) = 'C' AND upper(a) = 'T')"),
    "sq_base": ("b INT", "INT", f"(b & 255) >> {BQ.SQ_BASE_SHIFT}"),
    "sq_ratio": ("b INT", "INT", f"b & {BQ.SQ_QUALITY_MASK}"),
    "sq_encode": ("o INT, r INT", "INT", f"(o << {BQ.SQ_BASE_SHIFT}) | least(r, {BQ.SQ_QUALITY_MASK})"),
    "sq_complement": ("b INT", "INT", f"(({BQ.SQ_COMPLEMENT_MASK} & ~((b & 255) >> {BQ.SQ_BASE_SHIFT})) << {BQ.SQ_BASE_SHIFT}) | (b & {BQ.SQ_QUALITY_MASK})"),
    "sq_scaled_ratio": ("p2 DOUBLE, p3 DOUBLE", "INT", f"CASE WHEN p2 < 1 AND p3 > 0 AND p3 <= p2 THEN cast(least(round(-10 * log10(p3 / p2)), {BQ.SQ_QUALITY_MASK}) AS INT) END"),
}

#: Table functions over a view of reads: (signature, where). A region's end of 0 or less is the contig's.
REGION_FUNCTIONS = {
    "reads_overlapping": ("contig INT, first INT, last INT", "ref_index = contig AND {end} >= first AND (last <= 0 OR pos <= last)"),
    "reads_contained": ("contig INT, first INT, last INT", "ref_index = contig AND pos >= first AND (last <= 0 OR {end} <= last)"),
    "reads_starting_at": ("contig INT, first INT", "ref_index = contig AND pos = first"),
}


def register_sql_functions(spark: SparkSession, prefix: str = PREFIX) -> list[str]:
    names = []
    for name, (sig, ret, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({sig}) RETURNS {ret} RETURN {body}")
        names.append(prefix + name)
    return names


def register_region_functions(spark: SparkSession, view: str, columns: dict[str, str], prefix: str = PREFIX) -> list[str]:
    """F3 to F5 as SQL table functions over ``view`` (with ref_index, pos, flag and cigar): ``SELECT * FROM
    aln_reads_overlapping(3, 1, 5000)`` returns ``columns`` (name: type). They are inlined, so what is pushed down to the
    view's scan is what a WHERE would push down. An unmapped read that has a place is one base long."""
    end = f"CASE WHEN (flag & 4) <> 0 THEN pos ELSE {prefix}alignment_end(flag, pos, cigar) END"
    names = []
    for name, (signature, where) in REGION_FUNCTIONS.items():
        returned = ", ".join(f"{c} {t}" for c, t in columns.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({signature}) RETURNS TABLE({returned}) "
                  f"RETURN SELECT {', '.join(columns)} FROM {view} WHERE {where.format(end=end)}")
        names.append(prefix + name)
    return names
