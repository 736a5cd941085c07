"""Read filters. Plain predicates, so Catalyst pushes them into the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import bins as B
from ..functions import cigar as C


def callable_reads(reads: DataFrame) -> DataFrame:
    """mapped reads on reference indexes 1..24; adds ``region`` = ref_index."""
    return (reads.filter((F.col("flag").bitwiseAND(S.FLAG_UNMAPPED) == 0)
                         & F.col("ref_index").between(S.MIN_REGION, S.MAX_REGION))
            .withColumn("region", F.col("ref_index")))


def primary_only(reads: DataFrame) -> DataFrame:
    """drop secondary alignments."""
    return reads.filter(F.col("flag").bitwiseAND(S.FLAG_SECONDARY) == 0)


def _query_end(reads: DataFrame):
    """End used by region queries: alignment end, or the start for an unmapped placed read."""
    if "align_end" in reads.columns:
        end = F.col("align_end")
    else:
        end = C.alignment_end("flag", "pos", C.parse_cigar("cigar"))
    return F.when(F.col("flag").bitwiseAND(S.FLAG_UNMAPPED) != 0, F.col("pos")).otherwise(end)


def _region_pred(ref_index: int, start: int, end: int, contained: bool, use_bins: bool, reads: DataFrame):
    pred = F.col("ref_index") == ref_index
    if use_bins and "bin" in reads.columns:
        pred = pred & B.bin_predicate("bin", start, end)
    e = _query_end(reads)
    if contained:
        pred = pred & (F.col("pos") >= start)
        if end > 0:
            pred = pred & (e <= end)
    else:
        if start > 0:
            pred = pred & (e >= start)
        if end > 0:
            pred = pred & (F.col("pos") <= end)
    return pred


def query_overlapping(reads: DataFrame, ref_index: int, start: int, end: int, use_bins: bool = True) -> DataFrame:
    """reads overlapping [start, end]; end <= 0 means to the end of the contig.

    With a stored ``bin`` column (IO6) the bin ranges of F8 are added so Parquet can skip
    row groups; the exact predicate follows, so the result is the same either way."""
    return reads.filter(_region_pred(ref_index, start, end, False, use_bins, reads))


def query_contained(reads: DataFrame, ref_index: int, start: int, end: int, use_bins: bool = True) -> DataFrame:
    """reads lying within [start, end]."""
    return reads.filter(_region_pred(ref_index, start, end, True, use_bins, reads))


def query_alignment_start(reads: DataFrame, ref_index: int, start: int) -> DataFrame:
    """reads starting exactly at ``start``."""
    return reads.filter((F.col("ref_index") == ref_index) & (F.col("pos") == start))


def query_unmapped(reads: DataFrame) -> DataFrame:
    """reads without a reference (unmapped reads placed with their mate excluded)."""
    return reads.filter(F.col("ref_index") == S.NO_REF_INDEX)


def drop_comment_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """drop lines starting with ``#`` and empty lines."""
    return lines.filter(~F.col(column).startswith("#") & (F.length(F.col(column)) > 0))


def min_call_confidence(calls: DataFrame, min_qual: float = S.MIN_CALL_QUAL, column: str = "qual") -> DataFrame:
    """keep calls with QUAL >= min_qual."""
    return calls.filter(F.col(column) >= min_qual)


def maps_no_bases(reads: DataFrame) -> DataFrame:
    """reads whose CIGAR has no element consuming read and reference."""
    return reads.filter(C.maps_no_bases(C.parse_cigar("cigar")))
