"""Record edits: BQ3 reverse_complement_record, TG9 make_unmapped, TG12 reindex_bins,
BQ10 original qualities. Multi-column rewrites expressed with ``withColumns``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import bases as BQ
from ..functions import bins as B
from ..functions import cigar as C
from ..functions import tags as TG


def _reverse_tags(tags):
    """Per-base tags follow the read: E2/U2 bases reverse-complemented, OQ reversed, SQ
    values reversed and complemented."""
    def fix(k, v):
        is_bases = k.isin(TG.COMPLEMENT_WITH_READ)
        is_oq = k == "OQ"
        is_sq = k == "SQ"
        s = F.when(is_bases, BQ.reverse_complement(v.s)).when(is_oq, F.reverse(v.s)).otherwise(v.s)
        ia = F.when(is_sq & v.ia.isNotNull(), F.reverse(F.transform(v.ia, lambda b: BQ.sq_complement(b)))).otherwise(v.ia)
        return v.withField("s", s).withField("ia", ia)
    return F.transform_values(tags, fix)


def _reversed_columns(columns: list[str]) -> dict:
    upd = {"seq": F.when(F.col("seq") == S.NO_SEQ, F.col("seq")).otherwise(BQ.reverse_complement("seq")),
           "qual": F.when(F.col("qual") == S.NO_QUAL, F.col("qual")).otherwise(BQ.reverse_qualities("qual"))}
    if "tags" in columns:
        upd["tags"] = _reverse_tags(F.col("tags"))
    return upd


def reverse_complement_record(reads: DataFrame) -> DataFrame:
    """BQ3: bases, qualities and the per-base tags together."""
    return reads.withColumns(_reversed_columns(reads.columns))


def make_unmapped(reads: DataFrame, condition=None) -> DataFrame:
    """TG9: for rows matching ``condition`` (all rows when None): reverse reads are first
    reverse-complemented and lose the strand bit; duplicate, secondary and proper-pair bits
    are cleared; reference, start, CIGAR, MAPQ and insert size become sentinels; 0x4 set."""
    cond = F.lit(True) if condition is None else condition
    r = reads.withColumn("_mk", cond)
    rev = F.col("_mk") & (F.col("flag").bitwiseAND(S.FLAG_REVERSE) != 0)
    flipped = _reversed_columns(reads.columns)
    r = r.withColumns({c: F.when(rev, e).otherwise(F.col(c)) for c, e in flipped.items()})
    clear = S.FLAG_REVERSE | S.FLAG_DUPLICATE | S.FLAG_SECONDARY | S.FLAG_PROPER_PAIR
    new_flag = F.col("flag").bitwiseAND(F.lit(~clear)).bitwiseOR(F.lit(S.FLAG_UNMAPPED))
    upd = {
        "flag": F.when(F.col("_mk"), new_flag).otherwise(F.col("flag")),
        "ref_index": F.when(F.col("_mk"), F.lit(S.NO_REF_INDEX)).otherwise(F.col("ref_index")),
        "pos": F.when(F.col("_mk"), F.lit(S.NO_START)).otherwise(F.col("pos")),
        "cigar": F.when(F.col("_mk"), F.lit(S.NO_CIGAR)).otherwise(F.col("cigar")),
        "mapq": F.when(F.col("_mk"), F.lit(S.NO_MAPQ)).otherwise(F.col("mapq")),
        "isize": F.when(F.col("_mk"), F.lit(0)).otherwise(F.col("isize")),
    }
    if "ref_name" in reads.columns:
        upd["ref_name"] = F.when(F.col("_mk"), F.lit(S.NO_REF_NAME)).otherwise(F.col("ref_name"))
    return r.withColumns(upd).drop("_mk")


def reindex_bins(reads: DataFrame) -> DataFrame:
    """TG12: overwrite the stored bin with the computed indexing bin (CG15)."""
    return reads.withColumn("bin", B.indexing_bin("flag", "pos", C.parse_cigar("cigar")))


def original_qualities(reads: DataFrame) -> DataFrame:
    """BQ10: ``original_qual`` from the OQ tag (NULL when absent)."""
    return reads.withColumn("original_qual", TG.tag_string("tags", "OQ"))


def set_original_qualities(reads: DataFrame) -> DataFrame:
    """BQ10 setter: keep the current qualities in OQ."""
    return reads.withColumn("tags", TG.set_tag("tags", "OQ", TG.string_tag(F.col("qual"))))
