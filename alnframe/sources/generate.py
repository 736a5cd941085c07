"""FX1: generated reads for tests (never registered as a query: queries read the driver
tables). ``spark.range`` plus hash expressions, so generation itself is distributed and
deterministic for a seed: 25 contigs (chrM, chr1..chr22, chrX, chrY) of 1,000,000 bases,
36-base reads, base qualities 0..49, fragments, pairs and unmapped reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.tags import empty_tags
from .adapter import contig_name

READ_LENGTH = 36
# Quality alphabet for phred 0..45 in steps of 3 (16 symbols, one per hex digit).
_QUAL_TO = "".join(chr(33 + 3 * i) for i in range(16))


def make_reads(spark: SparkSession, n: int, seed: int = 0, num_partitions: int | None = None) -> DataFrame:
    """``n`` records: ~10% unmapped, ~45% fragments, ~45% first/second ends of pairs."""
    parts = num_partitions or spark.sparkContext.defaultParallelism
    g = spark.range(0, n, numPartitions=parts)
    h = lambda salt: F.abs(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)))
    kind = h(1) % 20
    unmapped = kind < 2
    paired = kind >= 11
    first = kind % 2 == 0
    rev = h(2) % 2 == 1
    ref = (h(3) % 25).cast("int")
    pos = (1 + h(4) % (S.ADAPTER_CONTIG_LENGTH - READ_LENGTH)).cast("int")
    mate_pos = F.least(pos + 200 + (h(5) % 300).cast("int"), F.lit(S.ADAPTER_CONTIG_LENGTH - READ_LENGTH)).cast("int")
    flag = (F.when(unmapped, F.lit(S.FLAG_UNMAPPED)).otherwise(F.lit(0))
            + F.when(rev & ~unmapped, F.lit(S.FLAG_REVERSE)).otherwise(F.lit(0))
            + F.when(paired, F.lit(S.FLAG_PAIRED | S.FLAG_PROPER_PAIR)
                     + F.when(first, F.lit(S.FLAG_FIRST)).otherwise(F.lit(S.FLAG_SECOND))).otherwise(F.lit(0)))
    key = F.concat(F.lit(f"g{seed}:"), F.col("id").cast("string"))
    seq = F.translate(F.substring(F.concat(F.md5(F.concat(key, F.lit("s1"))), F.md5(F.concat(key, F.lit("s2")))),
                                  1, READ_LENGTH), "0123456789abcdef", "ACGTACGTACGTACGT")
    qual = F.translate(F.substring(F.concat(F.md5(F.concat(key, F.lit("q1"))), F.md5(F.concat(key, F.lit("q2")))),
                                   1, READ_LENGTH), "0123456789abcdef", _QUAL_TO)
    return g.select(
        F.concat(F.lit("read"), (F.col("id") / 2).cast("long").cast("string")).alias("read_name"),
        flag.cast("int").alias("flag"),
        F.when(unmapped, F.lit(S.NO_REF_NAME)).otherwise(contig_name(ref)).alias("ref_name"),
        F.when(unmapped, F.lit(S.NO_REF_INDEX)).otherwise(ref).alias("ref_index"),
        F.when(unmapped, F.lit(S.NO_START)).otherwise(pos).alias("pos"),
        F.when(unmapped, F.lit(0)).otherwise((h(6) % 60).cast("int")).alias("mapq"),
        F.when(unmapped, F.lit(S.NO_CIGAR)).otherwise(F.lit(f"{READ_LENGTH}M")).alias("cigar"),
        F.when(paired & ~unmapped, contig_name(ref)).otherwise(F.lit(S.NO_REF_NAME)).alias("mate_ref_name"),
        F.when(paired & ~unmapped, ref).otherwise(F.lit(S.NO_REF_INDEX)).alias("mate_ref_index"),
        F.when(paired & ~unmapped, mate_pos).otherwise(F.lit(0)).alias("mate_pos"),
        F.when(paired & ~unmapped, mate_pos - pos + READ_LENGTH).otherwise(F.lit(0)).cast("int").alias("isize"),
        seq.alias("seq"), qual.alias("qual"), empty_tags().alias("tags"),
        key.alias("read_id"), F.col("id").alias("record_no"), F.lit("generated").alias("source"))
