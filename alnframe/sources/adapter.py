"""Adapter views that present the driver's TPC-H-style tables as alignment data.

``reads`` derives one aligned read per lineitem row, ``targets`` one target interval per
order, ``pairs`` a paired-end record set per order, ``known_sites`` known variant
positions per part. The sequence dictionary (25 contigs) and the reference bases are
defined by rule. Every column is a Catalyst expression, so the scans keep column pruning
and the views compose into one plan with whatever operator runs on top.
"""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.tags import empty_tags

BASE_ALPHABET = ("0123456789abcdef", "ACGTACGTACGTACGN")
QUAL_ALPHABET = ("0123456789abcdef", "#%&(+-/13579;=?A")
REFERENCE_CHUNK = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core.

    A big input already arrives in many splits and is returned unchanged (no shuffle). A
    file with a single row group is one split however many rows it has, and would run the
    whole per-read expansion (bases, pieces, explodes) in one task; such a scan is spread
    round-robin over the cores. Spark sorts before a round-robin exchange, so a retried task
    gets the same rows."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):  # a session without RDD access (Spark Connect)
        return df
    return df.repartition(want) if have < want else df


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _hex100(k: Column, salts: str) -> Column:
    return F.substring(F.concat(*[F.md5(F.concat(k, F.lit(s))) for s in salts]), 1, 100)


def contig_name(ref_index) -> Column:
    """chrM for 0, chr1..chr22, chrX (23), chrY (24), ``*`` otherwise."""
    r = F.col(ref_index) if isinstance(ref_index, str) else ref_index
    return (F.when(r == 0, F.lit("chrM"))
            .when(r.between(1, 22), F.concat(F.lit("chr"), r.cast("string")))
            .when(r == 23, F.lit("chrX"))
            .when(r == 24, F.lit("chrY"))
            .otherwise(F.lit(S.NO_REF_NAME)))


def sequences(spark: SparkSession) -> DataFrame:
    """Sequence dictionary of the adapter reads: 25 contigs of 1,000,000 bases (constant size)."""
    return (spark.range(0, len(S.adapter_contig_names()), numPartitions=1)
            .select(F.col("id").cast("int").alias("seq_index"))
            .select("seq_index", contig_name("seq_index").alias("name"),
                    F.lit(S.ADAPTER_CONTIG_LENGTH).alias("length"),
                    F.lit(None).cast("string").alias("md5"), F.lit(None).cast("string").alias("uri"),
                    F.lit(None).cast("string").alias("assembly"), F.lit(None).cast("string").alias("species")))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read per lineitem row in the canonical alignments schema plus ``read_id``."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"))
    k = F.concat(_s("l_orderkey"), F.lit("|"), _s("l_linenumber"), F.lit("|"), _s("l_partkey"), F.lit("|"),
                 _s("l_suppkey"))
    flag = (F.lit(3)
            + F.when(F.col("l_linenumber") % 2 == 1, 64).otherwise(128)
            + F.when(F.col("l_returnflag") == "R", 16).otherwise(0)
            + F.when(F.col("l_linestatus") == "O", 32).otherwise(0)
            + F.when(F.col("l_partkey") % 17 == 0, 4).otherwise(0)
            + F.when(F.col("l_partkey") % 23 == 0, 256).otherwise(0))
    m = F.col("l_linenumber") % 7
    cigar = (F.when(m == 0, "5S95M").when(m == 1, "100M").when(m == 2, "50M2I48M").when(m == 3, "40M3D60M")
             .when(m == 4, "3H10S80M10S").when(m == 5, "30M200N70M").otherwise("20M1I20M2D59M"))
    ref_index = (F.col("l_suppkey") % 25).cast("int")
    return li.select(
        F.concat(F.lit("r"), _s("l_orderkey")).alias("read_name"),
        flag.cast("int").alias("flag"),
        contig_name(ref_index).alias("ref_name"),
        ref_index.alias("ref_index"),
        (1 + (F.col("l_partkey") * 7919 + F.col("l_orderkey") * 31) % 1000000).cast("int").alias("pos"),
        F.col("l_quantity").cast("int").alias("mapq"),
        cigar.alias("cigar"),
        F.lit(S.NO_REF_NAME).alias("mate_ref_name"),
        F.lit(S.NO_REF_INDEX).alias("mate_ref_index"),
        F.lit(S.NO_START).alias("mate_pos"),
        F.lit(0).alias("isize"),
        F.translate(_hex100(k, "abcd"), *BASE_ALPHABET).alias("seq"),
        F.translate(_hex100(k, "efgh"), *QUAL_ALPHABET).alias("qual"),
        empty_tags().alias("tags"),
        k.alias("read_id"),
        F.lit("lineitem").alias("source"),
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 500-base target per order; ``s``/``e`` are 1-based inclusive."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    h = (F.col("o_orderkey") * 104729) % 1000000
    return o.select((F.col("o_custkey") % 25).cast("int").alias("ref_index"),
                    (1 + h).cast("int").alias("s"), (500 + h).cast("int").alias("e"),
                    F.col("o_orderkey").alias("target_id"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paired reads: first ends for every order, second ends for orders not divisible by 11."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    name = F.concat(F.lit("p"), _s("o_orderkey"))
    ref = (F.col("o_custkey") % 25).cast("int")
    a = (1 + (F.col("o_orderkey") * 104729) % 900000).cast("int")
    b = (151 + (F.col("o_orderkey") * 104729) % 900000 + F.col("o_custkey") % 200).cast("int")
    first = o.select(name.alias("read_name"), F.lit(99).alias("flag"), ref.alias("ref_index"), a.alias("pos"),
                     ref.alias("mate_ref_index"), b.alias("mate_pos"))
    second = (o.filter(F.col("o_orderkey") % 11 != 0)
              .select(name.alias("read_name"), F.lit(147).alias("flag"), ref.alias("ref_index"), b.alias("pos"),
                      ref.alias("mate_ref_index"), a.alias("mate_pos")))
    return first.unionByName(second)


def known_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return p.select((F.col("p_size") % 25).cast("int").alias("ref_index"),
                    (1 + (F.col("p_partkey") * 7919) % 1000000).cast("int").alias("pos")).distinct()


def reference_chunk_bases(ref_index, chunk) -> Column:
    """Bases of 32-base reference chunk ``chunk`` (0-based) of contig ``ref_index``."""
    r = F.col(ref_index) if isinstance(ref_index, str) else ref_index
    c = F.col(chunk) if isinstance(chunk, str) else chunk
    return F.translate(F.md5(F.concat(r.cast("string"), F.lit("|"), c.cast("string"))), *BASE_ALPHABET)


def reference_chunks(spark: SparkSession, num_partitions: int | None = None, chunk: int = REFERENCE_CHUNK) -> DataFrame:
    """The adapter genome as (ref_index, chunk, chunk_start, bases): 25 x 31,250 rows of 32 bases, or fewer of
    ``chunk`` bases, a multiple of 32.

    Stands in for a FASTA loaded into a table; joined to reads by (ref_index, chunk).
    """
    rule, each = (S.ADAPTER_CONTIG_LENGTH + REFERENCE_CHUNK - 1) // REFERENCE_CHUNK, chunk // REFERENCE_CHUNK
    per_contig = (rule + each - 1) // each
    n = len(S.adapter_contig_names()) * per_contig
    if num_partitions is None:
        try:
            num_partitions = spark.sparkContext.defaultParallelism
        except Exception:  # noqa: BLE001  (no SparkContext in a Connect session)
            num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, num_partitions)
    g = spark.range(0, n, numPartitions=parts)
    return g.select((F.col("id") / per_contig).cast("int").alias("ref_index"),
                    (F.col("id") % per_contig).cast("int").alias("chunk")).select(
        "ref_index", "chunk", (F.col("chunk") * chunk + 1).alias("chunk_start"),
        (reference_chunk_bases("ref_index", "chunk") if each == 1 else F.array_join(F.transform(
            F.sequence(F.col("chunk") * each, F.least((F.col("chunk") + 1) * each, F.lit(rule)) - 1),
            lambda c: reference_chunk_bases("ref_index", c)), "")).alias("bases"))
