"""JN1-JN3, JN5, JN7, JN11, JN12: equi joins (range joins live in ``intervals``).

No side gets a broadcast hint unseen, not even a header's table: a transcriptome's dictionary has millions of contigs.
Catalyst's size check picks the strategy, and AQE may still switch at runtime; tables that are written first are counted
(``held``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S


#: Rows up to which a counted table is broadcast.
HELD_ROWS = 100_000


def held(table: DataFrame) -> DataFrame:
    """A written table with narrow rows, to be broadcast if it has few: of its size Catalyst knows nothing, and a join by a
    few regions or groups would shuffle all reads into as many tasks."""
    return F.broadcast(table) if table.count() <= HELD_ROWS else table


def with_ref_index(reads: DataFrame, sequences: DataFrame) -> DataFrame:
    """JN1: reference and mate reference names -> dictionary index; -1 when absent."""
    d = sequences.select(F.col("name").alias("_n"), F.col("seq_index").alias("_i"))
    m = sequences.select(F.col("name").alias("_mn"), F.col("seq_index").alias("_mi"))
    out = (reads.drop("ref_index", "mate_ref_index")
           .join(d, F.col("ref_name") == F.col("_n"), "left")
           .join(m, F.when(F.col("mate_ref_name") == "=", F.col("ref_name"))
                 .otherwise(F.col("mate_ref_name")) == F.col("_mn"), "left"))
    return (out.withColumn("ref_index", F.coalesce(F.col("_i"), F.lit(S.NO_REF_INDEX)).cast("int"))
            .withColumn("mate_ref_index", F.coalesce(F.col("_mi"), F.lit(S.NO_REF_INDEX)).cast("int"))
            .drop("_n", "_i", "_mn", "_mi"))


def with_read_group(reads: DataFrame, read_groups: DataFrame) -> DataFrame:
    """JN2: read-group attributes via the RG tag; NULL columns when the read has no RG."""
    rg = read_groups.select([F.col(c).alias(f"rg_{c}") for c in read_groups.columns])
    tag = F.col("tags").getItem("RG").s
    # No hint: over many files the read groups may be many; Catalyst goes by their size.
    return reads.join(rg, tag == F.col("rg_id"), "left")


def with_mate(reads: DataFrame, key: str = "read_id") -> DataFrame:
    """JN3: attach the mate record of each paired read.

    The mate is the read with the same name, the other end bit, placed at this read's mate
    reference/start (for a mate reference of -1: any unplaced read of that name). The
    candidate side is pre-aggregated per (name, ref, start, end) to one row with a count,
    so a hot name cannot multiply rows. Adds mate_* columns, ``mate_count`` and
    ``mate_error`` (NULL when fine)."""
    f = F.col("flag")
    is_first = f.bitwiseAND(S.FLAG_FIRST) != 0
    is_second = f.bitwiseAND(S.FLAG_SECOND) != 0
    paired = f.bitwiseAND(S.FLAG_PAIRED) != 0
    cand = (reads.filter(paired & (is_first != is_second)).select(
                F.col("read_name").alias("_mname"),
                F.col("ref_index").alias("_mref"),
                F.when(F.col("ref_index") == S.NO_REF_INDEX, F.lit(0)).otherwise(F.col("pos")).alias("_mpos"),
                is_first.alias("_mfirst"),
                F.struct(F.col(key).alias("key"), F.col("flag").alias("flag"), F.col("pos").alias("pos"),
                         F.col("ref_index").alias("ref_index")).alias("_m"))
            .groupBy("_mname", "_mref", "_mpos", "_mfirst")
            .agg(F.count(F.lit(1)).alias("mate_count"), F.min("_m").alias("_m")))
    want_pos = F.when(F.col("mate_ref_index") == S.NO_REF_INDEX, F.lit(0)).otherwise(F.col("mate_pos"))
    j = reads.join(cand, (F.col("read_name") == F.col("_mname")) & (F.col("mate_ref_index") == F.col("_mref"))
                   & (want_pos == F.col("_mpos")) & (F.col("_mfirst") == ~is_first), "left")
    alone = reads.filter(~paired).select(F.col("read_name").alias("_alone")).distinct()
    j = j.join(alone, F.col("read_name") == F.col("_alone"), "left")
    err = (F.when(~paired, F.lit("read is not paired"))
           .when(is_first == is_second, F.lit("both or neither end bits set"))
           .when(F.col("_alone").isNotNull(), F.lit("an unpaired read has the same name"))
           .when(F.col("mate_count") > 1, F.lit("more than one mate")))
    return (j.withColumns({
        "mate_count": F.coalesce(F.col("mate_count"), F.lit(0)).cast("bigint"),
        "mate_key": F.col("_m.key"), "mate_flag": F.col("_m.flag"),
        "mate_error": err,
    }).drop("_mname", "_mref", "_mpos", "_mfirst", "_m", "_alone"))


def assign_partitions(reads: DataFrame, plan: DataFrame, region: str = "region",
                      repartition: bool = True, key: str = "read_id", num_partitions: int | None = None) -> DataFrame:
    """JN5: region -> partition group from a balance plan (AG2; one row per region).

    With ``repartition`` the rows are laid out by range on (partition, ref_index, pos, key):
    each group occupies a contiguous run of tasks in group order, and a large group is
    split over several tasks instead of being funnelled into one task per group (a hash
    repartition on the group id would leave only as many busy tasks as groups)."""
    p = plan.select(F.col(region).alias("_region"), F.col("partition"))
    out = reads.join(p, F.col(region) == F.col("_region")).drop("_region")
    if repartition:
        unique = [key] if key in out.columns else []  # else reads at one position could not be split
        out = out.repartitionByRange(*([num_partitions] if num_partitions else []), "partition", "ref_index", "pos", *unique)
    return out


def exclude_known_sites(observations: DataFrame, known: DataFrame) -> DataFrame:
    """JN7: drop observations at known variant positions (anti join on ref, pos)."""
    return observations.join(known.select("ref_index", "pos"), ["ref_index", "pos"], "left_anti")


def diff_dictionaries(a: DataFrame, b: DataFrame) -> DataFrame:
    """JN11: per index, rows where the dictionaries disagree (missing on one side, length
    differs while both non-zero, MD5 differs when both present, else name differs).
    Empty result = equal dictionaries."""
    aa = a.select(F.col("seq_index"), F.col("name").alias("a_name"), F.col("length").alias("a_length"),
                  F.col("md5").alias("a_md5"))
    bb = b.select(F.col("seq_index"), F.col("name").alias("b_name"), F.col("length").alias("b_length"),
                  F.col("md5").alias("b_md5"))
    j = aa.join(bb, "seq_index", "full_outer")
    both_md5 = F.col("a_md5").isNotNull() & F.col("b_md5").isNotNull()
    # MD5 values compare as hexadecimal numbers: case and leading zeros do not matter.
    md5_a = F.regexp_replace(F.lower(F.col("a_md5")), "^0+", "")
    md5_b = F.regexp_replace(F.lower(F.col("b_md5")), "^0+", "")
    reason = (F.when(F.col("a_name").isNull(), F.lit("missing in first"))
              .when(F.col("b_name").isNull(), F.lit("missing in second"))
              .when((F.col("a_length") != 0) & (F.col("b_length") != 0) & (F.col("a_length") != F.col("b_length")),
                    F.lit("length"))
              .when(both_md5 & (md5_a != md5_b), F.lit("md5"))
              .when(~both_md5 & (F.col("a_name") != F.col("b_name")), F.lit("name")))
    return j.withColumn("difference", reason).filter(F.col("difference").isNotNull())


def chain_program(programs: DataFrame, new_id: str) -> DataFrame:
    """JN12: the previous-program id for a new PG record: the first PG (file order ``ord``)
    with another id that no PG names as its PP. Programs are header-scale."""
    named = programs.select(F.col("previous_id").alias("id")).filter(F.col("id").isNotNull())
    leaves = programs.filter(F.col("id") != new_id).join(named, "id", "left_anti")
    first = leaves.agg(F.min_by("id", "ord").alias("previous_id"))
    return first.select(F.lit(new_id).alias("id"), "previous_id")
