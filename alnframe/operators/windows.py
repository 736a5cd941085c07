"""Duplicate marking, sort-order checking, sequence indexes, region encoding.

None of these sorts a whole group in one task. Duplicate marking finds each key's best
read with a partial-aggregated ``min(struct)``; sort checking compares neighbours inside
blocks of the file order and stitches block boundaries through a per-block summary; the
region encoding takes each group's first read with ``min_by``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import bases as BQ
from ..functions import cigar as C
from ..session import cut_lineage
from .joins import held


def duplicate_score(qual) -> Column:
    """Sum of base qualities >= 15 (FASTQ text): lower ones are dropped, the rest are summed as characters."""
    q = F.col(qual) if isinstance(qual, str) else qual
    high = F.regexp_replace(q, rf"[\x00-\x{33 + S.DUP_MIN_BASE_QUAL - 1:02x}]", "")
    return F.aggregate(F.split(high, ""), F.lit(0).cast("bigint"), lambda a, c: a + F.ascii(c)) - 33 * F.length(high).cast("bigint")


def five_prime(flag, pos, ops) -> Column:
    """Unclipped 5' position: unclipped start forward, unclipped end reverse."""
    rev = F.col(flag).bitwiseAND(S.FLAG_REVERSE) != 0 if isinstance(flag, str) else flag.bitwiseAND(S.FLAG_REVERSE) != 0
    return F.when(rev, C.unclipped_end(flag, pos, ops)).otherwise(C.unclipped_start(pos, ops))


DUP_KEY = ["library", "ref_index", "five_prime", "strand", "mate_ref_index", "mate_pos"]


#: A Bloom filter block: 64 words of 64 bits; a key sets this many bits in one block.
_WORDS, _BITS = 64, 5
#: Blocks at most (64 MB); with more keys the filter lets more single reads through, at the price of shuffling them.
MAX_BLOCKS = 1 << 17


def _bloom_bits(h: Column) -> list[tuple[Column, Column]]:
    """(word, bit) of each bit of a key's hash; other bits of the hash choose the block."""
    return [(F.shiftrightunsigned(h, 12 * b).bitwiseAND(63).cast("int"), F.shiftrightunsigned(h, 12 * b + 6).bitwiseAND(63).cast("int")) for b in range(_BITS)]


def key_filter(hashes: DataFrame, n: int, h: str = "h", max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of the 64-bit hashes as rows (block, words), with its number of blocks: 16 bits a key."""
    blocks = 1
    while blocks < max_blocks and blocks * _WORDS * 64 < 16 * n:
        blocks *= 2
    bits = hashes.select(key_block(F.col(h), blocks).alias("block"), F.inline(F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in _bloom_bits(F.col(h))])))
    # one shift for each value of b: the shift's distance has to be a constant
    word = F.lit(0).cast("long")
    for b in range(64):
        word = F.when(F.col("b") == b, F.lit(-(1 << 63) if b == 63 else 1 << b)).otherwise(word)
    words = bits.groupBy("block", "w").agg(F.bit_or(word).alias("bits")).groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
    return words.select("block", F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0).cast("long"))).alias("words")), blocks


def key_block(h: Column, blocks: int) -> Column:
    """The block of a key filter in which a hash has its bits."""
    return F.pmod(F.xxhash64(h), F.lit(blocks)).cast("int")


def may_hold(words: Column, h: Column) -> Column:
    """Whether a block's words hold all bits of a hash; false without a block."""
    held = F.lit(True)
    for w, b in _bloom_bits(h):
        held = held & (F.call_function("getbit", F.get(words, w), b) == 1)
    return F.coalesce(held, F.lit(False))


def mark_duplicates(reads: DataFrame, key: str = "read_id", library: Column | None = None) -> DataFrame:
    """Flag 0x400 on every read of a duplicate key except the best one.

    Key: (library, contig, unclipped 5' position, strand, mate contig, mate start). Best =
    highest sum of qualities >= 15, then smallest read name, then smallest ``key``.
    Unmapped and secondary reads are never marked and do not compete. Adds
    ``is_duplicate`` and rewrites ``flag``.

    Hashes of the keys are counted first, 16 bytes a read and partly summed. Those that occur twice or more go into a
    Bloom filter of bounded size, which is broadcast. Reads that it doesn't hold, and those that don't compete, are
    alone on their key and go through where they are; only the others are shuffled, to meet the best of their key. The
    counted hashes are checkpointed, as their number sizes the filter.
    """
    lib = library if library is not None else (F.col("library") if "library" in reads.columns else F.lit(""))
    ops = F.col("_ops")  # a column, as several lengths are taken from it
    eligible = ((F.col("flag").bitwiseAND(S.FLAG_UNMAPPED) == 0)
                & (F.col("flag").bitwiseAND(S.FLAG_SECONDARY) == 0))
    r = reads.withColumn("_ops", C.parse_cigar("cigar")).withColumns({
        "library": F.coalesce(lib, F.lit("")),
        "five_prime": five_prime("flag", "pos", ops),
        "strand": (F.col("flag").bitwiseAND(S.FLAG_REVERSE) != 0),
        "_eligible": eligible,
    }).drop("_ops").withColumn("_h", F.xxhash64(*DUP_KEY))
    repeated = cut_lineage(r.filter("_eligible").groupBy("_h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("_h").alias("h")))
    blocks, n_blocks = key_filter(repeated, repeated.count())
    # as long as its blocks, 64 MB at most
    r = r.join(F.broadcast(blocks.withColumnsRenamed({"block": "_block", "words": "_words"})), key_block(F.col("_h"), n_blocks) == F.col("_block"), "left")
    r = r.withColumn("_meets", F.col("_eligible") & may_hold(F.col("_words"), F.col("_h"))).drop("_block", "_words", "_h")
    meeting = r.filter("_meets")
    scored = meeting.select(*DUP_KEY, key, "read_name", duplicate_score("qual").alias("_score"))
    # min over (-score, name, key) = the best read; partial aggregation keeps hot keys cheap.
    best = (scored.groupBy(*DUP_KEY)
            .agg(F.min(F.struct((-F.col("_score")).alias("neg_score"), F.col("read_name").alias("name"),
                                F.col(key).alias("k"))).alias("_best"))
            .select(*DUP_KEY, F.col("_best.k").alias("_best_key")))
    # dealt out anew, so that the join has exchanges on both sides and adaptive execution can split a hot key
    joined = meeting.join(best.hint("rebalance"), DUP_KEY, "left")
    dup = F.col("_best_key").isNotNull() & (F.col(key) != F.col("_best_key"))
    marked = (joined.withColumn("is_duplicate", dup)
              .withColumn("flag", F.when(dup, F.col("flag").bitwiseOR(S.FLAG_DUPLICATE)).otherwise(F.col("flag"))))
    alone = r.filter("NOT _meets").withColumn("is_duplicate", F.lit(False))
    return marked.drop("_best_key").unionByName(alone).drop("_eligible", "_meets")


def coordinate_sort_key(ref_index="ref_index", pos="pos") -> Column:
    """Coordinate order key: unplaced reads (ref -1) last."""
    r = F.col(ref_index)
    return F.struct(F.when(r == S.NO_REF_INDEX, F.lit(1)).otherwise(F.lit(0)).alias("unplaced"),
                    r.alias("ref"), F.col(pos).alias("pos"))


def check_sorted(reads: DataFrame, order_key: str, blocks: Column | list[Column], sort_key: Column) -> DataFrame:
    """Rows whose ``sort_key`` precedes the previous row's in file order.

    ``order_key`` is the file order (unique). ``blocks`` are non-decreasing coarsenings of it, finest first, each a
    coarsening of the one before. Neighbours are compared inside the finest blocks in parallel; the first row of a block
    is compared with the last row of the block before, found in the same way among one summary row per block inside the
    next coarser blocks. So a task holds the rows of one block, or the summaries of one coarser block; only the summaries
    of the coarsest blocks meet in one task, and the caller picks those so that they are few at any size. Returns the
    offending rows with their previous key."""
    levels = blocks if isinstance(blocks, list) else [blocks]
    names = [f"_blk{i}" for i in range(len(levels))]
    # one exchange of the rows as they come; blocks and keys are computed behind it, for the neighbours and for the summaries
    rows = reads.repartition(levels[0]).withColumns({**dict(zip(names, levels, strict=True)), "_sk": sort_key})
    prev = _with_previous(rows, order_key, names)
    return (prev.filter(F.col("_prev").isNotNull() & (F.col("_sk") < F.col("_prev")))
            .withColumn("previous_key", F.col("_prev")).drop(*names, "_prev"))


def _with_previous(rows: DataFrame, order: str, names: list[str]) -> DataFrame:
    """``rows`` with ``_prev``, the ``_sk`` of the row before in ``order``; ``names`` are its block columns, finest first."""
    if not names:
        return rows.withColumn("_prev", F.lag("_sk").over(Window.orderBy(order)))
    block = names[0]
    inner = rows.withColumn("_prev", F.lag("_sk").over(Window.partitionBy(block).orderBy(order)))
    # ``order`` is part of the summary only as the last row's; a finer block lies in one coarser block.
    last = rows.groupBy(*names).agg(F.max_by("_sk", F.col(order)).alias("_sk"))
    before = _with_previous(last, block, names[1:]).select(block, F.col("_prev").alias("_prev_block"))
    return (inner.join(before, block, "left").withColumn("_prev", F.coalesce("_prev", "_prev_block")).drop("_prev_block"))


def assign_sequence_index(sequences: DataFrame, order: str = "line_no") -> DataFrame:
    """0-based index in dictionary order; ``duplicate_name`` marks a repeated name.
    A dictionary is small (one row per contig), so a single ordered window is fine here."""
    w = Window.orderBy(order)
    return (sequences.withColumn("seq_index", (F.row_number().over(w) - 1).cast("int"))
            .withColumn("duplicate_name", F.count(F.lit(1)).over(Window.partitionBy("name")) > 1))


def _encoding_of(first_qual) -> Column:
    return (F.when(BQ.max_phred(first_qual) <= BQ.SANGER_MAX_QUAL, F.lit("SANGER"))
            .otherwise(F.lit("ILLUMINA")))


def apply_group_encoding(reads: DataFrame, encodings: DataFrame, group: str = "partition") -> DataFrame:
    """Apply a per-group encoding (one row per group): ILLUMINA groups get
    BQ12-fixed qualities and a ``quality_error`` flag when a score would go negative."""
    r = reads.join(encodings.select(group, "encoding"), group)
    ill = F.col("encoding") == "ILLUMINA"
    return r.withColumns({
        "quality_error": ill & BQ.illumina_fix_error("qual"),
        "qual": F.when(ill, BQ.fix_illumina_quals("qual")).otherwise(F.col("qual")),
    })


def region_quality_encoding(reads: DataFrame, group: str = "partition", key: str = "read_id") -> DataFrame:
    """The encoding guessed from the first read (ref, pos, key order) of each group,
    applied to all reads of the group, where they are if the groups, which are written, are few."""
    # Carry only the first read's quality string through the aggregate; its largest score
    # is computed once per group afterwards, not for every read.
    first = (reads.groupBy(group)
             .agg(F.min_by("qual", F.struct("ref_index", "pos", key)).alias("_first_qual")))
    enc = first.select(group, _encoding_of(F.col("_first_qual")).alias("encoding"))
    return apply_group_encoding(reads, held(cut_lineage(enc)), group)


def group_encodings(plan: DataFrame, region_firsts: DataFrame, group: str = "partition") -> DataFrame:
    """W7 from per-region first reads (``region``, ``_first`` = min struct(ref_index, pos,
    key, qual)) and a region -> group plan: the group's first read is the smallest of its
    regions' first reads. Both inputs have one row per region, so no pass over the reads."""
    g = plan.select("region", group).join(region_firsts.select("region", "_first"), "region")
    first = g.groupBy(group).agg(F.min("_first").alias("_first"))
    return first.select(group, _encoding_of(F.col("_first.qual")).alias("encoding"))
