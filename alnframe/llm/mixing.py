"""Mixing sources to target weights: tokens per source, a repetition rate per source, whole copies plus one seeded draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Up to so many sources their rates (a name and two numbers each) are broadcast; beyond, they are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, size).

    Sources by code point, null last, take the weights in turn. All sizes together are shared by weight; a target stops
    at ``most`` times its source's size and what is over is shared again by weight among the rest, until none is above.
    Each round is an aggregate; the driver sees two sums. A source of size 0 has target 0. No rows: no sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # numbered in order: a range sort, then each partition adds the rows of those before it
    ordered = cut_lineage(totals.orderBy(F.col("source").asc_nulls_last())
                          .withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    before = (ordered.groupBy("_p").agg(F.count("*").alias("_n"))  # a row for each partition
              .withColumn("_before", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))))
    place = F.coalesce("_before", F.lit(0)) + F.row_number().over(Window.partitionBy("_p").orderBy("_i")) - 1
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (place % len(weights)).cast("int"))
    table = cut_lineage(ordered.join(before, "_p").select("source", "source_size", weight.alias("weight")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, share = -1.0, 0.0
    cap = F.col("source_size") * most
    while level < share:  # share: words for a weight of 1 among the sources below their cap
        level = share
        full = F.col("weight") * F.lit(level) >= cap
        row = table.agg(F.sum(F.when(full, cap).otherwise(0)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if not row["w"]:
            break
        share = (total - row["full"]) / row["w"]
    below = F.col("weight") * F.lit(share)
    return table.withColumn("target", F.when(below >= cap, cap.cast("double")).otherwise(below))


def draw(doc_id: Column, seed: str, text: Column | None = None) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone, on the text where the id is null: 52 bits of an MD5
    hash."""
    nameless = F.lit("null") if text is None else F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), nameless))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix(docs: DataFrame, size: Column, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``: how often the mix takes the document.

    A source's rate is target / source_size. Each document is taken floor(rate) times, and once more if its draw is
    below the fraction, so a source's taken size has its target as expectation. Rows that repeat a doc_id draw alike;
    rows without one draw by their ``text``, if there is such a column. Documents of size 0 in a source of size 0 have
    rate 0. Columns named size, source_size, target or copies are replaced; others stay, whatever their names.
    """
    whole = _mixed(docs, size, weights, most, seed)
    own = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies")]
    return whole.select(*[F.col("row")[c].alias(c) for c in own], "size", "source_size", "target", "copies")


def _mixed(docs: DataFrame, size: Column, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """(row, size, source_size, target, copies): the rows of ``docs`` as structs, so that no name of theirs can clash."""
    text = F.col("text").cast("string") if "text" in docs.columns else None
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("source").alias("source"), size.alias("size"), draw(F.col("doc_id"), seed, text).alias("draw"))
    targets = source_targets(rows.select("source", "size"), weights, most).drop("weight")
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    targets = targets.withColumnRenamed("source", "of")
    joined = rows.join(F.broadcast(targets) if few else targets, F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    more = F.when(F.col("draw") < rate - F.floor(rate), 1).otherwise(0)
    return joined.select("row", "size", "source_size", "target", (F.floor(rate) + more).alias("copies"))


def mixed_rows(docs: DataFrame, size: Column, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs`` as they are."""
    taken = _mixed(docs, size, **how).select("row", F.explode(F.expr("IF(copies > 0, sequence(1L, copies), array())")).alias("copy"))
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns])
