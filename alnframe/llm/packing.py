"""Best-fit packing under conflicts.

Documents are dealt by hash into groups of a bounded number of words, each packed in one task by best fit decreasing:
bins are kept in order of their residual room, apart by the bitmap of the sources in them, each with a bitmap of the
duplicate clusters in it; the search starts at the first bin with room enough and goes on to its successors until one
has neither the document's source nor its cluster, which is then the tightest compatible bin.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage
from .words import n_words

CAPACITY = 2048
#: Words that a group holds on average, in bins. It bounds a task, not the result: more words make more groups.
GROUP_BINS = 128


def duplicate_cluster(text: Column) -> Column:
    """Texts alike but for case and white space are in one cluster."""
    return F.xxhash64(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")))


class Bins:
    """Open bins by residual room, apart for each set of sources: bins of sets that hold a piece's source are passed
    over all at once, so a source that all bins have costs nothing."""

    def __init__(self):
        self.open: dict[int, list[tuple[int, int]]] = {}  # sources: (room left, bin) in order
        self.filled: list[int] = []
        self.clusters: list[int] = []

    def put(self, size: int, source: int, cluster: int, capacity: int) -> tuple[int, int]:
        """Bin and offset of a piece; source and cluster are bits, 0 for none."""
        best = None
        for sources, order in self.open.items():
            if sources & source:
                continue
            at = bisect_left(order, (size, -1))
            while at < len(order) and (best is None or order[at] < best[0]):
                if not self.clusters[order[at][1]] & cluster:
                    best = order[at], sources
                    break
                at += 1
        if best is None:
            b, sources = len(self.filled), 0
            self.filled.append(0)
            self.clusters.append(0)
        else:
            (_, b), sources = best
            order = self.open[sources]
            del order[bisect_left(order, best[0])]
            if not order:
                del self.open[sources]
        offset = self.filled[b]
        self.filled[b] += size
        self.clusters[b] |= cluster
        if self.filled[b] < capacity:
            insort(self.open.setdefault(sources | source, []), (capacity - self.filled[b], b))
        return b, offset


def pack(docs: DataFrame, size: Column | None = None, cluster: Column | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, source, cluster, piece, bin_id, bin_offset, size): where each piece of each document lies.

    A document over the capacity is cut; full pieces fill a bin each, the rest is packed. No bin holds two pieces of one
    source or of one duplicate cluster. Null sources conflict with nothing. Empty documents take no room and get no row.
    Rows that repeat a doc_id are packed one by one. ``bin_id`` is unique over all groups; reruns agree.
    """
    size = n_words(F.col("text")) if size is None else size
    cluster = duplicate_cluster(F.col("text")) if cluster is None else cluster
    # rows alike in all of this are one with a count, and numbered, so that no group gets all of them
    rows = cut_lineage(docs.select("doc_id", "source", cluster.alias("cluster"), size.cast("long").alias("size")).filter("size > 0")
                       .groupBy("doc_id", "source", "cluster", "size").agg(F.count("*").alias("times")))
    total = rows.agg(F.sum(F.col("size") * F.col("times"))).first()[0] or 0
    groups = max(1, math.ceil(total / (GROUP_BINS * capacity)))
    # the full pieces of a long document come first in their group and find no open bin with so much room
    pieces = (rows.withColumn("time", F.explode(F.expr("sequence(1L, times)"))).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {capacity}"))))
              .withColumn("size", F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity))
              .withColumn("group", F.pmod(F.xxhash64("doc_id", "cluster", "piece", F.when(F.col("time") > 1, F.col("time"))), F.lit(groups))))

    def packed(group: pa.Table) -> pa.Table:
        order = sorted(group.to_pylist(), key=lambda r: (-r["size"], r["doc_id"] is None, r["doc_id"] or 0, r["cluster"], r["source"] or "", r["piece"]))
        times = Counter(r["cluster"] for r in order)
        source_bit, cluster_bit, bins = {None: 0}, {}, Bins()
        for r in order:
            s, c = r["source"], r["cluster"]
            if s not in source_bit:
                source_bit[s] = 1 << len(source_bit)
            bit = cluster_bit.setdefault(c, 1 << len(cluster_bit)) if times[c] > 1 else 0
            b, r["bin_offset"] = bins.put(r["size"], source_bit[s], bit, capacity)
            r["bin_id"] = r["group"] * 2**31 + b
        return pa.Table.from_pylist([{c: r[c] for c in schema.names} for r in order], schema=schema)

    ids = dict(docs.dtypes)["doc_id"]
    result = f"doc_id {ids}, source string, cluster long, piece long, bin_id long, bin_offset long, size long"
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], result).schema)
    return pieces.groupBy("group").applyInArrow(packed, result)
