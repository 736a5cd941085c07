"""IO6, presorted mode: reads that are in order already are written as they come, once that is certain, with their header.

The order is checked by block summaries (W4); nothing is written before the check has passed. The header travels as
tables beside the reads, in ``_header``, which readers of the reads pass over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bins as B
from ..functions import cigar as C
from ..operators import windows as WN
from .store import stored

HEADER = "_header"
#: Tables of a header; each is optional.
TABLES = ("sequences", "read_groups", "programs", "comments")
ORDERS = ("coordinate", "queryname", "unsorted")


class OutOfOrder(ValueError):
    """Reads given as sorted are not. ``row``: the first that precedes the one before it, with ``previous_key``."""

    def __init__(self, row):
        super().__init__(f"not in order from this read on: {row.asDict()}")
        self.row = row


def order_key(order: str) -> Column:
    if order == "coordinate":
        return WN.coordinate_sort_key()
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate([F.col("read_name")])])


def first_out_of_order(reads: DataFrame, order: str, record: str, blocks: list[Column]) -> DataFrame:
    """The first read in file order that precedes the one before it; no row if all are in order. ``record`` is the file
    order and ``blocks`` its coarsenings, finest first (see ``check_sorted``)."""
    bad = WN.check_sorted(reads, record, blocks, order_key(order))
    first = F.min_by(F.struct(*bad.columns), F.col(record)).alias("first")
    return bad.agg(first).filter("first IS NOT NULL").select("first.*")


def write_presorted(reads: DataFrame, path: str, header: dict[str, DataFrame], order: str, record: str, blocks: list[Column]) -> None:
    """Writes reads that are in ``order``, or raises OutOfOrder and writes nothing.

    No read is shuffled: a task writes its rows in file order, in coordinate order into a folder per contig. ``order``
    "unsorted" is not checked."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    if order != "unsorted":
        keys = ["ref_index", "pos"] if order == "coordinate" else ["read_name"]
        for row in first_out_of_order(reads.select(record, *keys), order, record, blocks).collect():
            raise OutOfOrder(row)
    r = reads if "bin" in reads.columns else reads.withColumn("bin", B.indexing_bin("flag", "pos", C.parse_cigar("cigar")))
    if order == "coordinate":
        stored(r.sortWithinPartitions("ref_index", record)).partitionBy("ref_index").parquet(path)
    else:
        stored(r.sortWithinPartitions(record) if order == "queryname" else r).parquet(path)
    write_header(path, header, order, reads.sparkSession)


def write_header(path: str, header: dict[str, DataFrame], order: str, spark: SparkSession, version: str = "1.4") -> None:
    """The header of stored reads: a row with version and sort order, and the given tables."""
    if unknown := set(header) - set(TABLES):
        raise ValueError(f"no header tables: {sorted(unknown)}")
    spark.range(1).select(F.lit(version).alias("version"), F.lit(order).alias("sort_order"),
                          F.array(*map(F.lit, sorted(header))).cast("array<string>").alias("tables")).write.mode("overwrite").parquet(f"{path}/{HEADER}/hd")
    for name, table in header.items():
        table.write.mode("overwrite").parquet(f"{path}/{HEADER}/{name}")


def read_stored_header(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """``hd`` and the tables stored with the reads."""
    hd = spark.read.parquet(f"{path}/{HEADER}/hd")
    return {"hd": hd} | {t: spark.read.parquet(f"{path}/{HEADER}/{t}") for t in hd.first()["tables"]}
