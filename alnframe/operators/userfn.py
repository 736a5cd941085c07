"""UD1: a user's function over reads, in Arrow batches.

``map_reads`` runs it on every batch of a partition, with state that is made once a partition. ``map_groups`` runs it on
groups; a group larger than a task should hold is split into parts of bounded size, whose results a second function
merges, so a hot contig is as many tasks as its size needs.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_PER_PART = 200_000


def _schema(df: DataFrame, schema: str | StructType) -> pa.Schema:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return to_arrow_schema(schema)


def _cast(table: pa.Table | pa.RecordBatch, fields: pa.Schema) -> pa.Table:
    """The declared columns in their order and types; a missing column is an error that names it."""
    table = pa.Table.from_batches([table]) if isinstance(table, pa.RecordBatch) else table
    if missing := [f.name for f in fields if f.name not in table.schema.names]:
        raise ValueError(f"the function's result lacks {missing}")
    return pa.Table.from_arrays([table.column(f.name).cast(f.type) for f in fields], schema=fields)


def map_reads(reads: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | Iterable]], schema: str | StructType,
              columns: list[str] | None = None) -> DataFrame:
    """``make()`` runs once in every task and returns a function from a batch of reads (of ``columns``, all by default)
    to a batch or table of ``schema``, or several. What the function keeps between batches is the partition's state."""
    fields = _schema(reads, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            got = step(batch)
            for table in [got] if isinstance(got, (pa.RecordBatch, pa.Table)) else got:
                yield from _cast(table, fields).to_batches()

    return (reads.select(*columns) if columns else reads).mapInArrow(run, schema)


def map_groups(reads: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table], merge: Callable[[pa.Table], pa.Table],
               partial_schema: str | StructType, schema: str | StructType, spread: str = "read_id", rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``function`` on the reads of each group of ``keys``, or of each part of a larger group, then ``merge`` on the
    results of a group's parts (also where there is one). Both schemas hold the keys; ``merge`` must not depend on the
    order of the parts.

    Groups are counted first, partly summed; reads of a group of n rows are dealt by the hash of ``spread`` over
    n / rows_per_part parts."""
    partial, final = _schema(reads, partial_schema), _schema(reads, schema)
    counts = reads.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_part).cast("int").alias("_parts"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    dealt = reads.join(counts.withColumnsRenamed({k: f"_g_{k}" for k in keys}), same).drop(*[f"_g_{k}" for k in keys])
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(spread), F.col("_parts"))).drop("_parts")
    parts = dealt.groupBy(*keys, "_part").applyInArrow(lambda t: _cast(function(t.drop_columns(["_part"])), partial), partial_schema)
    return parts.groupBy(*keys).applyInArrow(lambda t: _cast(merge(t), final), schema)


# What runs inside tasks travels whole, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
