"""Queries for presorted writing and stored headers (IO6), long limits (IO11) and user functions (UD1)."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from ..operators import userfn as UF
from ..session import shared_dir
from ..sources import adapter as A
from ..sources import ordered as OR
from ..sources import sam as SAM
from .catalog import register
from .oracle_views import READS, SEQUENCES, with_views
from .q_joins import read_groups_from_nations

# --------------------------------------------------------------------------- IO6

_STORED = ["read_id", "read_name", "ref_index", "pos", "flag", "cigar", "seq", "qual"]


def _in_file_order(spark, sf_dir):
    """Reads with a record key in coordinate order, as a sorted file has them."""
    r = A.reads(spark, sf_dir).select(*_STORED)
    return r.withColumn("record", F.concat(F.lpad((F.col("ref_index") + 1).cast("string"), 3, "0"), F.lpad(F.col("pos").cast("string"), 9, "0"), "read_id"))


def _header(spark, sf_dir):
    return {"sequences": A.sequences(spark), "read_groups": read_groups_from_nations(spark, sf_dir)}


_PRESORTED_SQL = with_views(READS) + """,
k AS (SELECT read_id, ref_index, pos, CASE WHEN ref_index = -1 THEN 1 ELSE 0 END AS u FROM reads),
l AS (SELECT *, lag(u) OVER (ORDER BY read_id) AS pu, lag(ref_index) OVER (ORDER BY read_id) AS pr, lag(pos) OVER (ORDER BY read_id) AS pp FROM k),
bad AS (SELECT read_id, ref_index, pos FROM l
        WHERE pu IS NOT NULL AND (u < pu OR (u = pu AND (ref_index < pr OR (ref_index = pr AND pos < pp)))) ORDER BY read_id LIMIT 1)
SELECT 'written' AS outcome, read_id, ref_index, pos FROM reads
UNION ALL SELECT 'refused', read_id, ref_index, pos FROM bad
"""


@register("presorted_store", _PRESORTED_SQL)
def presorted_store(spark, sf_dir):
    """Reads in coordinate order are written as they come and read back; the same reads by key are refused, with the
    first that is out of order."""
    path = shared_dir(spark, "presorted")
    blocks = [F.substring("record", 1, 8), F.substring("record", 1, 3)]
    OR.write_presorted(_in_file_order(spark, sf_dir), path, _header(spark, sf_dir), "coordinate", "record", blocks)
    back = spark.read.parquet(path).select(F.lit("written").alias("outcome"), "read_id", F.col("ref_index").cast("int").alias("ref_index"), "pos")
    blocks = [F.substring("read_id", 1, 6), F.substring("read_id", 1, 3)]
    try:
        OR.write_presorted(A.reads(spark, sf_dir).select(*_STORED), f"{path}-by-key", _header(spark, sf_dir), "coordinate", "read_id", blocks)
    except OR.OutOfOrder as refused:
        first = spark.createDataFrame([("refused", refused.row.read_id, refused.row.ref_index, refused.row.pos)], back.schema)
        return back.unionByName(first)
    return back


_STORED_HEADER_SQL = with_views(SEQUENCES) + """
SELECT 'sequence' AS kind, name AS id, CAST(length AS VARCHAR) AS value, 'coordinate' AS sort_order FROM sequences
UNION ALL SELECT 'read group', 'rg' || CAST(n_nationkey AS VARCHAR), n_name, 'coordinate' FROM nation
"""


@register("stored_header", _STORED_HEADER_SQL)
def stored_header(spark, sf_dir):
    """The header tables read back from beside stored reads."""
    path = shared_dir(spark, "with-header")
    blocks = [F.substring("record", 1, 8), F.substring("record", 1, 3)]
    OR.write_presorted(_in_file_order(spark, sf_dir), path, _header(spark, sf_dir), "coordinate", "record", blocks)
    h = OR.read_stored_header(spark, path)
    rows = h["sequences"].select(F.lit("sequence").alias("kind"), F.col("name").alias("id"), F.col("length").cast("string").alias("value")).unionByName(
        h["read_groups"].select(F.lit("read group").alias("kind"), "id", F.col("sample").alias("value")))
    return rows.withColumn("sort_order", h["hd"].select("sort_order").scalar())


# --------------------------------------------------------------------------- IO11

_HALF_SQL = with_views(READS) + """,
n AS (SELECT *, row_number() OVER (ORDER BY read_id) AS k, count(*) OVER () AS n FROM reads)
SELECT read_id, ref_index, pos FROM n WHERE k <= n // 2
"""


@register("limit_half", _HALF_SQL)
def limit_half(spark, sf_dir):
    """IO11: the first half of the records in file order (here that of read_id)."""
    reads = A.reads(spark, sf_dir).select("read_id", "ref_index", "pos")
    blocks = [F.substring("read_id", 1, 6), F.substring("read_id", 1, 3)]
    return SAM.first_records(reads, reads.count() // 2, "read_id", blocks)


# --------------------------------------------------------------------------- UD1

_RUNS = "list_max(list_transform(regexp_extract_all(seq, 'A+|C+|G+|T+|N+'), lambda x: length(x)))"

_MAP_SQL = with_views(READS) + f"""
SELECT read_id, CAST({_RUNS} AS INTEGER) AS longest_run, CAST(length(regexp_replace(seq, '[^CG]', '', 'g')) AS INTEGER) AS n_gc FROM reads
"""


def _longest_run():
    """A user's function with state: the runs of a sequence, and a count of what it has seen."""
    import re

    runs = re.compile("A+|C+|G+|T+|N+").findall
    seen = {"batches": 0}

    def step(batch):
        import pyarrow as pa

        seen["batches"] += 1
        seqs = batch.column("seq").to_pylist()
        return pa.table({"read_id": batch.column("read_id"), "longest_run": [max(map(len, runs(s)), default=0) for s in seqs],
                         "n_gc": [s.count("G") + s.count("C") for s in seqs]})

    return step


@register("user_function", _MAP_SQL)
def user_function(spark, sf_dir):
    """UD1 over every read."""
    return UF.map_reads(A.reads(spark, sf_dir), _longest_run, "read_id string, longest_run int, n_gc int", ["read_id", "seq"])


_GROUP_SQL = with_views(READS) + f"""
SELECT ref_index, count(*) AS n_reads, CAST(sum(length(regexp_replace(seq, '[^CG]', '', 'g'))) AS BIGINT) AS n_gc,
  CAST(max({_RUNS}) AS INTEGER) AS longest_run, min(read_name) AS first_name FROM reads GROUP BY ref_index
"""


def _summary(table):
    import re

    import pyarrow as pa

    runs, seqs = re.compile("A+|C+|G+|T+|N+").findall, table.column("seq").to_pylist()
    return pa.table({"ref_index": [table.column("ref_index")[0].as_py()], "n_reads": [len(seqs)], "n_gc": [sum(s.count("G") + s.count("C") for s in seqs)],
                     "longest_run": [max(max(map(len, runs(s)), default=0) for s in seqs)], "first_name": [min(table.column("read_name").to_pylist())]})


def _merged(table):
    import pyarrow as pa

    column = lambda c: table.column(c).to_pylist()
    return pa.table({"ref_index": column("ref_index")[:1], "n_reads": [sum(column("n_reads"))], "n_gc": [sum(column("n_gc"))],
                     "longest_run": [max(column("longest_run"))], "first_name": [min(column("first_name"))]})


@register("user_group_function", _GROUP_SQL)
def user_group_function(spark, sf_dir):
    """UD1 by contig, in parts of at most about 2,000 reads that are merged."""
    schema = "ref_index int, n_reads long, n_gc long, longest_run int, first_name string"
    reads = A.reads(spark, sf_dir).select("read_id", "read_name", "ref_index", "seq")
    return UF.map_groups(reads, ["ref_index"], _summary, _merged, schema, schema, rows_per_part=2000)


# What runs inside tasks travels whole, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
