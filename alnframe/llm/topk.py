"""Exact top-k search over integer vectors, block at a time.

Vectors lie in blocks with the least and largest value of every component (term). A query's bound on a block is the sum
of its best term products. Each query first scores the blocks with its highest bounds, which gives a k-th score to beat;
then only blocks whose bound reaches it are joined to the queries that need them, scored through the block's vectors,
highest bounds first, until the bounds fall below the k-th.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import exchanged, per_batch

#: Vectors in a block, queries that travel together, blocks whose bounds are computed together, blocks of the first pass.
BLOCK, QUERIES, SUMMARIES, FIRST = 512, 128, 256, 2
#: Vectors that deal out the blocks: so many at most, by hash order. They only steer which vectors share a block.
PIVOTS = 64


def to_integers(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component; null if the vector is null, empty or has a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed; in doubles where every sum is exact there."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return _product(np.maximum(q, 0), high) + _product(np.minimum(q, 0), low)


def _best(scores: list, ids: list, k: int) -> list[tuple[int, int]]:
    return sorted(zip(scores, ids, strict=True), key=lambda x: (-x[0], x[1]))[:k]


def _blocks(rows: DataFrame, width: int, size: int, near: list) -> DataFrame:
    """(part, block, n, ids, data, low, high) of rows (id, vector): vectors near one pivot share blocks."""
    pivots = _matrix(near, width)

    def group() -> object:
        def step(cols: dict) -> dict:
            v = _matrix(cols["vector"], width)
            cols["part"] = _product(v, pivots).argmax(axis=1).tolist() if len(pivots) else [0] * len(v)
            return cols

        return step

    dealt = per_batch(rows, "id long, vector array<long>, part long", group)
    n = F.count("*").alias("n")
    parts = dealt.groupBy("part").agg(n)  # at most PIVOTS rows
    salted = dealt.join(F.broadcast(parts), "part").withColumn("salt", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / size)))

    def block(table: pa.Table) -> pa.Table:
        v = _matrix(table.column("vector").to_pylist(), width)
        ids = table.column("id").to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        v, ids = v[order], ids[order]
        row = {"block": f"{table.column('part')[0]}-{table.column('salt')[0]}", "n": len(ids), "ids": ids.tobytes(), "data": v.tobytes(),
               "low": v.min(axis=0).tobytes(), "high": v.max(axis=0).tobytes()}
        return pa.table({c: [x] for c, x in row.items()})

    return salted.groupBy("part", "salt").applyInArrow(block, "block string, n long, ids binary, data binary, low binary, high binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products with the rows of another id.

    ``vector`` holds integers (array<long>); shorter ones count as padded with zeros, null vectors and ids take no part.
    Ties go to the smaller id. Rows that repeat an id are scored each; a query row that is repeated is answered once per
    distinct vector, so equal repeats give one answer. Fewer than k others: all of them. No rows: no answers. Scores are sums of 64 bits; what exceeds them wraps.
    """
    rows = cut_lineage(vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("query"))
                       .filter("id IS NOT NULL AND vector IS NOT NULL"))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    near = [r.vector for r in rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("vector").collect()]  # bounded by PIVOTS
    blocks = cut_lineage(_blocks(rows.select("id", "vector"), width, BLOCK, near))
    queries = cut_lineage(_blocks(rows.filter("query").select("id", "vector").distinct(), width, QUERIES, near)
                          .select(F.col("block").alias("group"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")))
    # bounds: query groups against block summaries, in blocks of summaries
    summary = (blocks.select("block", "low", "high").withColumn("_s", F.pmod(F.xxhash64("block"), F.lit(1 << 20)))
               .withColumn("chunk", F.row_number().over(Window.partitionBy(F.col("_s") % 64).orderBy("block")) / SUMMARIES)
               .groupBy((F.col("_s") % 64).alias("_t"), F.floor("chunk").alias("_c")).agg(F.collect_list(F.struct("block", "low", "high")).alias("blocks")))

    def bound_lists(table_of: dict) -> dict:
        out: dict = {c: [] for c in ("group", "block", "query", "bound")}
        for g, ids, data, chunk in zip(table_of["group"], table_of["q_ids"], table_of["q_data"], table_of["blocks"], strict=True):
            q = np.frombuffer(data, np.int64).reshape(-1, width)
            low = np.frombuffer(b"".join(b["low"] for b in chunk), np.int64).reshape(-1, width)
            high = np.frombuffer(b"".join(b["high"] for b in chunk), np.int64).reshape(-1, width)
            bounds = _bounds(q, low, high)
            for j, b in enumerate(chunk):
                out["group"].append(g)
                out["block"].append(b["block"])
                out["query"].append(list(range(len(q))))
                out["bound"].append(bounds[:, j].tolist())
        return out

    pairs = cut_lineage(per_batch(queries.crossJoin(summary).select("group", "q_ids", "q_data", "blocks"),
                                  "`group` string, block string, query array<int>, bound array<long>", lambda: bound_lists))

    def scored(wanted: DataFrame) -> DataFrame:
        """Rows (group, block, query, bound, least) to (group, query, id, score): the best k of each block.

        ``least`` is the score a query has to beat so far."""
        def make():
            def step(cols: dict) -> dict:
                out: dict = {c: [] for c in ("group", "query", "id", "score")}
                seen: dict = {}
                for i in sorted(range(len(cols["group"])), key=lambda i: -max(cols["bound"][i], default=0)):
                    q = np.frombuffer(cols["q_data"][i], np.int64).reshape(-1, width)
                    q_ids, ids = np.frombuffer(cols["q_ids"][i], np.int64), np.frombuffer(cols["ids"][i], np.int64)
                    g = cols["group"][i]
                    least = [max(seen.get((g, x), y), y) if y is not None else seen.get((g, x)) for x, y in zip(cols["query"][i], cols["least"][i], strict=True)]
                    need = [j for j, (b, y) in enumerate(zip(cols["bound"][i], least, strict=True)) if y is None or b >= y]
                    if not need:
                        continue
                    which = [cols["query"][i][j] for j in need]
                    scores = _product(q[which], np.frombuffer(cols["data"][i], np.int64).reshape(-1, width))
                    for x, row in zip(which, scores, strict=True):
                        other = ids != q_ids[x]
                        s, d = row[other], ids[other]
                        if len(s) > k:
                            keep = s >= np.partition(s, len(s) - k)[len(s) - k]
                            s, d = s[keep], d[keep]
                        best = _best(s.tolist(), d.tolist(), k)
                        if len(best) == k:
                            seen[g, x] = max(seen.get((g, x), best[-1][0]), best[-1][0])
                        for score, d in best:
                            for c, value in zip(out, (g, x, d, score), strict=True):
                                out[c].append(value)
                return out

            return step

        joined = wanted.join(exchanged(blocks.select("block", "ids", "data")), "block").join(exchanged(queries), "group")
        cols = ["group", "block", "query", "bound", "least", "ids", "data", "q_ids", "q_data"]
        return per_batch(joined.select(*cols), "`group` string, query int, id long, score long", make)

    each = pairs.select("group", "block", F.explode(F.arrays_zip("query", "bound")).alias("x")).select("group", "block", "x.query", "x.bound")
    gathered = lambda df: df.groupBy("group", "block").agg(  # noqa: E731  a group has at most some QUERIES queries
        F.collect_list(F.struct("query", "bound", "least")).alias("x")).select("group", "block", "x.query", "x.bound", "x.least")
    order = Window.partitionBy("group", "query").orderBy(F.desc("bound"), "block")
    first = each.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= FIRST).drop("_r")
    found = cut_lineage(scored(gathered(first.withColumn("least", F.lit(None).cast("long")))))
    # the k-th of the first pass: what a further block has to reach
    kth = (found.withColumn("_r", F.row_number().over(Window.partitionBy("group", "query").orderBy(F.desc("score"), "id")))
           .filter(F.col("_r") == k).select("group", "query", F.col("score").alias("least")))
    left = (each.join(first.select("group", "block", "query"), ["group", "block", "query"], "left_anti")
            .join(kth, ["group", "query"], "left").filter("least IS NULL OR bound >= least"))
    found = found.union(scored(gathered(left)))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("group", "query").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= k)

    def names_of(cols: dict) -> dict:
        out: dict = {c: [] for c in ("group", "query", "query_id")}
        for g, ids in zip(cols["group"], cols["q_ids"], strict=True):
            for i, x in enumerate(np.frombuffer(ids, np.int64).tolist()):
                for c, value in zip(out, (g, i, x), strict=True):
                    out[c].append(value)
        return out

    names = per_batch(queries.select("group", "q_ids"), "`group` string, query int, query_id long", lambda: names_of)
    return ranked.join(exchanged(names), ["group", "query"]).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
