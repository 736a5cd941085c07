"""Audit of how the sources of a language diverge: distances between sources, and the terms that a source overuses.

Terms are counted inside tasks and summed in one shuffle by (lang, term). Every share is an exact integer, ``1 +
floor(SCALE * (count + PSEUDO) / (total + PSEUDO * terms))``. Distances are summed in blocks of terms and sources. A
source's top terms come from a dominance skyband: a share grows with the group's count and falls with the language's,
so a term that k others beat or equal in both, all of them earlier in UTF-8, can't be among the first k.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .words import exchanged

SCALE = 1_000_000_000
PSEUDO = 5
#: Documents of its language that hold a kept term, at least.
LEAST_DOCUMENTS = 30
#: Terms reported for each source.
TOP = 50

#: Entries that a task counts before it hands them on; bounds its memory, not its result.
_COUNTED = 300_000
#: A longer text is counted in parts of about so many bytes.
_PART = 1 << 20
#: Rows and columns of a block of shares.
_TERMS, _SOURCES = 4096, 128
#: Points of one group that a task holds before it thins them, and skybands merged at once.
_POINTS, _FAN = 100_000, 64

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in parts: runs of ASCII letters and of characters past U+007F, A to Z in lower case."""
    plain = text.translate(_LETTERS)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + _PART)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents) from (lang, source, text), partly summed: a task hands on what it has counted
    when it holds _COUNTED entries, and at its end."""
    schema = "lang string, source string, term binary, n long, documents long"
    fields = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("documents", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def hand_on():
            for (lang, source), (n, documents) in known.items():
                for at in range(0, len(n), 50_000):
                    own = list(n)[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), pa.array([source] * len(own)), pa.array(own, pa.binary()),
                                                      pa.array([n[t] for t in own], pa.int64()), pa.array([documents[t] for t in own], pa.int64())], schema=fields)

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                n, documents = known.setdefault((lang, source), (Counter(), Counter()))
                before, once = len(n), set()
                for part in terms(text):
                    n.update(part)
                    once.update(part)
                documents.update(once)
                held += len(n) - before
                if held >= _COUNTED:
                    yield from hand_on()
                    known, held = {}, 0
        yield from hand_on()

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(count, schema)


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of terms that ``least`` documents of their language hold; ``first`` marks
    one row of each term of a language."""
    counted = (term_counts(docs).withColumn("term", F.col("term").cast("string")).repartition("lang", "term")
               .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")))
    term = Window.partitionBy("lang", "term")
    return (counted.withColumns({"lang_n": F.sum("n").over(term), "in_lang": F.sum("documents").over(term),
                                 "first": F.row_number().over(term.orderBy("source")) == 1})
            .filter(F.col("in_lang") >= least).select("lang", "source", "term", "n", "lang_n", "first"))


def share(n: Column, total: Column, n_terms: Column) -> Column:
    """Exact integer share; decimals, as the product may pass 64 bits."""
    wide = lambda c: c.cast("decimal(27,0)")
    return (F.expr("1L") + F.call_function("div", wide(n + PSEUDO) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + n_terms * PSEUDO)))


# --- distances ------------------------------------------------------------------------------------------------------

def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): sum of absolute differences of the shares of two sources of a language, over all its
    terms. ``shares``: (lang, source, term, p); ``groups``: (lang, source, p0, n_terms, n_sources), p0 the share of a
    term that the source lacks.

    A task sees a block of terms and two blocks of sources at a time, each block of bounded size; it adds up the pairs
    of its sources, so what is shuffled is a number for each pair of sources and block of terms. Terms that none of its
    sources has don't reach it; each adds the difference of p0, which the first block of terms counts for all terms and
    every block takes off for its own.
    """
    parts = F.ceil(F.greatest(F.col("n_terms"), F.lit(1)) / _TERMS).cast("int")
    sides = F.ceil(F.col("n_sources") / _SOURCES).cast("int")
    groups = groups.select("lang", "source", "p0", "n_terms", parts.alias("parts"), sides.alias("sides"), F.pmod(F.xxhash64("source"), sides).cast("int").alias("side"))
    rows = (shares.join(exchanged(groups), ["lang", "source"])
            .select("lang", "source", "term", "p", "n_terms", "sides", "side", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part")))
    absent = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "n_terms", "sides", "side",
                           F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    other = F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
    placed = (rows.unionByName(absent).withColumn("other", other)
              .select("lang", "part", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "source", "term", "p", "n_terms"))
    schema = "lang string, source string, item string, value long"
    fields = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def sums(block: pa.Table) -> pa.Table:
        lang, part, low, high = (block.column(c)[0].as_py() for c in ("lang", "part", "low", "high"))
        source, term = (block.column(c).combine_chunks().dictionary_encode() for c in ("source", "term"))
        source, term = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (source, term))
        p, side = block.column("p").to_numpy(), block.column("side").to_numpy()
        of, at = source.indices.to_numpy(), term.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        names, n = source.dictionary.to_pylist(), len(term.dictionary)
        table = np.zeros((len(names), n), np.int64)
        none = at < 0
        p0 = np.zeros(len(names), np.int64)
        p0[of[none]] = p[none]
        table += p0[:, None]
        table[of[~none], at[~none]] = p[~none]
        sides = np.empty(len(names), np.int64)
        sides[of] = side
        left, unseen = np.flatnonzero(sides == low), (block.column("n_terms")[0].as_py() if part == 0 else 0) - n
        out: tuple[list, list, list] = ([], [], [])
        for k in left.tolist():
            right = np.flatnonzero(sides == high) if low != high else left[left > k]
            out[0].extend([names[k]] * len(right))
            out[1].extend(names[j] for j in right.tolist())
            out[2].extend((np.abs(table[right] - table[k]).sum(1) + unseen * np.abs(p0[right] - p0[k])).tolist())
        return pa.table([pa.array([lang] * len(out[0]), pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], schema=fields)

    # a block tells a pair in any order; each pair has one here
    half = (placed.groupBy("lang", "part", "low", "high").applyInArrow(sums, schema)
            .select("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"), "value")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    turned = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    return half.select("lang", turned.alias("of"), "value").select("lang", "of.source", "of.item", "value")


# --- skybands -------------------------------------------------------------------------------------------------------

def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the points that fewer than k others dominate: by a count as high, a language count as low and an
    earlier term. ``term`` holds different numbers in the terms' order.

    In order of count, then language count, then term, a point comes after all that dominate it. A tree over the terms
    keeps, for each range of them, the k lowest language counts so far; points that are dropped need no place in it, as
    k others that dominate them have one.
    """
    order = np.lexsort((term, lang_n, -n))
    place = np.empty(len(n), np.int64)
    place[np.argsort(term, kind="stable")] = np.arange(1, len(n) + 1)
    lows: dict[int, list[int]] = {}
    kept = []
    for i, at, low in zip(order.tolist(), place[order].tolist(), lang_n[order].tolist(), strict=True):
        better, j = 0, at
        while j and better < k:
            if own := lows.get(j):
                better += bisect_right(own, low)
            j &= j - 1
        if better >= k:
            continue
        kept.append(i)
        while at <= len(n):
            own = lows.setdefault(at, [])
            if len(own) < k or low < own[-1]:
                insort(own, low)
                del own[k:]
            at += at & -at
    return np.array(sorted(kept), np.int64)


_POINT = "lang string, source string, term string, n long, lang_n long, value long"


def _thinned(points: pa.Table, k: int) -> pa.Table:
    """The skyband of one group's points."""
    term = points.column("term").cast(pa.binary())
    order = np.empty(points.num_rows, np.int64)
    order[pa.compute.sort_indices(term).to_numpy()] = np.arange(points.num_rows)
    return points.take(pa.array(skyband(points.column("n").to_numpy(), points.column("lang_n").to_numpy(), order, k)))


def top_terms(shares: DataFrame, k: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank) of each group's k terms of the largest value; ``shares``: (lang, source, term,
    n, lang_n, value). Partitions retain their skybands, which are merged _FAN partitions at a time; what is left is
    ranked exactly."""
    import pyarrow.compute  # noqa: F401  (pa.compute in tasks)

    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        held: dict[tuple, list[pa.Table]] = {}
        size: Counter = Counter()
        task = TaskContext.get().partitionId() // _FAN

        def out(points: pa.Table):
            points = points.append_column("task", pa.array([task] * points.num_rows, pa.int64()))
            return points.combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            both = pa.compute.binary_join_element_wise(table.column("lang").cast(pa.binary()), table.column("source").cast(pa.binary()), b"\xff").combine_chunks().dictionary_encode()
            of = both.indices.to_numpy()
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order])) + 1
            for own in np.split(order, cuts) if len(order) else []:
                part = table.take(pa.array(own))
                key = part.column("lang")[0].as_py(), part.column("source")[0].as_py()
                held.setdefault(key, []).append(part)
                size[key] += part.num_rows
                if size[key] >= _POINTS:
                    thin = _thinned(pa.concat_tables(held.pop(key)), k)
                    if thin.num_rows > _POINTS // 2:  # a wide skyband goes on to the merge; others stay to thin what follows
                        yield from out(thin)
                        size[key] = 0
                    else:
                        held[key], size[key] = [thin], thin.num_rows
        for parts in held.values():
            yield from out(_thinned(pa.concat_tables(parts), k))

    def merge(points: pa.Table) -> pa.Table:
        import pyarrow.compute  # noqa: F401

        return _thinned(points.drop_columns(["task"]), k)

    retained = shares.select("lang", "source", "term", "n", "lang_n", "value").mapInArrow(retain, _POINT + ", task long")
    merged = retained.groupBy("lang", "source", "task").applyInArrow(merge, _POINT)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group.

    Part ``pair``: distance to each other source of the language. Part ``term``: the ``top`` terms whose share in the
    source is furthest above their share in the language. Ranks by value, then by the item's UTF-8. Null text, language
    or source counts as empty; a repeated row counts as often as it stands; other columns play no part; a group without
    terms has distances but no term rows; no documents, no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    folder = shared_dir(spark, "divergence")
    kept_terms(docs, least).write.parquet(folder)
    kept = spark.read.parquet(folder)
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("n_terms"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seen = docs.select("lang", "source").distinct()
    n_sources = seen.groupBy("lang").agg(F.count("*").alias("n_sources"))
    groups = (seen.join(by_group, ["lang", "source"], "left").join(n_sources, "lang").join(by_lang, "lang", "left")
              .select("lang", "source", "n_sources", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "lang_total", "n_terms")]))
    groups = groups.withColumn("p0", F.when(F.col("n_terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("n_terms"))).otherwise(1))
    known = kept.join(exchanged(groups.select("lang", "source", "total", "lang_total", "n_terms")), ["lang", "source"])
    shares = known.select("lang", "source", "term", "n", "lang_n", share(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"),
                          share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")).alias("q"))
    above = shares.filter("p > q").withColumn("value", F.col("p") - F.col("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = distances(shares.select("lang", "source", "term", "p"), groups).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(columns)
            .unionByName(top_terms(above, top).withColumn("part", F.lit("term")).select(columns)))
