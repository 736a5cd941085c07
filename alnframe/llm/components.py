"""Connected components by alternating stars: every round is a few joins and minima, none of which gathers a
component in one place. Links and labels stay in DataFrames; the driver sees two numbers a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Links of a task, and the tasks that any number of links may have: a task has files and records of its own however
#: few its links are, so few links don't go through as many tasks as the session has shuffle partitions.
LINKS_PER_TASK, LEAST_TASKS = 20_000, 8


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _tasks(links: int) -> int:
    return max(LEAST_TASKS, -(-links // LINKS_PER_TASK))


def components(links: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, component): the least node of the component, for every node that has a link to another node.

    Links are undirected; repeated links, links to itself and links with a null end change nothing. No links: no rows.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    links = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(links)
    while state[0]:
        # coalesced minima have no partitioning that a join could keep: adaptive execution can split a hot key there
        n = _tasks(state[0])
        links = links.coalesce(n)
        # each link from either end, in as many tasks as the links have
        both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.u", "x.v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(n)
        # large star: every larger neighbour is linked to the least of the neighbourhood
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").coalesce(n).distinct().coalesce(n))
        # small star: every node and its smaller neighbours are linked to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(n)
        rest = (large.join(least, "u").filter("v <> m")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(n))
        links = cut_lineage(rest.union(least.select("u", "m")).distinct().coalesce(n))
        now = _state(links)
        if now == state:
            break
        state = now
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(links.select("v", "v").distinct().coalesce(_tasks(state[0])))
