"""Near-duplicate classes by Order MinHash.

A sketch of a text holds, for each of TABLES hash functions, the two least of its 5-word shingles, each labelled with
its occurrence number, in the order in which they stand in the text. So two texts share a sketch value if they share the
shingles and their order. Texts with a common value are compared with a representative of their bucket: five-word
Jaccard similarity, then a banded alignment of their words. Verified links make connected components.

No bucket makes all pairs: each member is linked to the least member of its buckets (one per table) and to the greatest
of the finer buckets of two neighbouring tables, 2 * TABLES representatives in all. Exact copies are one node. Members of
buckets that these links leave in several components are compared further, by an exact prefix join of their shingles.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import key_block, key_filter, may_hold
from ..session import cut_lineage, shared_dir
from .components import components
from .words import WORD, exchanged, mixed, per_batch, shingles, word_hashes

K, TABLES, LEAST = 5, 16, 0.8
#: Words up to which a text's places are kept as masks of the whole text: 2 MB at most.
_MASKED = 4096
#: Classes of shingle hashes whose texts are counted.
BUCKETS = 1 << 20

_SEEDS = mixed(np.arange(1, TABLES + 1, dtype=np.uint64))


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hash of each shingle with the number of its earlier occurrences."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if new.all():
        return hashes
    first = np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))
    times = np.empty(len(ranked), np.uint64)
    times[order] = (np.arange(len(ranked)) - first).astype(np.uint64)
    return np.where(times > 0, mixed(hashes + times * np.uint64(0x9E3779B97F4A7C15)), hashes)


def sketch(parts: np.ndarray) -> np.ndarray:
    """Sketch values of a text's shingles in order, at least one."""
    own = labelled(parts)
    if len(own) == 1:
        return mixed(own[0] ^ _SEEDS)
    step = max(1, 4_000_000 // len(own))  # tables at once, for texts of any length
    out = []
    for at in range(0, TABLES, step):
        x = (own[None, :] ^ _SEEDS[at : at + step, None]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        two = np.sort(np.argpartition(x, 1, axis=1)[:, :2], axis=1)
        chosen = own[two]
        out.append(mixed(chosen[:, 0] * np.uint64(0xD6E8FEB86659FD93) + chosen[:, 1]))
    return np.concatenate(out)


class _Places:
    """Where each element stands in a sequence, as bits of a band: for texts of moderate length a mask of the whole text
    for each element, for longer ones the places themselves, or a comparison of the band where an element is frequent.
    So memory follows the length, whatever the number of different elements."""

    def __init__(self, a: list, band: int):
        self.band, self.width, self.masks, self.places = band, 2 * band + 1, {}, {}
        self.a = None if len(a) <= _MASKED else np.array(a)
        if self.a is None:
            for i, x in enumerate(a):
                self.masks[x] = self.masks.get(x, 0) | 1 << i
        else:
            for i, x in enumerate(a):
                self.places.setdefault(x, []).append(i)

    def at(self, x, j: int) -> int:
        """The places of x from j - band on, one bit each; bits past the band are to be cut off."""
        first = j - self.band
        if self.a is None:
            own = self.masks.get(x, 0)
            return own >> first if first >= 0 else own << -first
        places = self.places.get(x, ())
        lo, hi = bisect_left(places, first), bisect_right(places, j + self.band)
        if hi - lo <= 8:
            return sum(1 << (i - first) for i in places[lo:hi])
        begin = max(first, 0)
        bits = np.packbits(self.a[begin : j + self.band + 1] == x, bitorder="little").tobytes()
        return int.from_bytes(bits, "little") << (begin - first)


def edit_distance(a: list, b: list, most: int) -> int:
    """Edits that make a into b, or a number over ``most``: bit vectors of a band of 2 * most + 1 diagonals."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = sorted((a[lo : len(a) - hi], b[lo : len(b) - hi]), key=len, reverse=True)
    if not b or len(a) - len(b) > most:
        return len(a)
    band = min(most, len(a))
    places = _Places(a, band)
    width = 2 * band + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    vp, vn, dist, across = full & ~((1 << band) - 1), 0, band, top >> 1
    for j, x in enumerate(b):
        eq = places.at(x, j) & full
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp, hn = (vn | ~(d0 | vp)) & full, d0 & vp
        if j + band < len(a):  # down the lowest diagonal of the band, then along the last row
            dist += not d0 & top
        else:
            dist += bool(hp & across) - bool(hn & across)
            across >>= 1
        d0 = (d0 & full) >> 1
        vp, vn = (hn | ~(d0 | hp)) & full, d0 & hp
    return dist


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, node, digest, sketch, size): digest of the words in lower case, null without a word; node is the id, or a
    negative number made from the text where the id is null; size is the number of different shingles."""
    def make() -> Callable:
        hashes = word_hashes()

        def step(cols: dict) -> dict:
            out: dict = {"doc_id": cols["doc_id"], "digest": [], "sketch": [], "size": []}
            for t in cols["text"]:
                words = t.split()
                parts = shingles(hashes(words), K) if words else None
                out["digest"].append(xxhash.xxh3_128_hexdigest(b" ".join(words)) if words else None)
                out["sketch"].append(sketch(parts).view(np.int64).tolist() if words else None)
                out["size"].append(len(np.unique(parts)) if words else None)
            return out

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.coalesce(F.col(text), F.lit(""))).cast("binary").alias("text"))
    done = per_batch(rows, "doc_id long, digest string, sketch array<long>, size long", make)
    return done.withColumn("node", F.coalesce("doc_id", node_of_text("digest")))


def with_nodes(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, node): the rows of ``docs`` as structs with the node of ``sketches``; texts without an id alone go through
    Python."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    named = rows.filter("row.doc_id IS NOT NULL").withColumn("node", F.col("row.doc_id").cast("long"))

    def make() -> Callable:
        def step(cols: dict) -> dict:
            words = [t.split() for t in cols["lower"]]
            return {"text": cols["text"], "digest": [xxhash.xxh3_128_hexdigest(b" ".join(w)) if w else None for w in words]}

        return step

    nameless = rows.filter("row.doc_id IS NULL")
    own = nameless.select(F.col("row")[text].alias("text")).distinct().withColumn("lower", F.lower(F.coalesce("text", F.lit(""))).cast("binary"))
    digests = per_batch(own, "text string, digest string", make).select(F.col("text").alias("of"), node_of_text("digest").alias("node"))
    return named.unionByName(nameless.join(exchanged(digests), F.col("row")[text].eqNullSafe(F.col("of"))).select("row", "node"))


def node_of_text(digest: str) -> Column:
    """The node of a row without an id: a negative number."""
    return -1 - F.pmod(F.xxhash64(digest), F.lit(2**62))


def candidate_pairs(nodes: DataFrame, least: float = LEAST) -> DataFrame:
    """(a, b), a < b, of rows (node, size, sketch): every node with the representatives of its buckets, but for those
    whose number of shingles rules a similarity of ``least`` out."""
    i, s = F.sequence(F.lit(0), F.lit(TABLES - 1)), F.col("sketch")
    coarse = F.transform(i, lambda t: F.xxhash64(t, F.get(s, t)))
    fine = F.transform(i, lambda t: F.xxhash64(t + TABLES, F.get(s, t), F.get(s, (t + 1) % TABLES)))
    keys = nodes.select("node", F.explode(F.concat(coarse, fine)).alias("key"))
    ends = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    met = keys.join(exchanged(ends), "key")
    pairs = met.select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("node").alias("b")),
                                         F.struct(F.col("node").alias("a"), F.col("high").alias("b")))).alias("p")).select("p.a", "p.b")
    pairs = pairs.filter("a < b").distinct()
    a, b = (nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    alike = F.least("size_a", "size_b") >= least * F.greatest("size_a", "size_b") - 1e-6
    return pairs.join(a, "a").join(b, "b").filter(alike).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose words pass: Jaccard similarity of their sets of 5-word shingles and edit similarity
    (1 - distance / the longer length) are ``least`` or more. ``texts``: (node, text), lower case."""
    def make() -> Callable:
        hashes = word_hashes()
        known: dict = {}  # the last representative's, which comes in many pairs

        def of(node: int, t: bytes) -> tuple:
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                words = hashes(t.split())
                known[node] = words, np.unique(shingles(words, K))
            return known[node]

        def step(cols: dict) -> dict:
            out: dict = {"a": [], "b": []}
            for a, b, s, t in zip(*(cols[c] for c in ("a", "b", "text_a", "text_b")), strict=True):
                (x, xs), (y, ys) = of(a, s), of(b, t)
                if min(len(xs), len(ys)) < least * max(len(xs), len(ys)):
                    continue
                both = len(np.intersect1d(xs, ys, assume_unique=True))
                longer = max(len(x), len(y))
                most = int((1 - least) * longer + 1e-9)
                if both >= least * (len(xs) + len(ys) - both) and edit_distance(x.tolist(), y.tolist(), most) <= most:
                    out["a"].append(a)
                    out["b"].append(b)
            return out

        return step

    a, b = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    return per_batch(pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b"), "a long, b long", make)


def unjoined(nodes: DataFrame, joined: DataFrame) -> DataFrame:
    """(node, component) of the rows (node, sketch) in buckets that hold nodes of several components of ``joined``."""
    i = F.sequence(F.lit(0), F.lit(TABLES - 1))
    keys = (nodes.join(exchanged(joined), "node", "left").withColumn("component", F.coalesce("component", "node"))
            .select("node", "component", F.explode(F.transform(i, lambda t: F.xxhash64(t, F.get("sketch", t)))).alias("key")))
    mixed_up = keys.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    return keys.join(exchanged(mixed_up), "key", "left_semi").select("node", "component").distinct()


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """How many texts hold a shingle of each of BUCKETS classes of hashes: a vector of one size whatever the corpus."""
    def make() -> Callable:
        hashes, n = word_hashes(), np.zeros(BUCKETS, np.int64)

        def step(cols: dict) -> dict:
            for t in cols["text"]:
                n[(np.unique(shingles(hashes(t.split()), K)) % np.uint64(BUCKETS)).astype(np.int64)] += 1
            known = np.flatnonzero(n)
            out = {"bucket": known.astype(np.int32), "n": n[known]}
            n[known] = 0
            return out

        return step

    rows = per_batch(texts.select("text"), "bucket int, n long", make).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return counts


def similar_pairs(texts: DataFrame, least: float = LEAST) -> DataFrame:
    """(a, b), a < b: all pairs of rows (node, component, text) of different components whose sets of 5-word shingles
    can have a Jaccard similarity of ``least``; none that has is missed.

    Shingles are put in one order, rare before frequent by a count sketch of bounded size and then by hash. Similar sets
    share one of their first shingles (all but ``least`` of a set), and at the first that they share enough must be left
    in both. This holds in any order, so an inexact count costs time and no pair. Only these first shingles are rows.
    """
    counts = shingle_counts(texts)

    def make() -> Callable:
        hashes = word_hashes()

        def step(cols: dict) -> dict:
            rows, shingle, left = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for node, component, t in zip(cols["node"], cols["component"], cols["text"], strict=True):
                own = np.unique(shingles(hashes(t.split()), K))
                n = counts[(own % np.uint64(BUCKETS)).astype(np.int64)]
                first = np.lexsort((own, n))[: int((1 - least) * len(own) + 1e-6) + 1]
                at = np.flatnonzero(n[first] > 1)  # a class of one text holds no shingle that two share
                shingle.append(own[first[at]].view(np.int64))
                left.append(len(own) - at)
                rows.append((node, component, len(own), len(at)))
            node, component, size, times = np.array(rows, np.int64).reshape(-1, 4).T
            return {"shingle": np.concatenate(shingle), "left": np.concatenate(left),
                    "node": np.repeat(node, times), "component": np.repeat(component, times), "size": np.repeat(size, times)}

        return step

    folder = shared_dir(texts.sparkSession, "prefixes")
    per_batch(texts, "shingle long, node long, component long, size long, left long", make).write.parquet(folder)
    prefix = texts.sparkSession.read.parquet(folder)
    x, y = (prefix.select("shingle", *[F.col(c).alias(f"{c}_{e}") for c in ("node", "component", "size", "left")]) for e in "ab")
    most = F.least("left_a", "left_b")  # shingles that both can share from here on
    return (x.join(y, "shingle").filter("node_a < node_b AND component_a <> component_b")
            .filter(most * (1 + least) >= least * (F.col("size_a") + F.col("size_b")) - 1e-6)
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())


def among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``nodes``, and few others, found where they are by a broadcast key filter of bounded size; what meets
    the nodes after that shuffles no others."""
    known = nodes.select(F.xxhash64("node").alias("h")).distinct()
    blocks, n = key_filter(known, known.count())
    here = rows.withColumn("h", F.xxhash64("node"))
    held = here.join(F.broadcast(blocks.withColumnRenamed("block", "of")), key_block(F.col("h"), n) == F.col("of"), "left")
    return held.filter(may_hold(F.col("words"), F.col("h"))).select(*rows.columns)


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links): a row for each row of ``docs``.

    class_id is the least doc_id of the class, rows without an id aside; documents are in one class if verified links, or equal words in lower
    case, connect them. n_links counts the verified links of the document's text to different texts; n_links is 0 for a
    document alone in its class or with copies only. Null and empty texts are alone. Rows that repeat a doc_id are one
    document, linked by all its texts. Rows without an id are members like others, by their text; a class of such rows alone has a
    negative number.
    """
    return _classes(docs, text).drop("node")


def _classes(docs: DataFrame, text: str) -> DataFrame:
    """near_duplicates, with the row's node."""
    rows = cut_lineage(sketches(docs, text))
    some = rows.filter("digest IS NOT NULL")
    nodes = cut_lineage(some.groupBy("digest").agg(F.min("node").alias("node"), F.any_value("sketch").alias("sketch"), F.any_value("size").alias("size")))
    pairs = cut_lineage(candidate_pairs(nodes))
    texts = (with_nodes(docs.select("doc_id", F.col(text).alias("text")))
             .select("node", F.lower(F.coalesce("row.text", F.lit(""))).cast("binary").alias("text")))

    def checked(pairs: DataFrame) -> DataFrame:
        involved = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return cut_lineage(verified(pairs, among(texts, involved)).distinct())

    links = checked(pairs)
    rest = cut_lineage(unjoined(nodes.select("node", "sketch"), components(links, "a", "b")))
    further = cut_lineage(similar_pairs(among(texts, rest).join(exchanged(rest), "node")))
    links = cut_lineage(links.union(checked(further)).distinct())
    own = some.select("node", "digest").join(exchanged(nodes.select("digest", F.col("node").alias("rep"))), "digest").select("node", "rep")
    # copies meet at their representative; links connect representatives
    member = components(links.select("a", "b").union(own.filter("node <> rep")), "a", "b")
    # a class takes its number from rows with an id
    ids = (rows.filter("doc_id IS NOT NULL").select("node").distinct().join(exchanged(member), "node")
           .groupBy("component").agg(F.min("node").alias("least")))
    member = (member.join(exchanged(ids), "component", "left").select("node", F.coalesce("least", "component").alias("component")))
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    by_node = (own.join(exchanged(degree.withColumnRenamed("node", "rep")), "rep", "left")
               .groupBy("node").agg(F.max("n").alias("n_links")))
    out = (rows.select("doc_id", "node").join(exchanged(member), "node", "left").join(exchanged(by_node), "node", "left"))
    return out.select("doc_id", "node", F.coalesce("component", "node").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are the least of their class. Of rows that repeat a doc_id and text one stays. Rows without an
    id stay where no row of their class has one: one row of each such class, and one of each text without a word."""
    classes = cut_lineage(_classes(docs, text))
    kept = classes.filter("doc_id = class_id").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.filter("doc_id IS NOT NULL").select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("doc_id"), F.col(text).alias("text"))
    named = rows.join(kept, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id", "text"]).select("row")
    alone = classes.filter("doc_id IS NULL AND node = class_id").select("node").distinct()
    own = F.col("row")[text]
    blank = F.when(F.regexp_count(F.coalesce(own, F.lit("")), F.lit(WORD)) == 0, own)
    nameless = (with_nodes(docs.filter("doc_id IS NULL"), text).join(exchanged(alone), "node", "left_semi")
                .withColumn("blank", blank).dropDuplicates(["node", "blank"])).select("row")
    return named.unionByName(nameless).select(*[F.col("row")[c].alias(c) for c in docs.columns])
