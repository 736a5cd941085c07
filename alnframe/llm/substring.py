"""Substring dedup by content-defined chunks of words.

A gear hash rolls over the words; a cut lies where it is least among any CUT words in a row. So cuts depend on nothing
but the words around them, an insertion moves only those near it, and a chunk has CUT words at most without any forced
cut. Two chunks in a row are looked up by digest over all documents. A run of words covered by such repeats is reported
if it has REPEAT words; by the width of the cuts, a passage of 2 * CUT + 2 + REPEAT words or more can't escape.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import exchanged, fresh, per_batch, word_hashes

CUT, REPEAT = 14, 20
_GEAR = np.uint64(0x9FB21C651E98DF25)
_POWERS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def cuts(hashes: np.ndarray) -> np.ndarray:
    """Word numbers at which chunks begin; 0 is one, and the end of the text follows the last."""
    n = len(hashes)
    if n <= CUT:
        return np.zeros(min(n, 1), np.int64)
    gear = hashes * _GEAR  # four words are in a rolling hash that moves on by 16 bits a word
    roll = gear.copy()
    for back in range(1, 4):
        roll[back:] += gear[:-back] << np.uint64(16 * back)
    roll ^= roll >> np.uint64(31)
    roll *= np.uint64(0xBF58476D1CE4E5B9)
    windows = np.lib.stride_tricks.sliding_window_view(roll, CUT)
    least = np.arange(len(windows)) + windows.argmin(axis=1)
    found = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return found if found[0] == 0 else np.concatenate([[0], found])


def chunk_digests(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each chunk with its successor: first word, words, and two digests."""
    at = cuts(hashes)
    ends = np.append(at[1:], len(hashes))
    place = np.arange(len(hashes)) - np.repeat(at, ends - at)
    out = []
    for power in _POWERS:
        powers = np.cumprod(np.full(CUT + 1 if len(place) == 0 else int(place.max()) + 1, power))
        own = np.add.reduceat(hashes * powers[place], at) if len(at) else np.zeros(0, np.uint64)
        out.append(own)
    if len(at) < 2:
        return at[:0], at[:0], out[0][:0], out[1][:0]
    lengths = ends - at
    pair = [(d[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (d[1:] + lengths[:-1].astype(np.uint64)) for d in out]
    return at[:-1], lengths[:-1] + lengths[1:], pair[0], pair[1]


def chunk_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, digest, check, place): a row for each chunk and its successor; place is first word * 64 + words."""
    def make() -> Callable:
        hashes = word_hashes()

        def step(cols: dict) -> dict:
            ids, digest, check, place = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for doc_id, t in zip(cols["doc_id"], cols["text"], strict=True):
                first, words, d, e = chunk_digests(hashes(t.split()))
                ids += [doc_id] * len(first)
                digest.append(d.view(np.int64))
                check.append((e >> np.uint64(33)).astype(np.int32))
                place.append(first * 64 + words)
            return {"doc_id": ids, "digest": np.concatenate(digest), "check": np.concatenate(check), "place": np.concatenate(place)}

        return step

    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return per_batch(rows, "doc_id long, digest long, `check` int, place long", make)


def repeats(docs: DataFrame, text: str = "text", least: int = REPEAT) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc_id, removable): runs of ``least`` words or more (numbers of words, end
    exclusive) that also stand in documents of another id, divided where removable changes; so a part of a run can have
    fewer words.

    Each repeat of two chunks stays in the document of the least id that holds it. removable is false for the words of
    such first copies (first_doc_id is the document itself) and true for other words (first_doc_id is the least id that
    holds a piece of the part), so that taking out the removable parts leaves a copy of every repeat. Null and empty
    texts, and texts of fewer words than a run, have none; rows without an id take no part; rows that repeat an id count
    as one document. Case and punctuation count.
    """
    chunks = chunk_rows(docs, text)
    twice = (chunks.groupBy("digest", "check").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .filter("first < last").select("digest", "check", "first"))
    start = F.floor(F.col("place") / 64)
    found = (chunks.join(exchanged(twice), ["digest", "check"])
             .select("doc_id", start.alias("start"), (start + F.col("place") % 64).alias("end"), "first").repartition("doc_id"))
    own, earlier = (F.col("first") == F.col("doc_id")).cast("int"), F.when(F.col("first") < F.col("doc_id"), F.col("first"))

    def mark(at: Column, cover: int, first: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(cover).alias("cover"), (own * cover).alias("own"), first.alias("first"))

    # a repeat opens at its first word and closes after its last; its first document is noted at both of these words
    marks = found.select("doc_id", F.explode(F.array(
        mark(F.col("start"), 1, earlier), mark(F.col("end") - 1, 0, earlier), mark(F.col("end"), -1, F.lit(None).cast("long")))).alias("m")).select("doc_id", "m.*")
    by = Window.partitionBy("doc_id").orderBy("at")
    # marks at one word are peers: they have the same sums
    swept = marks.select("doc_id", "at", "first", F.lead("at").over(by).alias("to"), (F.sum("cover").over(by) > 0).alias("covered"), (F.sum("own").over(by) > 0).alias("kept"))
    opens = F.col("covered") & ~F.coalesce(F.lag("covered").over(by), F.lit(False))
    turns = opens | (F.col("kept") != F.lag("kept").over(by))
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    parts = (swept.withColumns({"opens": opens.cast("int"), "turns": F.coalesce(turns, F.lit(False)).cast("int")})
             .withColumns({"run": F.sum("opens").over(so_far), "part": F.sum("turns").over(so_far)}).filter("covered")
             .groupBy("doc_id", "run", "part").agg(F.min("at").alias("start"), F.max("to").alias("end"), F.min("first").alias("first"), F.max("kept").alias("kept")))
    run = Window.partitionBy("doc_id", "run")
    parts = (parts.withColumn("n_words", F.col("end") - F.col("start"))
             .withColumns({"whole": F.sum("n_words").over(run), "first": F.coalesce("first", F.min("first").over(run))}).filter(F.col("whole") >= least))
    return parts.select("doc_id", "start", "end", "n_words", F.when(F.col("kept"), F.col("doc_id")).otherwise(F.col("first")).alias("first_doc_id"), (~F.col("kept")).alias("removable"))


def without_repeats(docs: DataFrame, text: str = "text", least: int = REPEAT) -> DataFrame:
    """``docs`` with the removable runs taken out of the text; other texts stay as they are to the character."""
    id_, own_runs = fresh(docs, "_id"), fresh(docs, "_runs")
    runs = (repeats(docs, text, least).filter("removable").groupBy(F.col("doc_id").alias(id_))
            .agg(F.collect_list(F.struct("start", "end")).alias(own_runs)))  # the runs of one document
    joined = docs.join(runs, F.col("doc_id") == F.col(id_), "left").drop(id_)

    def make() -> Callable:
        def step(cols: dict) -> dict:
            texts = []
            for t, own in zip(cols[text], cols[own_runs], strict=True):
                if t is not None and own:
                    gone = {i for r in own for i in range(r["start"], r["end"])}
                    t = b" ".join(w for i, w in enumerate(t.encode().split()) if i not in gone).decode()
                texts.append(t)
            return {c: v for c, v in cols.items() if c != own_runs} | {text: texts}

        return step

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return per_batch(joined, schema, make)
