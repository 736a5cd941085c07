"""Words, word hashes and Arrow batches, shared by the operators that run Python inside tasks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than space and U+0009 to U+000D. ``bytes.split()`` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

#: Distinct words a task remembers before it starts afresh; bounds its memory, not its result.
REMEMBERED = 200_000


def n_words(text: Column) -> Column:
    """Number of words; null counts as the empty text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


class Remembered(dict):
    """A function of a word, computed once per task for each word it keeps."""

    def __init__(self, of: Callable, most: int = REMEMBERED):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.of(word)
        return value


def word_hashes() -> Callable[[list[bytes]], np.ndarray]:
    """A function from a list of words to their 64-bit hashes."""
    known = Remembered(xxhash.xxh3_64_intdigest)

    def hashes(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    return hashes


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with lines after it, so that ``df`` has no such column (names are alike in either case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept_in_worker(key: tuple, make: Callable):
    """What ``make`` returns, made once in a Python worker and shared by its tasks. Functions of this package travel by
    value, so it is kept in a module of its own that is made in the worker."""
    kept = sys.modules.setdefault("alnframe_worker", types.ModuleType("alnframe_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor); arithmetic wraps."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words (of the whole text, if it is shorter)."""
    n = len(hashes) - k + 1
    out = hashes[: max(n, 1)].copy()
    for j in range(1, min(k, len(hashes))):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + max(n, 1)]
    return mixed(out)


def per_batch(df: DataFrame, schema: str, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]]) -> DataFrame:
    """``mapInArrow`` with one state per task: ``make()`` runs in the task and returns a function from the columns of a
    batch (as lists) to the columns of its result."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                out = step({c: part.column(i).to_pylist() for i, c in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, schema)


def exchanged(df: DataFrame) -> DataFrame:
    """``df`` dealt out anew, so that a join by its key has exchanges on both sides and adaptive execution can split a
    hot key there (an aggregate's own partitioning would be kept and couldn't be split). For small sides only."""
    return df.hint("rebalance")
