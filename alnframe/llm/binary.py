"""Token ids as binary shards with a minimal perfect hash index.

A shard holds the documents of a range of ids: a file of raw little-endian ids (16 bits where the vocabulary fits) and
an index file. The index maps each document to a slot by a minimal perfect hash; the slot keeps a fingerprint of the
key, and the start and the length of the document's ids in the shard. So one read of a few bytes finds a document.
"""

from __future__ import annotations

import io
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import kept_in_worker, mixed

_LEVELS = 64
#: Ids that are read at once.
_BLOCK = 1 << 21


# --- minimal perfect hash -------------------------------------------------------------------------------------------

def hash_keys(ids: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Key of each document: its id and how many rows with that id come before."""
    return mixed(ids.astype(np.int64).view(np.uint64)) + times.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


@dataclass
class PerfectHash:
    """Bit arrays of the levels, one after another, with their sizes. A key's slot is the number of set bits before its
    own bit, which stands in the first level where its position is set."""

    sizes: np.ndarray
    bits: np.ndarray
    before: np.ndarray

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        """For distinct keys: of each level's positions, those that one key alone has are set; other keys go on."""
        sizes, levels, left = [], [], keys
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("keys are not distinct")
            size = 2 * len(left) + 1
            at = _position(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        return PerfectHash(np.array(sizes, np.int64), bits, np.cumsum(bits) - bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that were not given to ``of``, any slot for others."""
        out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + _position(keys[left], level, size)
            here = self.bits[at]
            out[left[here]] = self.before[at[here]]
            left, base = left[~here], base + size
        return out


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


# --- encoding -------------------------------------------------------------------------------------------------------

#: Words and pieces that are remembered before a worker starts afresh; bounds its memory, not its result.
_REMEMBERED = 1_000_000
#: Pieces that are encoded at once.
_IN_A_ROW = 300
#: The normalizer and the pre-tokens for which words are encoded apart.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Ids of texts. Where the tokenizer's normalizer and pre-tokens are those above, no token spans ASCII white space:
    words of plain Latin characters are cut into their pre-tokens here, and new ones are encoded many in a row, told apart
    by the mark of a word's end; any other word is encoded by the library whole. Under another tokenizer whole texts are.
    What is known is kept as bytes."""

    def __init__(self, tokenizer_path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.type = np.dtype(f"<u{width}")
        with open(tokenizer_path, encoding="utf-8") as f:
            config = json.load(f)
        split = config.get("pre_tokenizer") or {}
        parts, model = split.get("pretokenizers") or [{}], config["model"]
        mark = model.get("end_of_word_suffix")
        self.apart = (config.get("normalizer") == _NORMALIZER and parts[0].get("pattern") == {"Regex": _PRE_TOKENS} and parts[0].get("invert") is True
                      and parts[0].get("behavior") == "Removed" and [p.get("type") for p in parts] == ["Split", "ByteLevel"] and not parts[1].get("add_prefix_space")
                      and not parts[1].get("use_regex") and bool(mark) and model.get("type") == "BPE" and not model.get("dropout")
                      and all(t["content"].startswith("<|") and not t["content"].split()[1:] for t in config.get("added_tokens", [])))
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.apart:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(mark)]] = True
        self.plain = regex.compile("[!-~À-ÿ]+").fullmatch
        self.cut = regex.compile(_PRE_TOKENS).findall
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.type) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        plain, others = [], []
        for w in words:
            text = w.decode()
            if self.plain(text) and "<|" not in text:
                plain.append((w, self.cut(text.lower())))
            else:
                others.append((w, text))
        distinct = dict.fromkeys(chain.from_iterable(pieces for _, pieces in plain))
        new = [p for p in distinct if p not in self.pieces]
        if len(self.pieces) + len(new) > _REMEMBERED:
            self.pieces.clear()
            new = list(distinct)
        rows = [new[at : at + _IN_A_ROW] for at in range(0, len(new), _IN_A_ROW)]
        for row, ids in zip(rows, self._encode([" ".join(r) for r in rows]), strict=True):
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()
            if len(ends) == len(row):
                raw = ids.tobytes()
                self.pieces.update(zip(row, (raw[x:y] for x, y in zip([0, *ends], ends, strict=False)), strict=True))
            else:
                self.pieces.update(zip(row, (x.tobytes() for x in self._encode(row)), strict=True))
        for w, pieces in plain:
            self.words[w] = b"".join([self.pieces[p] for p in pieces])
        self.words.update(zip((w for w, _ in others), (x.tobytes() for x in self._encode([t for _, t in others])), strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes, without special tokens."""
        if not self.apart:
            return [x.tobytes() for x in self._encode(texts)]
        words = [t.encode().split() for t in texts]
        distinct = dict.fromkeys(chain.from_iterable(words))
        new = [w for w in distinct if w not in self.words]
        if len(self.words) + len(new) > _REMEMBERED:
            self.words.clear()
            new = list(distinct)
        if new:
            self._learn(new)
        return [b"".join(map(self.words.__getitem__, own)) for own in words]


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: one without is in the cluster's default file system, not on an executor's disk."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(conf).makeQualified(path).toString()


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = folder.partition(":")
    if colon and scheme in ("s3a", "s3n"):
        folder = f"s3:{rest}"
    return fs.FileSystem.from_uri(folder) if colon else (fs.LocalFileSystem(), folder)


# --- shards ---------------------------------------------------------------------------------------------------------

MANIFEST = "shard long, n_docs long, n_tokens long, first_id long, last_id long"


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, vocabulary: int, text: str = "text") -> DataFrame:
    """Writes documents in ascending doc_id order (null first; ties by text) and returns the manifest (MANIFEST).

    Partitions of a range sort are the shards, ``shard-<number>.bin`` and ``.idx`` in ``folder``, which all executors
    share. A file is written under another name and then moved, so that a task that runs again replaces it by the same
    bytes. Null texts count as empty; every document ends with ``end_id``.
    """
    width, folder = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4, qualified(docs.sparkSession, folder)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder = TaskContext.get().partitionId(), kept_in_worker(("encoder", tokenizer_path, width), lambda: Encoder(tokenizer_path, width))
        end, (files, base) = np.array([end_id], encoder.type).tobytes(), _opened(folder)
        own, ids, lengths = f"{base}/.{uuid.uuid4().hex}", [], []
        out = None
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                out = out or files.open_output_stream(own + ".bin")
                ids += part.column(0).to_pylist()
                payloads = encoder.ids(part.column(1).to_pylist())
                lengths += [len(p) // width + 1 for p in payloads]
                out.write(end.join(payloads) + end)
        if out is None:
            return
        out.close()
        with files.open_output_stream(own + ".idx") as f:
            f.write(_index(ids, np.array(lengths, np.int64), width))
        for kind in (".bin", ".idx"):
            files.move(own + kind, f"{base}/shard-{shard:08d}{kind}")
        known = [i for i in ids if i is not None]
        row = {"shard": shard, "n_docs": len(ids), "n_tokens": sum(lengths), "first_id": min(known, default=None), "last_id": max(known, default=None)}
        yield pa.RecordBatch.from_pylist([row], schema=_schema(MANIFEST))

    files, base = _opened(folder)
    files.create_dir(base, recursive=True)
    return cut_lineage(rows.mapInArrow(write, MANIFEST))


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_()}[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _index(ids: list, lengths: np.ndarray, width: int) -> bytes:
    null = np.array([i is None for i in ids], bool)
    number = np.array([0 if i is None else i for i in ids], np.int64)
    number[null] = np.iinfo(np.int64).min
    times = np.zeros(len(ids), np.int64)
    same = np.zeros(len(ids), bool)
    same[1:] = number[1:] == number[:-1]  # in order, so rows of one id are neighbours
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
    times = np.arange(len(ids)) - first
    keys = hash_keys(number, times)
    hashed = PerfectHash.of(keys)
    slots = hashed.slots(keys)
    fingerprints, starts, counts = np.empty(len(ids), np.uint32), np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    fingerprints[slots], starts[slots], counts[slots] = _fingerprint(keys), np.cumsum(lengths) - lengths, lengths
    out = io.BytesIO()
    np.savez(out, width=np.int64(width), sizes=hashed.sizes, bits=np.packbits(hashed.bits), fingerprints=fingerprints,
             starts=starts, counts=counts, ids=number, null=np.packbits(null), times=times)
    return out.getvalue()


class Shard:
    """Reads one shard by key."""

    def __init__(self, folder: str, shard: int):
        files, base = _opened(folder)
        with files.open_input_file(f"{base}/shard-{shard:08d}.idx") as f:
            self.index = dict(np.load(io.BytesIO(f.read())))
        bits = np.unpackbits(self.index["bits"])[: int(self.index["sizes"].sum())].astype(bool)
        self.hash = PerfectHash(self.index["sizes"], bits, np.cumsum(bits) - bits)
        self.null = np.unpackbits(self.index["null"])[: len(self.index["ids"])].astype(bool)
        self.width = int(self.index["width"])
        self.file = files.open_input_file(f"{base}/shard-{shard:08d}.bin")

    def find(self, ids: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of the ids of each document; -1 and 0 for a key that the shard lacks."""
        keys = hash_keys(ids, times)
        at = self.hash.slots(keys)
        at[(at >= 0) & (self.index["fingerprints"][at] != _fingerprint(keys))] = -1
        return np.where(at >= 0, self.index["starts"][at], -1), np.where(at >= 0, self.index["counts"][at], 0)

    def blocks(self, starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """The ids of documents that follow one another, read some megabytes (or one document) at a time."""
        ends, at = starts + counts, 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, "right")))
            to = min(to, at + 2000)
            ids = self.read(int(starts[at]), int(ends[to - 1] - starts[at]))
            yield slice(at, to), np.split(ids, (ends[at : to - 1] - starts[at]))
            at = to

    def read(self, start: int, count: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(count * self.width, start * self.width), f"<u{self.width}")


def look_up(wanted: DataFrame, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, time, ids) of the keys (doc_id, time) that the shards hold; time numbers rows that repeat a doc_id. A
    task finds the shard of a key among the first ids of all shards, two numbers a shard; the shard's index finds the
    rest. A null doc_id is a key like others, before all."""
    least, folder = int(np.iinfo(np.int64).min), qualified(wanted.sparkSession, folder)
    shards = manifest.select("shard", F.coalesce("first_id", F.lit(least)).alias("first")).orderBy("first", "shard").toArrow()
    numbers, firsts = shards.column("shard").to_numpy(), shards.column("first").to_numpy().copy()
    if len(firsts):
        firsts[0] = least  # nulls, if any, are in the first
    keys = wanted.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("doc_id"), F.col("time").cast("long").alias("time"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(numbers):
                at = numbers[np.searchsorted(firsts, batch.column(0).to_numpy(), "right") - 1]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=["doc_id", "time", "shard"])

    def find(group: pa.Table) -> pa.Table:
        shard = Shard(folder, group.column("shard")[0].as_py())
        ids, times = (group.column(c).to_numpy() for c in ("doc_id", "time"))
        got = [(None if i == least else i, t, shard.read(s, c).tolist()) for i, t, s, c in zip(ids.tolist(), times.tolist(), *shard.find(ids, times), strict=True) if s >= 0]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
        return pa.table({n: pa.array([g[k] for g in got], kinds[k]) for k, n in enumerate(("doc_id", "time", "ids"))})

    near = keys.mapInArrow(place, "doc_id long, time long, shard long")
    salted = near.withColumn("salt", F.pmod(F.xxhash64("doc_id", "time"), F.lit(64)))
    return salted.groupBy("shard", "salt").applyInArrow(find, "doc_id long, time long, ids array<long>")


RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_back(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the shards, each found through its shard's index.
    ``start``: ids of all documents before it; the crc32 is that of its ids as little-endian 32-bit integers."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    folder = qualified(manifest.sparkSession, folder)
    shards = manifest.withColumn("before", before).select("shard", "before")  # a row for each shard
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                shard = Shard(folder, number)
                ids, times, null = shard.index["ids"], shard.index["times"], shard.null
                starts, counts = shard.find(ids, times)
                for s, own in shard.blocks(starts, counts):
                    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in own]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[s], mask=null[s]), pa.array(starts[s] + base), pa.array(counts[s]),
                                                      pa.array(crc, pa.int64())], schema=_schema(RESULT))

    return shards.repartition(n).mapInArrow(read, RESULT)


def encode_and_read(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, vocabulary: int | None = None) -> DataFrame:
    """Writes the shards and reads them back: see write_shards and read_back."""
    if vocabulary is None:
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab_size()
    return read_back(write_shards(docs, folder, tokenizer_path, end_id, vocabulary), folder)
