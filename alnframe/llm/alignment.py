"""Alignment of two tokenizers over a corpus: which ids of the one stand for which ids of the other.

A document's two token sequences are cut where both end at one byte; tokens of a group that overlap are linked. How many
documents hold a pair of ids linked is counted over the whole corpus. Most groups are one token on either side: an array
maps each id of the first tokenizer to the id of the second with the same bytes, and pairs it holds are counted in
vectors as long as the vocabulary. Other pairs alone are shuffled.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .words import exchanged, kept_in_worker

#: Units whose alignment a task remembers before it starts afresh; bounds its memory, not its result.
_REMEMBERED = 500_000
#: Units that are encoded at once.
_IN_A_ROW = 200
#: A table of pair counts up to this many rows is broadcast (about 100 bytes a row in memory); a longer one is joined by a shuffle.
BROADCAST_PAIRS = 1_000_000

#: A space or a line feed between two of these characters starts a unit.
_PLAIN = r"[!-~\w]"
_PLAIN_END = re.compile(rf"(?s).*{_PLAIN}\Z").match
_ODD_SPACE = re.compile(rf" (?:(?!{_PLAIN})|(?<!{_PLAIN} ))")
_AT_SPACE = re.compile(rf"(?<={_PLAIN})(?= {_PLAIN})")
_AT_LINE = re.compile(rf"(?<={_PLAIN})(?=\n{_PLAIN})")


# --- tokenizers -----------------------------------------------------------------------------------------------------

def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by the format's rule: printable
    Latin-1 characters stand for themselves, the other bytes for the characters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """The first tokenizer: byte-level BPE of the tokenizers library. Special tokens in a text are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        symbols = byte_symbols()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        split, model = config.get("pre_tokenizer") or {}, config["model"]
        #: Whether its pre-tokens start anew at a space, or a line feed, between two plain characters.
        self.cuts = (config.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                     and not split.get("add_prefix_space") and model.get("type") == "BPE" and not model.get("dropout")
                     and all(t.get("special") for t in config.get("added_tokens", [])))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """The second tokenizer: a sentencepiece model, which puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        normal = [p for i, p in enumerate(pieces) if not self.model.is_byte(i) and not self.model.is_control(i)]
        self.blank = self.model.piece_to_id("▁")
        #: Whether no piece holds a space after another character, or a line feed: then no token spans a cut.
        self.cuts = (self.bytes[self.blank] == b" " and not any("▁" in p.lstrip("▁") or "\n" in p for p in normal)
                     and self._keeps(" a  b c") and self._keeps("a\nb") and self.model.encode("\nb")[:1] == [self.blank])

    def _keeps(self, text: str) -> bool:
        return b"".join(self.bytes[i] for i in self.model.encode(text)) == b" " + text.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def same_bytes(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each id of the first vocabulary the least id of the second with the same bytes; -1 if there is none."""
    ids: dict[bytes, int] = {}
    for i, own in enumerate(b):
        ids.setdefault(own, i)
    return np.array([ids.get(own, -1) if own else -1 for own in a], np.int64)


# --- one text -------------------------------------------------------------------------------------------------------

class Aligner:
    """Aligns texts. A text is cut into units at spaces and line feeds where a token of either side must end; the tokens
    of a unit are found once. Where that can't be known of the tokenizers, a text is one unit."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.cuts = self.a.cuts and self.b.cuts
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.same = same_bytes(self.a.bytes, self.b.bytes)
        self.lengths = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        text = [f"{i}{end}".encode() for side, ends in ((self.a, ",|"), (self.b, ",;")) for end in ends for i in range(len(side.bytes))]
        self.text = np.array(text, object)  # an id with what comes after it, inside a side of a group or at its end

    def _encoded(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of both sides of texts that begin with a space; None where a side's bytes are not the text's."""
        out: list = []
        for t, a, b in zip(texts, self.a.encode(texts), self.b.encode([t[1:] for t in texts]), strict=True):
            raw = t.encode()
            same = b"".join([self.a.bytes[i] for i in a]) == raw == b"".join([self.b.bytes[i] for i in b])
            out.append((np.array(a, np.uint32), np.array(b, np.uint32)) if same else None)
        return out

    def _learn(self, units: list[str]) -> None:
        """Units are encoded many in a row, as a token of either side ends where one ends with a plain character and the
        next begins; those that don't are encoded alone."""
        inner = [u for u in units if _PLAIN_END(u)]
        rows = [inner[at : at + _IN_A_ROW] for at in range(0, len(inner), _IN_A_ROW)] + [[u] for u in units if not _PLAIN_END(u)]
        lead = ["" if row[0][0] == " " else " a" for row in rows]  # a unit that begins with a line feed has no space before it
        for row, first, ids in zip(rows, lead, self._encoded([x + "".join(row) for x, row in zip(lead, rows, strict=True)]), strict=True):
            sizes = np.cumsum([len(first), *(len(u.encode()) for u in row)])
            parts = ids and [self._split(own, n, sizes) for own, n in zip(ids, self.lengths, strict=True)]
            if parts and None not in parts:
                self.known.update(zip(row, zip(*parts, strict=True), strict=True))
            elif len(row) > 1:
                for u in row:
                    self._learn([u])
            else:
                self.known[row[0]] = None

    @staticmethod
    def _split(ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> list[bytes] | None:
        """The ids between the given byte positions; None if no token ends at one of them."""
        ends = np.concatenate([[0], np.cumsum(lengths[ids])])
        at = np.searchsorted(ends, sizes)
        if ends[-1] != sizes[-1] or not np.array_equal(ends[at], sizes):
            return None
        raw, at = ids.tobytes(), (at * 4).tolist()
        return [raw[x:y] for x, y in zip(at, at[1:], strict=False)]

    def _cut(self, text: str) -> list[str]:
        """The units of a text with a space before it; each begins with a space or a line feed."""
        if not self.cuts:
            return [" " + text]
        if _ODD_SPACE.search(text):
            units = _AT_SPACE.split(" " + text)
        else:
            units = [" " + w for w in text.split(" ")]
        if "\n" in text:
            units = [x for u in units for x in (_AT_LINE.split(u) if "\n" in u else (u,))]
        return units

    def linked(self, a: np.ndarray, b: np.ndarray) -> tuple[bytes, np.ndarray, int]:
        """The groups of two token sequences over the same bytes as text, the linked pairs (a * 2^32 + b) with repeats,
        and the number of groups. Between two neighbouring ends, of either side, lies what one pair shares."""
        (a_ends, b_ends), (a, b) = (np.cumsum(n[x]) for n, x in zip(self.lengths, (a, b), strict=True)), (a.astype(np.int64), b.astype(np.int64))
        ends = np.union1d(a_ends, b_ends)
        i, j = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        shared = (a_ends[i] == ends) & (b_ends[j] == ends)
        group, a_to, b_to = ends[shared], i[shared] + 1, j[shared] + 1
        a_group, b_group = np.searchsorted(group, a_ends), np.searchsorted(group, b_ends)
        code = np.empty(len(a) + len(b), np.int64)  # a group's ids of a, then those of b
        code[np.arange(len(a)) + np.concatenate([[0], b_to[:-1]])[a_group]] = a + (group[a_group] == a_ends) * len(self.a.bytes)
        code[np.arange(len(b)) + a_to[b_group]] = b + (group[b_group] == b_ends) * len(self.b.bytes) + 2 * len(self.a.bytes)
        return b"".join(self.text[code].tolist())[:-1], a[i] << 32 | b[j], len(group)

    def align(self, texts: list[str | None]) -> Iterator[tuple[bytes, np.ndarray, tuple[int, int, int]] | None]:
        """(groups as text, links, (tokens of a, tokens of b, groups)) of each text; None for a null or empty text, and
        where the joined bytes of a side differ from the text's."""
        for at in range(0, len(texts), 50):
            some = [self._cut(t) if t else [] for t in texts[at : at + 50]]
            distinct = dict.fromkeys(chain.from_iterable(some))
            new = [u for u in distinct if u not in self.known]
            if len(self.known) + len(new) > _REMEMBERED:
                self.known.clear()
                new = list(distinct)
            if new:
                self._learn(new)
            for units, text in zip(some, texts[at : at + 50], strict=True):
                found = [self.known[u] for u in units]
                if None in found:  # the bytes of a unit differ, those of the whole may not
                    found = [x and tuple(own.tobytes() for own in x) for x in self._encoded([" " + text])]
                if not found or found[0] is None:
                    yield None
                    continue
                a, b = (np.frombuffer(b"".join(side), np.uint32) for side in zip(*found, strict=True))
                groups, links, n = self.linked(a, b)
                yield groups, links, (len(a), len(b), n)


# --- the corpus -----------------------------------------------------------------------------------------------------

_PAIR = pa.struct([("pair", pa.int64()), ("times", pa.int32())])
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _lists(parts: list[np.ndarray], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), values)


def token_links(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups, same, same_times, pairs) of every row.

    ``groups``: the ids of the groups as text (``a1,a2|b1;a3|b2``), or the SHA-256 of that in lower-case hexadecimal;
    empty without tokens. ``same``: ids of the first tokenizer that are linked to the id with the same bytes, and how
    often; ``pairs``: other linked pairs (a * 2^32 + b) and how often. Null and empty texts, and those that a tokenizer
    doesn't give back byte by byte, have no tokens.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"k {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, same array<int>, same_times array<int>, "
              "pairs array<struct<pair:bigint,times:int>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, empty = kept_in_worker(("aligner", a_path, b_path), lambda: Aligner(a_path, b_path)), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                n, groups, same, same_times, pairs, times = [], [], [], [], [], []
                for found in aligner.align(part.column(1).to_pylist()):
                    own, links, counts = found or (b"", empty, (0, 0, 0))
                    n.append([*counts, len(links)])
                    groups.append((hashlib.sha256(own).hexdigest() if own else "") if digest else own.decode())
                    pair, often = np.unique(links, return_counts=True)
                    equal = aligner.same[pair >> 32] == (pair & 0xFFFFFFFF)
                    same.append(pair[equal] >> 32)
                    same_times.append(often[equal])
                    pairs.append(pair[~equal])
                    times.append(often[~equal])
                flat = lambda parts, kind: pa.array(np.concatenate(parts), kind)
                columns = [part.column(0), *(pa.array(c, pa.int64()) for c in np.array(n, np.int64).T), pa.array(groups, pa.string()),
                           _lists(same, flat(same, pa.int32())), _lists(same, flat(same_times, pa.int32())),
                           _lists(pairs, pa.StructArray.from_arrays([flat(pairs, pa.int64()), flat(times, pa.int32())], fields=list(_PAIR)))]
                yield pa.RecordBatch.from_arrays(columns, names=["k", *_COUNTS, "groups", "same", "same_times", "pairs"])

    found = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    return found.withColumnRenamed("k", key)


def same_counts(found: DataFrame, size: int) -> DataFrame:
    """(a, n): documents in which an id is linked to the id with the same bytes. A task counts in one vector."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)  # an id stands once in a document
        ids = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(n[ids])], names=["a", "n"])

    return found.select("same").mapInArrow(count, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))


def _vector(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """A vector from rows (a, column); as many as the vocabulary at most."""
    out = np.zeros(size, np.int64)
    got = rows.select("a", column).toArrow()
    out[got.column("a").to_numpy()] = got.column(column).to_numpy()
    return out


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False,
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row: see token_links.

    ``count_sum``: over the links, how many rows of the corpus hold the pair linked. ``n_best``: links whose count is
    the highest of their first id, ties included. Nulls and repeated rows, of text or key, are rows like others; a text
    is taken whole however long; no rows, no result; other columns play no part.
    """
    spark, aligner = docs.sparkSession, Aligner(a_path, b_path)
    size, folder = len(aligner.a.bytes), shared_dir(spark, "alignment")
    token_links(docs, a_path, b_path, key, text, digest).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/links")
    found = spark.read.parquet(f"{folder}/links")
    found.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).write.parquet(f"{folder}/pairs")
    pairs = spark.read.parquet(f"{folder}/pairs")
    same = same_counts(found, size)
    of_a = pairs.withColumn("a", F.shiftright("pair", 32).cast("int"))
    highest = same.unionByName(of_a.select("a", "n")).groupBy("a").agg(F.max("n").alias("most"))  # a row for each id
    n, most = _vector(same, "n", size), _vector(highest, "most", size)
    fields = ["row", key, *_COUNTS, "groups", "same_best", "same_sum"]
    kinds = dict(found.dtypes) | {"same_best": "long", "same_sum": "long"}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = (n == most).astype(np.int64)
        for batch in batches:
            *rest, same, times = batch.columns
            ids, often = same.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(same.value_lengths().to_numpy(zero_copy_only=False))
            before = lambda x: np.concatenate([[0], np.cumsum(x)])
            starts = np.concatenate([[0], ends[:-1]])
            sums = [pa.array((c := before(often * of[ids]))[ends] - c[starts], pa.int64()) for of in (top, n)]
            yield pa.RecordBatch.from_arrays([*rest, *sums], names=[f"c{k}" for k in range(len(rest) + 2)])

    own = found.select(*fields[:-2], "same", "same_times").mapInArrow(score, ", ".join(f"c{k} {kinds[c]}" for k, c in enumerate(fields))).toDF(*fields)
    counted = of_a.join(F.broadcast(highest), "a").select("pair", F.col("n").alias("pair_n"), (F.col("n") == F.col("most")).alias("top"))
    few = pairs.count() <= broadcast_pairs
    other = (found.select("row", F.inline("pairs")).join(F.broadcast(counted) if few else exchanged(counted), "pair").groupBy("row")
             .agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("pair_best"), F.sum(F.col("times") * F.col("pair_n")).alias("pair_sum")))
    whole = own.join(other, "row", "left")
    both = lambda x, y: F.col(x) + F.coalesce(y, F.lit(0).cast("long"))
    return whole.select(key, *_COUNTS, both("same_best", "pair_best").alias("n_best"), both("same_sum", "pair_sum").alias("count_sum"), "groups")
