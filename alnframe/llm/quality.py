"""Quality rules: repetition and length rules, and how far a document's histograms are from its language's.

The references are the histograms of character classes and of common words over all documents of a language. A
document's distance is the Jensen-Shannon distance (square root of the divergence in bits); it counts only from a least
length on, and its limit is wider for short texts, whose histograms are rough.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .words import per_batch, shingles, word_hashes

#: Common words of a language, the most frequent ones: so many have a bin of their own, all others share one.
COMMON = 64
#: Words from which on distances are judged, words a language needs for a reference of its own.
GUARD, REFERENCE = 50, 20_000
#: Limits of the distances for long texts; for a text of n words that of words is higher by ROUGH / sqrt(n), that of
#: characters by a sixth of it.
LIMIT_CHARS, LIMIT_WORDS, ROUGH = 0.25, 0.30, 2.0

SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "other letter", "other")


def char_class() -> np.ndarray:
    """Number in CLASSES of each code point."""
    table = np.full(0x110000, CLASSES.index("other"), np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.islower():
            table[c] = 0
        elif ch.isupper():
            table[c] = 1
        elif ch.isalpha():
            table[c] = CLASSES.index("other letter")
        elif ch.isdigit():
            table[c] = 2
        elif ch.isspace():
            table[c] = 3
    for ch in ".,;:!?'\"()-":
        table[ord(ch)] = 4
    for ch in SYMBOLS:
        table[ord(ch)] = 5
    return table


@dataclass
class Reference:
    chars: np.ndarray
    #: sorted hashes of the common words, and their shares and that of all other words
    hashes: np.ndarray
    shares: np.ndarray


@dataclass
class References:
    of: dict[str, Reference] = field(default_factory=dict)
    all: Reference | None = None


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, kind, key, n): characters of each class, all words, and each word."""
    def make() -> Callable:
        classes = char_class()

        def step(cols: dict) -> dict:
            by: dict = {}
            for lang, t in zip(cols["lang"], cols["text"], strict=True):
                chars, words = by.setdefault(lang, (np.zeros(len(CLASSES), np.int64), Counter()))
                chars += np.bincount(classes[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=len(CLASSES))
                words.update(t.encode().split())
            rows = []
            for lang, (chars, words) in by.items():
                rows += [(lang, "char", str(i).encode(), n) for i, n in enumerate(chars.tolist())]
                rows.append((lang, "words", b"", sum(words.values())))
                rows += [(lang, "word", w, n) for w, n in words.items()]
            return {c: [r[i] for r in rows] for i, c in enumerate(("lang", "kind", "key", "n"))}

        return step

    rows = docs.select("lang", F.coalesce("text", F.lit("")).alias("text"))
    return per_batch(rows, "lang string, kind string, `key` binary, n long", make).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def references(docs: DataFrame) -> References:
    """References of all documents, and of each language with REFERENCE words or more. The driver gets some 70 numbers a
    language; all counts are summed, and the common words of a language and of all documents chosen, by Spark from every
    word."""
    counts = _counted(docs).withColumn("whole", F.lit(False))
    whole = counts.groupBy(F.lit(None).cast("string").alias("lang"), "kind", "key").agg(F.sum("n").alias("n")).withColumn("whole", F.lit(True))
    best = Window.partitionBy("whole", "lang", "kind").orderBy(F.desc("n"), "key")
    few = (counts.filter("lang IS NOT NULL").unionByName(whole)
           .withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= COMMON).drop("_r").collect())
    by: dict = {}
    for r in few:
        by.setdefault(r.lang, {}).setdefault(r.kind, Counter())[bytes(r.key)] += r.n
    out, hashes = References(), word_hashes()
    for lang, kinds in by.items():
        total = sum(kinds.get("words", {}).values())
        if total < (1 if lang is None else REFERENCE):
            continue
        chars = np.array([kinds["char"][str(i).encode()] for i in range(len(CLASSES))], float)
        words = kinds.get("word", {}).items()
        own = hashes([w for w, _ in words])
        order = np.argsort(own)
        shares = np.array([n for _, n in words], float)[order]
        ref = Reference(chars / chars.sum(), own[order], np.append(shares, total - shares.sum()) / total)
        if lang is None:
            out.all = ref
        else:
            out.of[lang] = ref
    return out


def distance(counts: np.ndarray, shares: np.ndarray) -> float:
    """Jensen-Shannon distance of a histogram from a distribution: 0 to 1; 0 for an empty histogram."""
    total = counts.sum()
    if not total:
        return 0.0
    p = counts / total
    m = (p + shares) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(shares > 0, shares * np.log2(shares / m), 0)
    return float(max(parts.sum() / 2, 0) ** 0.5)


def measures(text: str, hashes: Callable) -> tuple[dict, np.ndarray]:
    """The counts of the base rules, and the word hashes."""
    raw = text.encode()
    words = raw.split()
    own = hashes(words)
    repeated = 0
    if len(own) >= 3:
        _, row, times = np.unique(shingles(own, 3), return_inverse=True, return_counts=True)
        twice = times[row] > 1
        covered = np.zeros(len(own), bool)
        for j in range(3):
            covered[j : len(own) - 2 + j] |= twice
        repeated = int(covered.sum())
    lines = [x for x in raw.split(b"\n") if x.split()] if b"\n" in raw else []
    return {"n_words": len(words), "word_chars": len(b"".join(words).decode()), "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated}, own


def judge(docs: DataFrame, refs: References) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance,
    kept): a row for each row of ``docs`` (doc_id, text, lang).

    base_failed: fewer than 50 words, or more than half of the words in 3-word windows that stand twice or more.
    Not kept: base_failed, or from GUARD words on a distance over its limit. A language without a reference, or null, is
    held against that of all documents. A null text counts as empty.
    """
    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
              "char_distance double, word_distance double, kept boolean")

    def make() -> Callable:
        hashes, classes = word_hashes(), char_class()

        def step(cols: dict) -> dict:
            out: dict = {c.split()[0]: [] for c in schema.split(", ")}
            for doc_id, t, lang in zip(cols["doc_id"], cols["text"], cols["lang"], strict=True):
                t = t or ""
                found, own = measures(t, hashes)
                n = found["n_words"]
                ref = refs.of.get(lang, refs.all)
                char, word = 0.0, 0.0
                if n and ref:
                    char = distance(np.bincount(classes[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=len(CLASSES)), ref.chars)
                    at = np.searchsorted(ref.hashes, own)
                    at[at == len(ref.hashes)] = 0
                    common = ref.hashes[at] == own if len(ref.hashes) else np.zeros(n, bool)
                    counts = np.bincount(at[common], minlength=len(ref.hashes) + 1)
                    counts[-1] = n - common.sum()
                    word = distance(counts, ref.shares)
                failed = n < 50 or 100 * found["n_repeat_words"] > 50 * n
                more = ROUGH / max(n, 1) ** 0.5
                odd = n >= GUARD and (char > LIMIT_CHARS + more / 6 or word > LIMIT_WORDS + more)
                row = found | {"doc_id": doc_id, "base_failed": failed, "char_distance": char, "word_distance": word, "kept": not failed and not odd}
                for c in out:
                    out[c].append(row[c])
            return out

        return step

    return per_batch(docs.select("doc_id", "text", "lang"), schema, make)
