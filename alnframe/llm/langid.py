"""Language identification by interpolated Kneser-Ney models of characters.

Counts of all four-letter sequences of the training texts are summed by Spark; counts of their shorter ends are numbers
of distinct extensions, as the smoothing asks. A sequence is kept under a hash below SLOTS, so that a model has a proven
size; the model of each order is a sorted array of hashes with the finished log probabilities of every language beside
it. A text goes to the language with the least cross-entropy per character, and is rejected where that is higher than
texts of the language have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import per_batch

ORDER = 4
#: Hashes of an order: it has at most so many sequences per language, whatever the corpus.
SLOTS = 2_097_143
#: Characters worked on at once; bounds a task's memory for texts of any length.
CHUNK = 125_000
#: One in so many labelled texts lies further above its language's usual than the limit before its margin.
RARE = 2_000
DISCOUNT = 0.75
#: The least limit of the rejection, in deviations.
LIMIT = 6.0
UNKNOWN = "und"

_A, _B = 402_653_189, 201_326_611


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: they have a language and are not held out."""
    return docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))


def _letters() -> np.ndarray:
    """Symbol of each code point: its lower case if it is a letter, else 0. Letters beyond U+FFFF share a symbol with
    the 255 beside them, so that four symbols fit 64 bits."""
    table = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            table[c] = low if low < 0x10000 else 0xE000 + ((low >> 8) & 0x1FFF)
    return table


def _grams(texts: list[str], letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each letter, and each run of other characters between or after letters (one symbol, 0): it and the three
    symbols before it as 64 bits, and the number of its text. In chunks."""
    at = 0
    while at < len(texts):
        first, size = at, 0
        while at < len(texts) and (size == 0 or size + len(texts[at]) <= CHUNK):
            size += len(texts[at]) + 2
            at += 1
        own = texts[first:at]
        lengths = np.fromiter(map(len, own), np.int64, len(own)) + 2
        symbols = letters[np.frombuffer("".join(f"\0{t}\0" for t in own).encode("utf-32-le", "surrogatepass"), np.uint32)]
        text = np.repeat(np.arange(first, at, dtype=np.int32), lengths)
        keep = symbols != 0
        keep[1:] |= keep[:-1]
        opening = np.cumsum(lengths) - lengths
        keep[opening] = True
        symbols, text = symbols[keep], text[keep]
        for lo in range(0, len(symbols), CHUNK):
            context = max(0, lo - ORDER + 1)
            s, t = symbols[context : lo + CHUNK].astype(np.uint64), text[context : lo + CHUNK]
            out = s.copy()
            for back in range(1, min(ORDER, len(s))):
                out[back:] |= np.where(t[back:] == t[:-back], s[:-back], np.uint64(0)) << np.uint64(16 * back)
            new = np.ones(len(s), bool)
            new[1:] = t[1:] == t[:-1]
            new[0] = False
            new[: lo - context] = False
            yield out[new], t[new]


def _ends(grams: np.ndarray, order: int) -> np.ndarray:
    return grams if order == ORDER else grams & np.uint64((1 << (16 * order)) - 1)


def _slot(grams: np.ndarray, order: int) -> np.ndarray:
    """Hash of the last ``order`` symbols; the arithmetic of _slot_sql, in which nothing overflows 63 bits."""
    grams = _ends(grams, order)
    return ((grams >> np.uint64(32)) * np.uint64(_A) + (grams & np.uint64(0xFFFFFFFF)) * np.uint64(_B)) % np.uint64(SLOTS)


def _slot_sql(gram: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(gram, 32) * _A + gram.bitwiseAND(F.lit(0xFFFFFFFF)) * _B, F.lit(SLOTS))


def gram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n): how often each four-letter sequence occurs in the texts of a language."""
    def make() -> Callable:
        letters = _letters()

        def step(cols: dict) -> dict:
            out: dict = {"lang": [], "gram": [], "n": []}
            by: dict = {}
            for language, t in zip(cols["lang"], cols["text"], strict=True):
                by.setdefault(language, []).append(t)
            for language, texts in by.items():
                parts = [np.unique(g, return_counts=True) for g, _ in _grams(texts, letters)]
                grams, row = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                out["lang"] += [language] * len(grams)
                out["gram"] += grams.view(np.int64).tolist()
                out["n"] += np.bincount(row, np.concatenate([p[1] for p in parts])).astype(np.int64).tolist()
            return out

        return step

    rows = docs.select(F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return per_batch(rows, "lang string, gram long, n long", make).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Per order: sorted hashes, and log probabilities with a row for each hash and a column for each language; the same
    for contexts with the log weights of the next shorter order."""

    langs: list[str]
    floor: float
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    logp: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    weight: dict[int, np.ndarray] = field(default_factory=dict)
    #: language: usual cross-entropy, its variance over texts, variance of a character's
    usual: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    limit: float = float("inf")

    def scores(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each gram's last symbol after those before it, a column for each language."""
        out = np.zeros((len(grams), len(self.langs)), np.float32)
        left = np.arange(len(grams))
        while order and len(left):
            at, found = _look_up(self.hashes[order], _slot(grams[left], order))
            out[left[found]] += self.logp[order][at[found]]
            left = left[~found]
            at, found = _look_up(self.contexts[order], _slot(grams[left] >> np.uint64(16), order - 1))
            out[left[found]] += self.weight[order][at[found]]
            order -= 1
        out[left] += np.float32(self.floor)
        return out


def _look_up(hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(hashes, wanted.astype(np.int32))
    at[at == len(hashes)] = 0
    return at, hashes[at] == wanted


def fit(docs: DataFrame, discount: float = DISCOUNT) -> Model | None:
    """The model of rows with text and lang; None if there is nothing to learn. Every count is summed by Spark; the
    driver gets at most SLOTS hashes for an order and language."""
    counts = cut_lineage(gram_counts(docs))
    tables = {}
    for order in range(ORDER, 0, -1):
        t = (counts.groupBy("lang", _slot_sql(F.col("gram")).alias("slot"))
             .agg(F.sum("n").alias("n"), F.min("gram").alias("gram")).toArrow())
        tables[order] = t.column("lang").to_pylist(), *(t.column(c).to_numpy() for c in ("slot", "n", "gram"))
        # of the next shorter order: in how many sequences of this one it is the end
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (16 * (order - 1))) - 1))
        counts = counts.groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n"))
    langs = sorted(set(tables[1][0]))
    if not langs:
        return None
    number = {x: i for i, x in enumerate(langs)}
    alphabet = len(np.unique(tables[1][1]))
    model = Model(langs, -float(np.log(2 * alphabet)))
    for order in range(1, ORDER + 1):
        names, slot, n, gram = tables[order]
        lang, gram = np.array([number[x] for x in names]), gram.astype(np.int64).view(np.uint64)
        in_order = np.lexsort((lang, gram, slot))  # rows come in any order; which sequence stands for a hash must not
        lang, slot, n, gram = lang[in_order], slot[in_order], n[in_order], gram[in_order]
        hashes, first, row = np.unique(slot, return_index=True, return_inverse=True)
        contexts, where = np.unique(_slot(gram >> np.uint64(16), order - 1), return_inverse=True)
        count, total, kinds = (np.zeros((len(x), len(langs))) for x in (hashes, contexts, contexts))
        np.add.at(count, (row, lang), n)
        np.add.at(total, (where, lang), n)
        np.add.at(kinds, (where, lang), 1)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        own = where[first]
        lower = np.exp(model.scores(gram[first], order - 1))
        p = np.maximum(count - discount, 0) / np.maximum(total[own], 1) + weight[own] * lower
        model.hashes[order], model.logp[order] = hashes.astype(np.int32), np.log(np.minimum(p, 1)).astype(np.float32)
        model.contexts[order], model.weight[order] = contexts.astype(np.int32), np.log(weight).astype(np.float32)
    return model


def calibrate(model: Model, docs: DataFrame) -> Model:
    """Sets the usual cross-entropy of each language and the limit, by all labelled texts that the model gets right. The
    limit is a quarter above what all but one in RARE of them have, LIMIT at least. Sums are exact, so reruns agree; the
    driver gets five sums a language and a few thousand counts."""
    got = cut_lineage(score(docs, model).filter("_n > 0 AND lang = lang_pred").select(
        "lang", "_n", F.round("_entropy", 9).alias("h"), F.round("_variance", 9).alias("v")))
    n, exact = F.col("_n").cast("decimal(12,0)"), "decimal(18,9)"
    sums = got.groupBy("lang").agg(F.count("*").alias("rows"), F.sum("_n").alias("n"), F.sum(n * F.col("h").cast(exact)).alias("h"),
                                   F.sum(n * F.round(F.col("h") * F.col("h"), 9).cast(exact)).alias("hh"), F.sum(n * F.col("v").cast(exact)).alias("v")).collect()
    for r in sorted(sums, key=lambda r: r.lang):
        if r.rows < 20:
            continue
        mean, of_char = float(r.h) / r.n, float(r.v) / r.n
        between = max(float(r.hh) / r.n - mean * mean - of_char * r.rows / r.n, 1e-4)
        model.usual[r.lang] = mean, between, of_char
    if model.usual:
        usual = F.create_map(*[x for lang, u in model.usual.items() for x in (F.lit(lang), F.struct(*[F.lit(y).alias(c) for y, c in zip(u, "mbv", strict=True)]))])
        u = usual[F.col("lang")]
        deviation = (F.col("h") - u["m"]) / F.sqrt(u["b"] + u["v"] / F.col("_n"))
        rare = _from_top(got.filter(u.isNotNull()).select(F.round(deviation * 1e6).cast("long").alias("x")), RARE)
        model.limit = max(LIMIT, 1.25 * rare / 1e6)
    return model


def _from_top(values: DataFrame, one_in: int) -> int:
    """The least of the integers ``x`` (below 2^62 either way) that at most one in ``one_in`` of them lie above: counts of
    ever finer stretches, in each pass of the one that the place falls into, so no task or driver holds the values."""
    shift, inside, above = 60, F.lit(True), None
    while True:
        counts = values.filter(inside).groupBy(F.shiftright("x", shift).alias("b")).agg(F.count("*").alias("n")).collect()
        if above is None:
            above = sum(r.n for r in counts) // one_in
        for r in sorted(counts, key=lambda r: -r.b):
            if r.n > above:
                break
            above -= r.n
        if not shift:
            return r.b
        inside, shift = F.shiftright("x", shift) == r.b, max(shift - 12, 0)


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, rejected, _n (symbols), _entropy (nats a symbol) and _variance; such columns are
    replaced.

    lang_pred is the language with the least cross-entropy per symbol, ties to the first by name; UNKNOWN if the text is
    null or has no letter, or nothing was learned (score 0, rejected). score is the softmax of the cross-entropies, taken
    as often as the text has symbols, 64 at most. rejected: further above the language's usual than the limit allows.
    """
    names = ["lang_pred", "score", "rejected", "_n", "_entropy", "_variance"]
    docs = docs.drop(*names)
    kept = [f for f in docs.schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string, score double, rejected boolean, _n long, _entropy double, _variance double"])

    def make() -> Callable:
        letters = _letters()

        def step(cols: dict) -> dict:
            texts = [t or "" for t in cols[text]]
            k = len(model.langs) if model else 0
            sums, squares, n = np.zeros((len(texts), k)), np.zeros((len(texts), k)), np.zeros(len(texts), np.int64)
            for grams, at in _grams(texts, letters) if k else ():
                if not len(at):
                    continue
                lo, width = int(at[0]), int(at[-1]) - int(at[0]) + 1
                s = model.scores(grams)
                n[lo : lo + width] += np.bincount(at - lo, minlength=width)
                for j in range(k):
                    sums[lo : lo + width, j] += np.bincount(at - lo, s[:, j], width)
                    squares[lo : lo + width, j] += np.bincount(at - lo, s[:, j] ** 2, width)
            out = dict(cols) | {c: [] for c in names}
            some = np.maximum(n, 1)[:, None]
            entropy, square = -sums / some, squares / some
            for i, m in enumerate(n.tolist()):
                if not m:
                    row = UNKNOWN, 0.0, True, 0, None, None
                else:
                    h = entropy[i]
                    best = int(h.argmin())
                    usual = model.usual.get(model.langs[best])
                    odd = usual is not None and h[best] - usual[0] > model.limit * (usual[1] + usual[2] / m) ** 0.5
                    row = (model.langs[best], float(1 / np.exp(-min(m, 64) * (h - h[best])).sum()), bool(odd), m,
                           float(h[best]), float(square[i, best] - h[best] ** 2))
                for c, value in zip(names, row, strict=True):
                    out[c].append(value)
            return out

        return step

    return per_batch(docs, schema, make)


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the training rows of ``docs`` and scores all of them (see ``score``). Empty table: no rows."""
    learn = training_rows(docs)
    model = fit(learn)
    if model:
        calibrate(model, learn.select("lang", "text"))
    return score(docs, model)
