"""Secret scans with SQL functions alone.

Spans of fixed patterns come from ``regexp_extract_all`` and ``split`` (matches and the gaps between them; their summed
lengths are the positions). Further candidates, runs of key-like characters, are judged by the Shannon entropy of a
window that slides over them: its counts and the sum of ``c * log2(c)`` change by the character that enters and the one
that leaves. Entropy is taken per character class (hexadecimal, base64), each with its own limit; an allow list
suppresses candidates that are known not to be secrets.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: name, pattern, group whose length counts, least length. In the order in which spans at one start are listed.
PATTERNS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
#: Where a kind can be found at all; the full pattern runs on these texts only. Runs too short to count are no match.
FOUND = {"assign": PATTERNS[0][1], "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
#: A greedy run of one class is as long as it can be, so asking for the least length finds the same spans.
SCAN = {"assign": PATTERNS[0][1], "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}

ENTROPY = "entropy"
WINDOW = 20


@dataclass(frozen=True)
class CharClass:
    name: str
    alphabet: str       # position in it is the character's index
    run: str            # pattern of a candidate
    has: tuple          # patterns that a candidate must hold
    limit: float        # bits; a window at or over it is a secret


CLASSES = (
    CharClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", r"[A-Za-z0-9+/_-]{20,}",
              ("[a-z]", "[A-Z]", "[0-9]"), 3.95),
    CharClass("hexadecimal", "0123456789abcdefABCDEF", r"(?<![A-Za-z0-9+/_-])[0-9a-fA-F]{20,}(?![A-Za-z0-9+/_-])",
              ("[a-fA-F]", "[0-9]"), 3.05),
)
#: Candidates that hold one of these are no secrets: placeholders, UUIDs, dates and paths of words.
ALLOWED = (r"(?i)example|placeholder|changeme|your[_-]|dummy|sample|redacted",
           r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
           r"(?i)^[a-z]*[/_-]?\d{4}-\d\d-\d\d[a-z0-9-]*$",
           r"^(/?[A-Za-z]+\d{0,2}[/_-])+[A-Za-z]*\d{0,4}$")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it and whatever is inlined."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """Sums of the elements before each element, by blocks of 256 so that long arrays are not copied once per element."""
    block = 256
    starts = F.filter(F.sequence(F.lit(0), F.size(lengths)), lambda i: (i % block == 0) & (i < F.size(lengths)))

    def sums(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    inner = F.transform(starts, lambda i: sums(F.slice(lengths, i + 1, block)))
    return let(inner, lambda parts: let(sums(F.transform(parts, lambda s: F.element_at(s, -1))), lambda before: F.flatten(
        F.transform(parts, lambda s, i: F.transform(F.slice(s, 1, F.size(s) - 1), lambda x: x + F.get(before, i))))))


def _matches(text: Column, kind: int, scan: str, where: str, group: int, least: int) -> Column:
    """Array of (start, kind, end, value) of every match long enough; positions by the lengths of matches and gaps."""
    all_of = lambda g: F.regexp_extract_all(text, F.lit(scan), F.lit(g))
    found = F.struct(all_of(0).alias("m"), all_of(group).alias("v"), F.split(text, scan, -1).alias("g"))

    def spans(x: Column) -> Column:
        lengths = F.transform(x["m"], lambda m, i: (F.length(F.get(x["g"], i)) + F.length(m)).cast("long"))
        return let(lengths, lambda own: let(_running(own), lambda before: F.transform(x["m"], lambda m, i: let(
            F.get(before, i) + F.length(F.get(x["g"], i)), lambda start: F.struct(
                start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(m)).alias("end"), F.get(x["v"], i).alias("value"))))))

    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    return F.when(text.rlike(where), F.filter(let(found, spans), lambda s: F.length(s["value"]) >= least)).otherwise(none)


def window_entropy(value: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Largest Shannon entropy in bits of any ``window`` characters of ``value``, whose characters are in ``alphabet``;
    0 if it is shorter."""
    part = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    ids = F.transform(F.split(value, ""), lambda ch: F.instr(F.lit(alphabet), ch) - 1)
    zero = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("most"))

    def step(acc: Column, pair: Column) -> Column:
        came, left = pair["came"], pair["left"]
        gone = F.get(acc["counts"], left)
        after = F.when(left >= 0, acc["sum"] + F.get(part, gone - 1) - F.get(part, gone)).otherwise(acc["sum"])
        had = F.get(acc["counts"], came) - F.when(came == left, 1).otherwise(0)
        total = after + F.get(part, had + 1) - F.get(part, had)
        counts = F.transform(acc["counts"], lambda c, j: c + F.when(j == came, 1).otherwise(0) - F.when(j == left, 1).otherwise(0))
        now = F.when(pair["full"], F.lit(math.log2(window)) - total / window).otherwise(0.0)
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(acc["most"], now).alias("most"))

    pairs = F.transform(ids, lambda came, i: F.struct(
        came.alias("came"), F.when(i >= window, F.get(ids, i - window)).otherwise(-1).alias("left"), (i >= window - 1).alias("full")))
    return F.aggregate(pairs, zero, step, lambda acc: acc["most"])


def _random(text: Column, c: CharClass, known: Column) -> Column:
    """``known`` and the candidates of the class that meet none of it, are not allowed and have a window at the limit."""
    def test(s: Column) -> Column:
        ok = ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        for p in c.has:
            ok = ok & s["value"].rlike(p)
        for p in ALLOWED:
            ok = ok & ~s["value"].rlike(p)
        return F.when(ok, window_entropy(s["value"], c.alphabet) >= c.limit).otherwise(False)

    return F.concat(known, F.filter(_matches(text, len(PATTERNS), c.run, c.run, 0, WINDOW), test))


def secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (start, kind, end, value) by start and kind; code points, end exclusive.

    ``base`` holds what PATTERNS match (kind: position there); ``spans`` also what entropy finds (kind: after these),
    leaving out candidates that meet a base span or, for the second class, a span of the first. Null text: empty arrays.
    Other columns stay, but columns named base, spans or _found are replaced.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    base = F.array_sort(F.concat(*[_matches(source, k, SCAN[name], FOUND[name], group, least) for k, (name, _, group, least) in enumerate(PATTERNS)]))

    def both(b: Column) -> Column:
        first, second = CLASSES
        spans = let(_random(source, first, b), lambda known: _random(source, second, known))
        return F.struct(b.alias("base"), F.array_sort(spans).alias("spans"))

    return (docs.drop("base", "spans", "_found").withColumn("_found", let(base, both))
            .withColumns({"base": F.col("_found.base"), "spans": F.col("_found.spans")}).drop("_found"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(n) for n in [p[0] for p in PATTERNS] + [ENTROPY]])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(docs: DataFrame, text: str = "text", by: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced; spans that overlap are replaced together. Texts without any stay as they
    are, null stays null."""
    found = secret_spans(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text")))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    source = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substring(source, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(by))).otherwise("")
        return F.struct(F.concat(acc["out"], gap).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    def clean(spans: Column) -> Column:
        joined = F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(source, acc["at"].cast("int") + 1, F.length(source))))
        return F.when(F.size(spans) > 0, joined).otherwise(source)

    done = found.withColumn("clean", let(F.col("spans"), clean))
    return done.select(*[F.col("clean").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
