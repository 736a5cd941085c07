"""TG1-TG13: optional tags, strings, dates and record edits as column expressions.

Tags are ``MAP<STRING, STRUCT<type, s, i, f, bytes, ia, fa, atype>>``: ``type`` is the text
type letter (Z A i f H B), the value sits in the field of its kind, and ``atype`` is the
element type letter of a B array (c C s S i I f).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from ._col import col

# --- fixed values: integer ranges of B array element types ----------------------------
ARRAY_RANGES = {
    "c": (-128, 127),
    "C": (0, 255),
    "s": (-32768, 32767),
    "S": (0, 65535),
    "i": (-2147483648, 2147483647),
    "I": (0, 4294967295),
}
# Text type letters allowed in a tag field.
TAG_TYPES = ["Z", "A", "i", "f", "H", "B"]
# Tags that hold per-base values and are reversed/complemented with the read.
REVERSE_WITH_READ = ["OQ", "U2", "SQ", "E2"]
COMPLEMENT_WITH_READ = ["E2", "U2"]


def empty_tags() -> Column:
    return F.create_map().cast(S.TAGS_TYPE)


def _value(type_: Column, s=None, i=None, f=None, bytes_=None, ia=None, fa=None, atype=None) -> Column:
    def n(x, t):
        return (x if x is not None else F.lit(None)).cast(t)
    return F.struct(type_.alias("type"), n(s, "string").alias("s"), n(i, "bigint").alias("i"),
                    n(f, "float").alias("f"), n(bytes_, "binary").alias("bytes"),
                    n(ia, "array<bigint>").alias("ia"), n(fa, "array<float>").alias("fa"),
                    n(atype, "string").alias("atype"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: inside lambdas an expression is computed again wherever it stands."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _array_value(t: Column, parts: Column) -> Column:
    """The value of a B array from its comma-separated parts: the element type letter and the elements."""
    at = F.get(parts, 0)
    bounds = F.create_map(*[x for letter, r in ARRAY_RANGES.items() for x in (F.lit(letter), F.array(*[F.lit(n).cast("bigint") for n in r]))])

    def ints(xs: Column, r: Column) -> Column:
        bad = F.exists(xs, lambda x: x.isNull() | (x < F.get(r, 0)) | (x > F.get(r, 1)))
        return F.when(r.isNotNull() & ~bad, _value(t, ia=xs, atype=at))

    def floats(xs: Column) -> Column:
        return F.when(~F.exists(xs, lambda x: x.isNull()), _value(t, fa=xs, atype=at))

    elems = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return (F.when(at == "f", _let(F.transform(elems, lambda x: x.try_cast("float")), floats))
            .otherwise(_let(F.transform(elems, lambda x: x.try_cast("bigint")), lambda xs: _let(F.try_element_at(bounds, at), lambda r: ints(xs, r)))))


def parse_tag_value(type_letter, text) -> Column:
    """TG1: typed value struct from a type letter and the value text; NULL when invalid."""
    t, v = col(type_letter), col(text)
    return (F.when(t == "Z", _value(t, s=v))
            .when((t == "A") & (F.length(v) == 1), _value(t, s=v))
            .when(t == "i", _let(v.try_cast("bigint"), lambda n: F.when(n.between(-2147483648, 4294967295), _value(t, i=n))))
            .when(t == "f", _let(v.try_cast("float"), lambda x: F.when(x.isNotNull(), _value(t, f=x))))
            .when((t == "H") & v.rlike("^([0-9A-Fa-f]{2})*$"), _value(t, bytes_=F.unhex(v)))
            .when(t == "B", _let(F.split(v, ",", -1), lambda parts: _array_value(t, parts))))


def parse_tag(text) -> Column:
    """TG1: ``NAME:TYPE:VALUE`` -> struct(key, value); split on the first two colons only."""
    def parsed(p: Column) -> Column:
        ok = (F.size(p) == 3) & (F.length(F.get(p, 0)) == 2)
        return F.when(ok, F.struct(F.get(p, 0).alias("key"), parse_tag_value(F.get(p, 1), F.get(p, 2)).alias("value")))
    return _let(F.split(col(text), ":", 3), parsed)


def tags_from_parsed(parsed) -> Column:
    """Map from an array of parsed (key, value) entries: invalid entries dropped, and of
    repeated names the first one kept (a map cannot hold a name twice)."""
    fine = F.filter(col(parsed), lambda e: e.isNotNull() & e.value.isNotNull())
    first = _let(fine, lambda ok: F.filter(ok, lambda e, i: ~F.exists(F.slice(ok, 1, i), lambda q: q.key == e.key)))
    return F.coalesce(F.map_from_entries(first), empty_tags())


def tags_from_fields(fields) -> Column:
    """Map of parsed tags from an array of ``NAME:TYPE:VALUE`` strings (invalid ones dropped)."""
    return tags_from_parsed(F.transform(col(fields), lambda x: parse_tag(x)))


def _fmt_float(x: Column) -> Column:
    # Java prints floats like 1.5 / 3.0; Spark's cast to string matches for ordinary values.
    return x.cast("string")


def format_tag_value(v) -> Column:
    """TG2: the ``TYPE:VALUE`` text of a tag value struct."""
    v = col(v)
    arr = F.when(v.atype == "f", F.array_join(F.transform(v.fa, _fmt_float), ","))\
        .otherwise(F.array_join(F.transform(v.ia, lambda x: x.cast("string")), ","))
    return (F.when(v.type == "Z", F.concat(F.lit("Z:"), v.s))
            .when(v.type == "A", F.concat(F.lit("A:"), v.s))
            .when(v.type == "i", F.concat(F.lit("i:"), v.i.cast("string")))
            .when(v.type == "f", F.concat(F.lit("f:"), _fmt_float(v.f)))
            .when(v.type == "H", F.concat(F.lit("H:"), F.upper(F.hex(v.bytes))))
            .when(v.type == "B", F.concat(F.lit("B:"), v.atype,
                                          F.when(F.size(F.coalesce(v.ia, v.fa)) > 0, F.lit(",")).otherwise(""),
                                          arr)))


def tag_fields(tags) -> Column:
    """TG2: the ``NAME:TYPE:VALUE`` fields, keys in sorted order."""
    entries = F.sort_array(F.map_entries(col(tags)))
    return F.transform(entries, lambda e: F.concat(e.key, F.lit(":"), format_tag_value(e.value)))


def format_tags(tags) -> Column:
    """TG2: tab-joined fields, keys in sorted order."""
    return F.array_join(tag_fields(tags), "\t")


# --- TG3: typed getters ---------------------------------------------------------------

def _typed(v: Column, name: str, ok: Column, value: Column, cast: str, what: str, strict: bool) -> Column:
    """``value`` where the tag has the asked type; else NULL, or with ``strict`` an error. An absent tag is NULL."""
    if not strict:
        return F.when(ok, value)
    return F.when(v.isNull() | ok, value).otherwise(F.raise_error(F.lit(f"tag {name} is not {what}")).cast(cast))


def tag_int(tags, name: str, strict: bool = False) -> Column:
    v = col(tags).getItem(name)
    return _typed(v, name, v.type == "i", v.i, "bigint", "an integer", strict)


def tag_int_ranged(tags, name: str, lo: int, hi: int, strict: bool = False) -> Column:
    """Integer tag within [lo, hi] (a byte: -128 to 127, a short: -32768 to 32767); outside NULL, or with ``strict`` an error."""
    i = tag_int(tags, name, strict)
    return _typed(col(tags).getItem(name), name, i.between(lo, hi), i, "bigint", f"within {lo} to {hi}", strict)


def tag_string(tags, name: str, strict: bool = False) -> Column:
    v = col(tags).getItem(name)
    return _typed(v, name, v.type.isin("Z", "A"), v.s, "string", "a string", strict)


def tag_char(tags, name: str, strict: bool = False) -> Column:
    v = col(tags).getItem(name)
    return _typed(v, name, v.type == "A", v.s, "string", "a character", strict)


def tag_float(tags, name: str, strict: bool = False) -> Column:
    v = col(tags).getItem(name)
    return _typed(v, name, v.type == "f", v.f, "float", "a float", strict)


def tag_int_array(tags, name: str, strict: bool = False) -> Column:
    v = col(tags).getItem(name)
    return _typed(v, name, (v.type == "B") & (v.atype != "f"), v.ia, "array<bigint>", "an array of integers", strict)


def tag_float_array(tags, name: str, strict: bool = False) -> Column:
    v = col(tags).getItem(name)
    return _typed(v, name, (v.type == "B") & (v.atype == "f"), v.fa, "array<float>", "an array of floats", strict)


def tag_bytes(tags, name: str, strict: bool = False) -> Column:
    v = col(tags).getItem(name)
    return _typed(v, name, v.type == "H", v.bytes, "binary", "a byte string", strict)


# --- TG4: edits ----------------------------------------------------------------------

def string_tag(value) -> Column:
    return _value(F.lit("Z"), s=col(value))


def int_tag(value) -> Column:
    return _value(F.lit("i"), i=col(value))


def _set_value(name: str, value) -> Column:
    """A map of the one tag, empty for a NULL value; an array without elements is an error."""
    v = col(value).cast(S.TAG_VALUE)
    empty = (v.type == "B") & (F.coalesce(F.size(v.ia), F.lit(0)) + F.coalesce(F.size(v.fa), F.lit(0)) <= 0)
    v = F.when(empty, F.raise_error(F.lit(f"tag {name}: an array needs elements")).cast(S.TAG_VALUE)).otherwise(v)
    return F.when(v.isNull(), empty_tags()).otherwise(F.create_map(F.lit(name), v))


def set_tag(tags, name: str, value) -> Column:
    """Set ``name`` to a tag value struct; a NULL value removes the tag, an array without elements is an error."""
    return set_tags(tags, {name: value})


def set_tags(tags, values: dict) -> Column:
    """Several tags set, in this order, with one walk over the map."""
    kept = F.map_filter(col(tags), lambda k, _: ~k.isin(*values))
    return F.map_concat(kept, *[_set_value(name, value) for name, value in values.items()])


def remove_tag(tags, name: str) -> Column:
    return F.map_filter(col(tags), lambda k, _: k != F.lit(name))


def clear_tags(tags) -> Column:
    return empty_tags()


def list_tags(tags) -> Column:
    return F.array_sort(F.map_keys(col(tags)))


# --- TG5-TG13 -------------------------------------------------------------------------

def bytes_to_hex(b) -> Column:
    """TG5: upper-case hex."""
    return F.upper(F.hex(col(b)))


def hex_to_bytes(h) -> Column:
    """TG5: NULL for odd length or non-hex characters."""
    h = col(h)
    return F.when(h.rlike("^([0-9A-Fa-f]{2})*$"), F.unhex(h))


def truncate_sequence_name(name) -> Column:
    """TG6: name up to the first whitespace."""
    return F.regexp_extract(col(name), r"^(\S*)", 1)


# fixed values: accepted ISO-8601 layouts of the DT field, tried in this order. Layouts
# without a zone are read as UTC whatever the session time zone is.
ISO8601_ZONED = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mmXXX",
]
ISO8601_LOCAL = [
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd",
]
ISO8601_PATTERNS = ISO8601_ZONED + ISO8601_LOCAL


def parse_iso8601(text) -> Column:
    """TG7: timestamp (UTC when the text has no zone), truncated to whole seconds; NULL
    when unparsable."""
    t = col(text)
    zoned = [F.try_to_timestamp(t, F.lit(p)) for p in ISO8601_ZONED]
    local = [F.try_to_timestamp(F.concat(t, F.lit("+00:00")), F.lit(p + "XXX")) for p in ISO8601_LOCAL]
    return F.date_trunc("second", F.coalesce(*zoned, *local))


def format_utc(ts, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text of a timestamp in UTC, independent of the session time zone."""
    return F.date_format(F.to_utc_timestamp(col(ts), F.current_timezone()), pattern)


def resolve_mate_name(mate_ref_name, ref_name) -> Column:
    """TG8: ``=`` means the read's own reference."""
    return F.when(col(mate_ref_name) == "=", col(ref_name)).otherwise(col(mate_ref_name))


def upper_read_name(name) -> Column:
    """TG10."""
    return F.upper(col(name))


def record_label(read_name, flag, seq, ops) -> Column:
    """TG11: ``name[ 1/2] <n>b aligned|unmapped read.``"""
    from .cigar import read_length  # local import keeps module load order simple
    f = col(flag)
    paired = f.bitwiseAND(S.FLAG_PAIRED) != 0
    end = (F.when(paired & (f.bitwiseAND(S.FLAG_FIRST) != 0), F.lit(" 1/1"))
           .when(paired & (f.bitwiseAND(S.FLAG_SECOND) != 0), F.lit(" 2/2"))
           .otherwise(F.lit("")))
    n = F.when(col(seq) == S.NO_SEQ, F.lit(0)).otherwise(F.length(col(seq)))
    state = F.when(f.bitwiseAND(S.FLAG_UNMAPPED) != 0, F.lit("unmapped")).otherwise(F.lit("aligned"))
    return F.concat(col(read_name), end, F.lit(" "), n.cast("string"), F.lit("b "), state, F.lit(" read."))


def sort_key_text(order: str, read_name, ref_name, pos) -> Column:
    """TG13: coordinate ``ref:start``; queryname ``name``."""
    if order == "coordinate":
        return F.concat(col(ref_name), F.lit(":"), col(pos).cast("string"))
    return col(read_name)
