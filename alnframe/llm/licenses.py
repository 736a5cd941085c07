"""License scans with SQL functions alone: a positional index of rare words.

Templates are short texts by which licences are told. Over all documents it is counted how many hold each of their
words; the rarest words of a template are posted with their positions in it. In a file the rarest posted words that it
holds are looked up: a posting less the word's place in the file is where the template would begin. Where several words
agree on a beginning, the template's key phrases must stand near it. Base phrases are templates of their own, found by
their rarest word and verified word by word.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .secrets import let

#: Between words: ASCII characters other than digits and letters.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """``phrases`` are parts of ``text`` that must stand in a file for it to count, near the place found."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return words_of(self.text)


def words_of(text: str) -> list[str]:
    return re.findall(_WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


#: phrase: label. A place counts wherever the words stand consecutively.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Common notices and the openings of common licence texts.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
             ("you may not use this file except in compliance with the license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Licensed under the MIT license", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
             ("with or without fee is hereby granted",)),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
             "Free Software Foundation", ("terms of the gnu general public license",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("epl", "made available under the terms of the Eclipse Public License", ("eclipse public license",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "licensed under the Creative Commons Attribution ShareAlike License", ("creative commons attribution sharealike",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
             ("waived all copyright and related or neighboring rights",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("free and unencumbered software released into the public domain",)),
)

#: Words of a template that are posted, at most and at least (if it has so many), and that share of its distinct words.
POSTED, LEAST_POSTED, POSTED_SHARE = 8, 3, 0.6
#: Posted words of a file that are looked up, the rarest first.
LOOKED_UP = 16
#: Different words that must agree on where a template begins.
AGREE = 2
#: Words before and after a template's place within which its key phrases may stand.
SLACK = 16


def n_words(text: Column) -> Column:
    """Number of words: runs of digits, ASCII letters and characters past U+007F. Null counts as the empty text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long")


def words(text: Column) -> Column:
    """The words, A to Z in lower case. May begin or end with an empty string, where the text does with a gap."""
    return F.split(F.translate(text, _UPPER, _LOWER), _GAP, -1)


def vocabulary(templates: tuple[Template, ...], base: tuple[tuple[str, str], ...]) -> list[str]:
    return sorted({w for t in templates for w in t.words} | {w for phrase, _ in base for w in phrase.split()})


def rarity(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE, text: str = "text") -> dict[str, float]:
    """The inverse document frequency of each word of the templates over all documents, log(1 + documents / (1 + those
    that hold it)). The driver gets a row for each word of the templates."""
    known = vocabulary(templates, base)
    held = docs.select(F.explode(F.array_append(F.array_intersect(words(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.array(*map(F.lit, known))), F.lit(None))).alias("word"))
    n = {r.word: r["count"] for r in held.groupBy("word").count().collect()}
    return {w: math.log(1 + n.get(None, 0) / (1 + n.get(w, 0))) for w in known}


def _rarest(candidates: set[str], idf: dict[str, float]) -> list[str]:
    return sorted(candidates, key=lambda w: (-idf[w], w))


def postings(templates: tuple[Template, ...], idf: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """word: (template, position) of each place of it in the templates of whose rarest words it is one."""
    out: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        distinct = set(template.words)
        n = min(POSTED, max(LEAST_POSTED, math.ceil(POSTED_SHARE * len(distinct))))
        for w in _rarest(distinct, idf)[:n]:
            out.setdefault(w, []).extend((t, k) for k, own in enumerate(template.words) if own == w)
    return out


def _at(found: Column, k: Column, phrase: list[str]) -> Column:
    """Whether the words of ``phrase`` stand from place ``k`` on."""
    ok = k >= 0
    for j, w in enumerate(phrase):
        ok = ok & F.coalesce(F.get(found, k + j) == w, F.lit(False))
    return ok


def scan(docs: DataFrame, idf: dict[str, float], templates: tuple[Template, ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE,
         text: str = "text") -> DataFrame:
    """``docs`` with n_words, ``places`` (array of (start, phrase): where a base phrase stands, words from 0), ``found``
    (array of (template, start, agreeing, share): verified templates, where they begin, how many of their words agreed
    on it and which share of their posted words that is), base_labels, labels (distinct, sorted) and score.

    score: the largest share of a verified template; 1 where a base phrase stands; else 0. Null text counts as empty;
    repeated rows are judged alike; columns of these names are replaced, others stay. No row depends on another.
    """
    index = postings(templates, idf)
    anchors = []
    for phrase, _ in base:
        own = phrase.split()
        word = _rarest(set(own), idf)[0]
        anchors.append((own, word, own.index(word)))
    used = sorted({*index, *(w for _, w, _ in anchors)})
    order = {w: k for k, w in enumerate(_rarest(set(index), idf))}
    posted = [sum(1 for w in index if any(t == k for k, _ in index[w])) for t in range(len(templates))]
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # a file without the longest word of any phrase has no label; lower() lets more through than translate(), never less
    keys = sorted({max(p.split(), key=lambda w: (len(w), idf.get(w, 0), w)) for t in templates for p in t.phrases} | {max(p.split(), key=lambda w: (len(w), w)) for p, _ in base})
    low = F.lower(source)
    may = F.lit(False)
    for w in keys:
        may = may | low.contains(w)

    posting = F.create_map(*[x for w, ps in index.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for t, k in ps]))])
    rank = F.create_map(*[x for w, r in order.items() for x in (F.lit(w), F.lit(r))])

    def judged(own: Column) -> Column:
        shift = F.when(F.get(own, F.lit(0)) == "", 1).otherwise(0)  # the text begins with a gap
        return let(F.slice(own, shift + 1, F.size(own)), inner)

    def inner(own: Column) -> Column:
        held = F.filter(F.transform(own, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(used))
        return let(held, lambda hits: F.struct(base_places(own, hits).alias("places"), candidates(own, hits).alias("found")))

    def base_places(own: Column, hits: Column) -> Column:
        def of(p: int, phrase: list[str], word: str, k: int) -> Column:
            starts = F.transform(F.filter(hits, lambda x: x["w"] == word), lambda x: F.struct((x["i"] - k).alias("start"), F.lit(p).alias("phrase")))
            return F.filter(starts, lambda s: _at(own, s["start"], phrase))

        return F.array_sort(F.concat(*[of(p, *anchor) for p, anchor in enumerate(anchors)]))

    def candidates(own: Column, hits: Column) -> Column:
        indexed = F.filter(hits, lambda x: F.element_at(rank, x["w"]).isNotNull())
        ranks = F.array_sort(F.array_distinct(F.transform(indexed, lambda x: F.element_at(rank, x["w"]))))
        limit = let(ranks, lambda r: F.get(r, F.least(F.size(r), F.lit(LOOKED_UP)) - 1))

        def begins(last: Column) -> Column:
            looked = F.filter(indexed, lambda x: F.element_at(rank, x["w"]) <= last)
            return F.flatten(F.transform(looked, lambda x: F.transform(F.element_at(posting, x["w"]), lambda p: F.struct(
                p["t"].alias("t"), (x["i"] - p["k"]).alias("start"), F.element_at(rank, x["w"]).alias("word")))))

        # sorted by template, beginning and word: the first of each run of one template and beginning knows its length
        ordered = F.array_sort(F.array_distinct(let(limit, begins)))
        return let(ordered, lambda all_: F.filter(F.transform(all_, lambda x, i: run(all_, x, i)), lambda c: (c["agreeing"] >= F.least(F.lit(AGREE), F.get(F.array(*map(F.lit, posted)), c["template"]))) & verified(own, c)))

    def run(all_: Column, x: Column, i: Column) -> Column:
        same = lambda y: F.coalesce((y["t"] == x["t"]) & (y["start"] == x["start"]), F.lit(False))
        opens = ~same(F.get(all_, i - 1))
        n = F.aggregate(F.slice(all_, i + 1, POSTED), F.lit(0), lambda acc, y: acc + F.when(same(y), 1).otherwise(0))
        share = F.least(F.lit(1.0), n / F.get(F.array(*map(F.lit, posted)), x["t"]))
        return F.struct(x["t"].alias("template"), x["start"].alias("start"), F.when(opens, n).otherwise(0).alias("agreeing"), share.alias("share"))

    def verified(own: Column, c: Column) -> Column:
        ok = F.lit(False)
        for t, template in enumerate(templates):
            low_, high = F.greatest(c["start"] - SLACK, F.lit(0)), c["start"] + len(template.words) + SLACK
            near = F.concat(F.lit(" "), F.array_join(F.slice(own, low_ + 1, F.greatest(high - low_, F.lit(0))), " "), F.lit(" "))
            ok = F.when(c["template"] == t, let(near, _holds(template.phrases))).otherwise(ok)
        return ok

    none = F.lit(None).cast("struct<places:array<struct<start:int,phrase:int>>,found:array<struct<template:int,start:int,agreeing:int,share:double>>>")
    names = ["n_words", "places", "found", "base_labels", "labels", "score"]
    out = (docs.drop(*names).withColumn("places", F.when(may, let(words(source), judged)).otherwise(none))
           .withColumns({"found": F.coalesce(F.col("places.found"), F.array().cast("array<struct<template:int,start:int,agreeing:int,share:double>>")),
                         "places": F.coalesce(F.col("places.places"), F.array().cast("array<struct<start:int,phrase:int>>"))}))
    base_name, name = (F.array(*[F.lit(x) for x in xs]) for xs in ([label for _, label in base], [t.label for t in templates]))
    own = F.array_distinct(F.transform("places", lambda p: F.get(base_name, p["phrase"])))
    more = F.transform("found", lambda c: F.get(name, c["template"]))
    return out.withColumns({"n_words": n_words(source), "base_labels": F.array_sort(own), "labels": F.array_sort(F.array_union(own, more)),
                            "score": F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("found", lambda c: c["share"])), F.lit(0.0)))})


def _holds(phrases: tuple[str, ...]):
    """A function that tells whether a text, of words between single spaces, holds all phrases."""
    def test(joined: Column) -> Column:
        ok = F.lit(True)
        for p in phrases:
            ok = ok & joined.contains(f" {p} ")
        return ok

    return test
