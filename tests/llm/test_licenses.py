"""License scans against brute force."""

import math
import re

import pytest

from alnframe.llm import licenses as L
from alnframe.llm import queries

from . import cases

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def scanned(text, idf, templates=L.TEMPLATES):
    """(n_words, base places, labels, score) by plain loops over every place of every template."""
    own = words(text)
    places = sorted((k, p) for p, (phrase, _) in enumerate(L.BASE) for k in range(len(own)) if own[k : k + len(phrase.split())] == phrase.split())
    index = L.postings(templates, idf)
    rarest = sorted(index, key=lambda w: (-idf[w], w))
    looked = set([w for w in rarest if w in own][: L.LOOKED_UP])
    shares = {}
    for t, template in enumerate(templates):
        mine = {w: [k for at, k in ps if at == t] for w, ps in index.items() if any(at == t for at, _ in ps)}
        for start in range(-len(template.words), len(own)):
            agreeing = sum(1 for w, ks in mine.items() if w in looked and any(0 <= start + k < len(own) and own[start + k] == w for k in ks))
            near = " " + " ".join(own[max(0, start - L.SLACK) : max(0, start + len(template.words) + L.SLACK)]) + " "
            if agreeing >= min(L.AGREE, len(mine)) and all(f" {p} " in near for p in template.phrases):
                shares[t] = max(shares.get(t, 0), min(1, agreeing / len(mine)))
    base = sorted({L.BASE[p][1] for _, p in places})
    return len(own), places, base, sorted({*base, *(templates[t].label for t in shares)}), 1.0 if places else max(shares.values(), default=0.0)


TEXTS = [
    None, "", "All rights reserved.", "ALL RIGHTS\n\nreserved all rights reserved, all rights reserved", "cc by cc by cc-BY 4.0", "CC  by", "ccby", "xcc by", "ça cc byé",
    "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.", "the Apache people took a License, version 1",
    "Released under the MIT License.", "mit einer Lizenz; license mit", "the general public license", "general public", "/* Permission is hereby granted, free of charge, to any "
    "person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction */",
    "Permission is hereby granted, free of charge, to some", "word " * 3000 + "under the terms of the GNU Lesser General Public License" + " word" * 3000,
    "This work is licensed under the GNU General Public License, version 3.", "licensed license under the the the mit of mit license license", "a" * 100_000 + " cc by",
    "This is free and unencumbered software released into the public domain; Licensed under the MIT license. Redistribution and use in source and binary forms, with or without modification",
    "License " * 400 + "mit license " * 50, "\0 all\x01rights\x7freserved", "1cc by2 cc by", "reserved rights all general license public by cc",
]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts = TEXTS + docs
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return texts, df, L.rarity(df)


def test_rarity(corpus):
    texts, _, idf = corpus
    known = {w for t in L.TEMPLATES for w in words(t.text)} | {w for p, _ in L.BASE for w in p.split()}
    assert set(idf) == known
    held = [set(words(t)) for t in texts]
    for w in known:
        assert math.isclose(idf[w], math.log(1 + len(texts) / (1 + sum(w in h for h in held))))


def test_scan_against_brute_force(corpus):
    texts, df, idf = corpus
    got = {r.doc_id: (r.n_words, [tuple(p) for p in r.places], r.base_labels, r.labels, r.score) for r in L.scan(df, idf).collect()}
    for i, text in enumerate(texts):
        want = scanned(text, idf)
        assert got[i][:4] == want[:4], (i, text and text[:60])
        assert math.isclose(got[i][4], want[4]), (i, text and text[:60])


def test_every_template_is_told_by_its_own_text(spark):
    rows = [(k, f"x y {t.text.replace(', ', ',')} z") for k, t in enumerate(L.TEMPLATES)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in L.scan(df, L.rarity(df)).collect():
        assert L.TEMPLATES[r.doc_id].label in r.labels and r.score == 1.0


def test_key_phrases_are_verified(spark):
    rows = [(1, "under the terms of the GNU Lesser General Private License"), (2, "Licensed under CC BY ND"), (3, "cc nc licensed 4 under by 0"), (4, "The MIT students need no licensed license, under no version")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.labels for r in L.scan(df, L.rarity(df)).collect()}
    assert got == {1: [], 2: ["cc-by", "cc-by-nd"], 3: [], 4: []}


def test_hard_rows(spark):
    df, clashing = cases.hard(spark), cases.clashing(spark)
    idf = L.rarity(df)
    want = sorted(((r[0], *scanned(r[1], idf)) for r in cases.hard_rows()), key=str)
    for docs in (df, clashing):
        out = L.scan(docs, idf)
        assert sorted(((r.doc_id, r.n_words, [tuple(p) for p in r.places], r.base_labels, r.labels, r.score) for r in out.collect()), key=str) == want
    assert L.scan(clashing, idf).select("key").distinct().first().key == "x"
    assert L.scan(cases.empty(spark), L.rarity(cases.empty(spark))).count() == 0


def test_query_runs_no_python(spark):
    got = queries.op13_license_scan(spark, SF)
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in got.collect():
        n, places, base, _, _ = scanned(texts[r.doc_id], {}, ())
        starts = [k for k, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(base))
        assert set(base) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
