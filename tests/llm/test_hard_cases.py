"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from alnframe.llm import binary, langid, mixing, ominhash, packing, quality, secrets, substring, topk, urls
from alnframe.llm.words import n_words
from alnframe.session import shared_dir

from . import cases

TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))
OPERATORS = {
    "secrets": lambda s, d: secrets.secret_spans(d),
    "redacted": lambda s, d: secrets.redacted(d),
    "langid": lambda s, d: langid.identify(d),
    "mixing": lambda s, d: mixing.mix(d, n_words(F.col("text"))),
    "binary": lambda s, d: binary.encode_and_read(s, d, shared_dir(s, "t"), TOKENIZER),
    "quality": lambda s, d: quality.judge(d, quality.references(d)),
    "near": lambda s, d: ominhash.near_duplicates(d),
}
FEWER = {
    "repeats": lambda s, d: substring.repeats(d),
    "without_repeats": lambda s, d: substring.without_repeats(d),
    "packing": lambda s, d: packing.pack(d),
    "mixed": lambda s, d: mixing.mixed_rows(d, n_words(F.col("text"))),
    "one_of_each": lambda s, d: ominhash.one_of_each(d),
}


#: Columns that an operator's docstring says it replaces or makes; operators that return the columns of their input.
REPLACED = {"secrets": ("spans",), "mixing": ("size", "copies", "target", "source_size"), "quality": ("kept",), "langid": ("score",), "packing": ("size",), "repeats": ("start",),
            "binary": ("start",)}
WHOLE_ROWS = ("redacted", "without_repeats", "mixed", "one_of_each", "mixing", "secrets")


@pytest.mark.parametrize("name", [*OPERATORS, *FEWER])
def test_operator_on_hard_rows(spark, name):
    op = (OPERATORS | FEWER)[name]
    n = op(spark, cases.hard(spark)).count()
    clashing = op(spark, cases.clashing(spark))
    assert clashing.count() == n
    kept = [c for c in cases.CLASHING if c in clashing.columns and c not in REPLACED.get(name, ())]
    assert not kept or clashing.select(kept).distinct().collect() == [tuple("x" for _ in kept)]
    assert name not in WHOLE_ROWS or set(cases.CLASHING) <= set(clashing.columns)
    assert op(spark, cases.empty(spark)).count() == 0
    if name in OPERATORS:
        assert n == len(cases.hard_rows())


def test_near_duplicates_of_hard_rows(spark):
    got = {}
    for r in ominhash.near_duplicates(cases.hard(spark)).collect():
        got.setdefault(r.doc_id, set()).add(r.class_id)
    assert got[5] == got[6] == {5}
    assert got[7] == {7} and got[8] == {8} and got[1] == {1} and got[2] == {2} and got[3] == {3}
    kept = [r.doc_id for r in ominhash.one_of_each(cases.hard(spark)).collect()]
    assert sorted(x for x in kept if x) == [1, 2, 3, 4, 5, 7, 8, 8, 9, 10, 11, 12] and kept.count(None) == 2


def test_near_copies_without_an_id(spark):
    page, other = cases.prose(200, 11), cases.prose(150, 12)
    rows = [(3, page), (7, f"{page} one"), (9, f"{page} two more"), (None, f"{page} three"), (None, page.upper()),
            (11, cases.prose(150, 13)), (None, other), (None, f"{other} end"), (None, other), (None, ""), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], cases.SCHEMA)
    got = ominhash.near_duplicates(df).collect()
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    assert len(got) == len(rows) and sorted(classes[3], key=str) == [3, 7, 9, None, None] and classes[11] == [11]
    assert sorted(len(ids) for c, ids in classes.items() if c < 0) == [2, 3]
    kept = ominhash.one_of_each(df).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [3, 11]
    nameless = sorted(str(r.text) for r in kept if r.doc_id is None)
    assert len(nameless) == 3 and nameless[:1] == [""] and "None" in nameless and any(t.startswith(other) for t in nameless)


def test_repeats_of_hard_rows(spark):
    got = {(r.doc_id, r.first_doc_id, r.removable, r.n_words) for r in substring.repeats(cases.hard(spark)).collect()}
    assert got == {(5, 5, False, 60_000), (6, 5, True, 60_000)}


def test_language_of_texts_without_letters(spark):
    got = langid.identify(cases.hard(spark)).filter("doc_id IN (1, 2, 3, 10) OR doc_id IS NULL AND text IS NULL").collect()
    assert len(got) == 5 and all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in got)


def test_vectors(spark):
    rows = [(0, [0.5, -0.25], 1), (50, [0.5, -0.25], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1),
            (4, [float("inf"), 1.0], 1), (5, [1.0], 1), (5, [1.0], 1), (6, [1.0, 0.0, 2.0], 1), (None, [1.0, 1.0], 1), (7, [], 1), (8, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").withColumn("vector", topk.to_integers(F.col("embedding")))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    s = 128 * 256
    assert [tuple(r) for r in got if r.query_id == 0] == [(0, 1, 5, s), (0, 2, 5, s), (0, 3, 6, s), (0, 4, 8, s), (0, 5, 50, 128 * 128 + 64 * 64)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_pages(spark):
    rows = [(1, None, "<p>", "x"), (2, "no scheme", None, "x"), (3, "http://EXAMPLE.org:80", "", "x"), (4, "http://a.b/c?://d", "", "x"),
            (5, "x" * 100_000 + "://Ä.Org/", "", "x"), (5, "x://y", "", "x"), (None, "ftp:///path#f", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    rules = [("allow", "org", "/"), ("block", "b", "/c")]
    got = sorted((tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in urls.judge(df, rules).collect()), key=str)
    assert got == sorted([(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "example.org:80", "", None, "allow"), (4, "a.b", "/c", "b/c", "block"),
                          (5, "Ä.org", "/", "org/", "allow"), (5, "y", "", None, "allow"), (None, "", "/path", None, "allow")], key=str)
    assert urls.judge(df.limit(0), rules).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stage_on_hard_rows(spark, stage):
    name, run = corpus_pipeline.STAGES[stage]
    for df in (cases.hard(spark), cases.empty(spark)):
        out = run(spark, df, None)
        out.count()
        if name != "pack":
            assert out.columns == df.columns
