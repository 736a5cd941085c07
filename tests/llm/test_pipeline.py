"""The pipeline against its stages done plainly."""

import re

import corpus_pipeline
from alnframe.llm import langid, mixing, ominhash, packing, secrets
from alnframe.llm.words import n_words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = corpus_pipeline.language_id(spark, docs, SF)
    rejected = {r.doc_id for r in langid.identify(docs).collect() if r.rejected}
    assert rows(a) == rows(docs.filter(~F.col("doc_id").isin(list(rejected) or [-1])))
    b = corpus_pipeline.near_dedup(spark, a, SF)
    classes = {r.doc_id: r.class_id for r in ominhash.near_duplicates(a).collect()}
    assert {r.doc_id for r in b.collect()} == set(classes.values())
    c = corpus_pipeline.secret_scan(spark, b, SF)
    assert c.count() == b.count() and secrets.secret_spans(c).filter("size(base) > 0").count() == 0
    before, after = ({r.doc_id: r for r in x.collect()} for x in (b, c))
    for r in secrets.secret_spans(b).collect():
        text, at = "", 0
        for s in sorted(r.spans):
            if s["start"] >= at:
                text += r.text[at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        want = text + r.text[at:] if r.spans else before[r.doc_id].text
        assert after[r.doc_id].text == want and after[r.doc_id].n_chars == len(want)
    d = corpus_pipeline.mix(spark, c, SF)
    times = {r.doc_id: r.copies for r in mixing.mix(c, n_words(F.col("text"))).collect()}
    got = {r.doc_id: r["count"] for r in d.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in times.items() if n}
    e = corpus_pipeline.pack(spark, d, SF)
    words = d.agg(F.sum(n_words(F.col("text")))).first()[0]
    assert e.agg(F.sum("size")).first()[0] == words
    assert e.groupBy("bin_id").agg(F.sum("size").alias("n")).filter(f"n > {packing.CAPACITY}").count() == 0
    assert e.groupBy("bin_id", "cluster").count().filter("count > 1").count() == 0


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "source", "cluster", "piece", "bin_id", "bin_offset", "size"] and got.count() > 0
    assert re.fullmatch(r"[a-z_]+", corpus_pipeline.STAGES[0][0])
