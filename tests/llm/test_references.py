"""References and limits come from all rows: language ID's calibration and the histograms of the quality rules."""

import numpy as np

from alnframe.llm import langid, quality
from alnframe.llm.words import word_hashes

from .cases import prose


def test_calibration_takes_every_labelled_text(spark):
    rows = [(i, "en", prose(3 + i % 40, i)) for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(8)
    model = langid.fit(docs)
    got = langid.score(docs, model).select("_n", "_entropy", "_variance").collect()
    n, h, v = np.array([tuple(r) for r in got]).T
    mean, of_char = np.average(h, weights=n), np.average(v, weights=n)
    between = max(np.average((h - mean) ** 2 - of_char / n, weights=n), 1e-4)
    deviations = np.sort((h - mean) / np.sqrt(between + of_char / n))
    langid.calibrate(model, docs)
    assert np.allclose(model.usual["en"], (mean, between, of_char), rtol=0, atol=1e-8)
    assert abs(model.limit - max(langid.LIMIT, 1.25 * deviations[-1 - len(rows) // langid.RARE])) < 1e-4


def test_place_from_the_top(spark):
    values = [-(1 << 50), -3, -3, 0, 5, 5, 5, 7, 1 << 40, 1 << 41]
    df = spark.createDataFrame([(x,) for x in values], "x long")
    for one_in in (1000, 10, 5, 3, 2):
        assert langid._from_top(df, one_in) == sorted(values)[-1 - len(values) // one_in]


def test_references_count_long_words_and_all_documents(spark):
    words = {lang: [f"{lang}{i}" for i in range(quality.COMMON)] for lang in ("de", "en")}
    rows = [(lang, " ".join(own * 10 + ["wonderful"] * 9)) for lang, own in words.items()] + [(None, "wonderful")]
    refs = quality.references(spark.createDataFrame(rows, "lang string, text string"))
    own = word_hashes()([b"wonderful"])[0]
    assert refs.all.shares[:-1][refs.all.hashes == own].tolist() == [19 / (2 * 649 + 1)] and len(refs.all.hashes) == quality.COMMON
    assert abs(refs.all.shares.sum() - 1) < 1e-12


def test_references_of_a_language_hold_its_long_words(spark):
    refs = quality.references(spark.createDataFrame([("en", "wonderful things " * quality.REFERENCE)], "lang string, text string"))
    assert set(refs.of["en"].hashes) == set(word_hashes()([b"wonderful", b"things"]))
