"""The audit of sources against brute force."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from alnframe.llm import divergence, queries
from alnframe.llm.oracles import ORACLES

from . import cases

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(rows, least, top):
    """rows: (text, lang, source); the result as the contract has it."""
    groups, documents = {}, {}
    for text, lang, source in rows:
        words = TERM.findall((text or "").translate(LOWER))
        groups.setdefault((lang or "", source or ""), Counter()).update(words)
        documents.setdefault(lang or "", Counter()).update(set(words))
    out = []
    for (lang, source), n in groups.items():
        kept = [t for t, d in documents[lang].items() if d >= least]
        v = len(kept)
        share = lambda c: {t: 1 + divergence.SCALE * (c[t] + divergence.PSEUDO) // (sum(c[x] for x in kept) + divergence.PSEUDO * v) for t in kept}  # noqa: E731,B023
        p = share(n)
        pairs = [(sum(abs(p[t] - q[t]) for t in kept), other) for (l, other), m in groups.items() if l == lang and other != source for q in [share(m)]]
        whole = Counter()
        for (l, _), m in groups.items():
            if l == lang:
                whole.update(m)
        q = share(whole)
        terms = [(p[t] - q[t], t) for t in kept if n[t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                out.append((lang, source, part, item, value, k))
    return sorted(out)


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß漢") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    rows = []
    for _ in range(n):
        s = int(rng.random() ** 2 * 7)
        text = " ".join(rng.choice(words[s : s + 40]).upper() if rng.random() < 0.1 else rng.choice(words[s : s + 40]) for _ in range(rng.randint(0, 30)))
        rows.append((text if rng.random() > 0.03 else None, rng.choice(["en", "de", None]), None if s == 6 else f"s{s}"))
    return rows + [("x1y_Z", "xx", "only"), ("", "yy", "a"), (None, "yy", "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_against_brute_force(spark, monkeypatch, seed):
    for name, value in (("_COUNTED", 50), ("_TERMS", 16), ("_SOURCES", 3), ("_POINTS", 20), ("_FAN", 2), ("_PART", 20)):
        monkeypatch.setattr(divergence, name, value)  # many blocks, flushes and merges
    rows = corpus(400, seed)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    got = divergence.audit(df, least=5, top=7).collect()
    assert sorted(map(tuple, got)) == audited(rows, 5, 7)


def test_terms_in_parts(monkeypatch):
    monkeypatch.setattr(divergence, "_PART", 3)
    text = "Aé b-c ÄD  x9y " + "q" * 50 + " \x00\x7fz漢字Z"
    assert [w for part in divergence.terms(text.encode()) for w in part] == [w.encode() for w in TERM.findall(text.translate(LOWER))]


def test_skyband_against_all_pairs():
    rng = np.random.default_rng(3)
    for k in (1, 2, 5):
        for size in (1, 40, 300):
            n, lang_n, term = rng.integers(1, 12, size), rng.integers(1, 12, size), rng.permutation(size)
            better = (n[None] >= n[:, None]) & (lang_n[None] <= lang_n[:, None]) & (term[None] < term[:, None])
            assert divergence.skyband(n, lang_n, term, k).tolist() == np.flatnonzero(better.sum(1) < k).tolist()


def test_shares_past_64_bits(spark):
    row = spark.range(1).select(divergence.share(*[divergence.F.lit(x).cast("long") for x in (4 * 10**15, 9 * 10**15, 10**7)]).alias("p")).first()
    assert row.p == 1 + 10**9 * (4 * 10**15 + 5) // (9 * 10**15 + 5 * 10**7)


def test_hard_rows(spark):
    got = sorted(map(tuple, divergence.audit(cases.hard(spark), least=2).collect()))
    assert got == audited([(r[1], r[2], r[3]) for r in cases.hard_rows()], 2, divergence.TOP)
    assert sorted(map(tuple, divergence.audit(cases.clashing(spark), least=2).collect())) == got
    assert divergence.audit(cases.empty(spark)).count() == 0


def test_query_and_sql(spark):
    got = sorted(map(tuple, queries.op11_source_divergence(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert got == sorted(con.sql(ORACLES["op11_source_divergence"]).fetchall())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source").collect()
    assert got == audited([tuple(r) for r in docs], divergence.LEAST_DOCUMENTS, divergence.TOP)
