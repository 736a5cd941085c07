"""Cross-tokenizer alignment against the libraries on whole texts and a plain walk over both sequences."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from alnframe.llm import alignment, queries

from . import cases

SF = "/root/testdata/sf0.001"
A, B = (str(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["  lead trail  ", "a\n\nb \n c", "ﬁ é ① \x00 \t ▁", "▁", "x", "\n", "a\nb\nc d", "<|endoftext|> <s> </s> <unk> <0x41>", "  ", "日本 語　テ", "é ́x", "a  b  c",
       "\r\n a\r\n b", "don't I'll  x's we\nn't", "\U0001F600\U0001F601 a\U0001F602 b", "1 2 3 44 ²² ½ ", "a\x1cb \x1c c \x85 d", "aaa aaaa", None, "", "xyz " * 300, "_a _ b-_", "q" * 5000]
ODD += [x + y for x in ODD if x for y in ODD[:12] if y]


@pytest.fixture(scope="module")
def tools():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    symbols = alignment.byte_symbols()
    a_bytes = {i: bytes(symbols[c] for c in token) for token, i in t.get_vocab(with_added_tokens=False).items() if all(c in symbols for c in token)}
    b_bytes = [bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode() for i in range(s.get_piece_size())]
    return t, s, a_bytes, b_bytes


def walked(text, tools):
    """(ids of a, ids of b, groups, links) of a whole text; None without tokens."""
    t, s, a_bytes, b_bytes = tools
    if not text:
        return None
    a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
    if not b"".join(a_bytes[i] for i in a) == (" " + text).encode() == b"".join(b_bytes[i] for i in b):
        return None
    groups, links, i, j = [], [], 0, 0
    while i < len(a):
        first, other, end, at = i, j, len(a_bytes[a[i]]), len(b_bytes[b[j]])
        links.append((a[i], b[j]))
        while end != at:
            if end < at:
                i += 1
                end += len(a_bytes[a[i]])
            else:
                j += 1
                at += len(b_bytes[b[j]])
            links.append((a[i], b[j]))
        i, j = i + 1, j + 1
        groups.append((a[first:i], b[other:j]))
    return a, b, ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups), links


def wanted(texts, tools):
    found = [walked(t, tools) for t in texts]
    n, most = Counter(), defaultdict(int)
    for f in found:
        n.update(set(f[3]) if f else ())
    for (a, _), c in n.items():
        most[a] = max(most[a], c)
    return [(len(f[0]), len(f[1]), f[2].count(";") + 1, len(f[3]), sum(n[x] == most[x[0]] for x in f[3]), sum(n[x] for x in f[3]), f[2]) if f else (0, 0, 0, 0, 0, 0, "")
            for f in found]


def test_byte_symbols_cover_the_vocabulary(tools):
    t, _, a_bytes, _ = tools
    assert len(alignment.byte_symbols()) == 256 and set(a_bytes) >= set(range(50256))
    for text in ("Größe, naïve 漢字 \x00\x7f", "\U0001F600"):
        assert b"".join(a_bytes[i] for i in t.encode(text, add_special_tokens=False).ids) == text.encode()


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_corpus_against_whole_texts(spark, tools, broadcast_pairs):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(df, A, B, broadcast_pairs=broadcast_pairs).collect()}
    want = dict(enumerate(wanted(texts, tools)))
    assert got == want


def test_units_that_are_forgotten(tools, monkeypatch):
    monkeypatch.setattr(alignment, "_REMEMBERED", 3)
    monkeypatch.setattr(alignment, "_IN_A_ROW", 2)
    texts = [t for t in ODD if t][:60]
    for text, found in zip(texts, alignment.Aligner(A, B).align(texts), strict=True):
        want = walked(text, tools)
        assert (found is None) == (want is None)
        if want:
            assert found[0].decode() == want[2] and found[1].tolist() == [a << 32 | b for a, b in want[3]]


def test_tokenizers_that_cannot_be_cut(tools):
    aligner = alignment.Aligner(A, B)
    assert aligner.cuts
    aligner.cuts = False
    texts = [t for t in ODD if t][:30]
    for text, found in zip(texts, aligner.align(texts), strict=True):
        want = walked(text, tools)
        assert (found[0].decode() if found else None) == (want and want[2])


def test_pair_linked_both_alone_and_in_a_wider_group(spark, tools):
    texts = ["aa", "aaa", "aaa aa", "aaaaa aaaaaaa", "aa"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(df, A, B).collect()}
    assert got == dict(enumerate(wanted(texts, tools)))


def test_hard_rows(spark, tools):
    rows = cases.hard_rows()
    want = sorted(((r[0], *w) for r, w in zip(rows, wanted([r[1] for r in rows], tools), strict=True)), key=str)
    for df in (cases.hard(spark), cases.clashing(spark)):
        assert sorted(map(tuple, alignment.align(df, A, B).collect()), key=str) == want
    assert alignment.align(cases.empty(spark), A, B).count() == 0


def test_query(spark, tools):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_token_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = {r.doc_id: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for r, w in zip(docs, wanted([r.text for r in docs], tools), strict=True)}
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
