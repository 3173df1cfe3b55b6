import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from tessera.llm import token_counts as op

SF = "/root/testdata/sf0.001"


def greedy(word, initial, inner):
    """Longest match, piece by piece; -1 if stuck."""
    at, n, pieces = 0, 0, initial
    while True:
        fit = max((len(p) for p in pieces if word.startswith(p, at)), default=-1)
        if pieces is initial and fit <= 0:
            if b"" not in initial:
                return -1
            fit = 0
        if fit < 0:
            return -1
        at, n, pieces = at + fit, n + 1, inner
        if at == len(word):
            return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab", max_size=4), max_size=8), st.sets(st.text("ab", min_size=1, max_size=4), max_size=8),
       st.text("abc", min_size=1, max_size=14))
def test_counts_like_greedy(initial, inner, word):
    a, b = {x.encode() for x in initial}, {x.encode() for x in inner}
    assert op.Automaton(a, b).count(word.encode()) == greedy(word.encode(), a, b)


def test_like_word_piece_library():
    tokenizers = pytest.importorskip("tokenizers")
    rnd = random.Random(1)
    initial = {"".join(rnd.choices("abcd", k=rnd.randint(1, 5))) for _ in range(60)} | set("abcd")
    inner = {"".join(rnd.choices("abcd", k=rnd.randint(1, 5))) for _ in range(60)} | set("abc")
    vocab = {w: i for i, w in enumerate(["[UNK]", *sorted(initial), *("##" + x for x in sorted(inner))])}
    model = tokenizers.models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=1000)
    auto = op.Automaton([x.encode() for x in initial], [x.encode() for x in inner])
    for _ in range(500):
        w = "".join(rnd.choices("abcd", k=rnd.randint(1, 30)))
        ids = [t.id for t in model.tokenize(w)]
        assert (auto.count(w.encode()) if ids != [0] else -1) == (len(ids) if ids != [0] else auto.count(w.encode()))


def test_edge_cases_and_clashing_columns(spark):
    initial, inner = op.read_vocabulary()
    long = "naïve\tword " * 60_000
    rows = [Row(doc_id=1, text=None, n_tokens="x", _utf8=1), Row(doc_id=2, text="", n_tokens="x", _utf8=1),
            Row(doc_id=3, text=long, n_tokens=None, _utf8=None), Row(doc_id=3, text=long, n_tokens=None, _utf8=None),
            Row(doc_id=None, text="the the\x0bcat \x00", n_tokens=None, _utf8=2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, _utf8 int")
    out = op.token_counts(df, initial, inner)
    assert out.columns == ["doc_id", "text", "_utf8", "n_words", "n_tokens", "n_unknown"]
    got = sorted([(r.doc_id or 0, r.n_words, r.n_tokens, r.n_unknown) for r in out.collect()])
    a, b = set(initial), set(inner)
    per = greedy("naïve".encode(), a, b) + greedy(b"word", a, b)
    odd = 2 * greedy(b"the", a, b) + greedy(b"cat", a, b) + greedy(b"\x00", a, b)
    assert got == [(0, 4, odd, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 120_000, 60_000 * per, 0), (3, 120_000, 60_000 * per, 0)]
    assert op.token_counts(df.limit(0), initial, inner).count() == 0


def test_query_against_greedy(spark):
    initial, inner = map(set, op.read_vocabulary())
    memo = {}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op.q_token_counts(spark, SF).collect():
        if r.doc_id % 10:
            continue
        words = docs[r.doc_id].encode().split()
        for w in set(words) - set(memo):
            at, n, pieces = 0, 0, initial
            while at < len(w):
                fit = next((k for k in range(len(w), at - (pieces is initial), -1) if w[at:k] in pieces), at)
                at, n, pieces = fit, n + 1, inner
            memo[w] = n
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(memo[w] for w in words), 0)
