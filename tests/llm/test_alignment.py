import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from tessera.llm import alignment as op

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(op.BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=op.PIECES)


def brute(texts, libraries):
    """Every pair of tokens whose byte ranges overlap, found one by one."""
    a_lib, b_lib = libraries
    symbols = op.byte_symbols()
    docs = []
    for t in texts:
        docs.append(([], []))
        if not t:
            continue
        want = (" " + t).encode()
        a = [(i, bytes(symbols[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + t, add_special_tokens=False).ids]
        b = []
        for i in b_lib.encode(t):
            p = b_lib.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) == want == b"".join(x for _, x in b):
            docs[-1] = (a, b)
    spans, links, groups = [], [], []
    for a, b in docs:
        side = []
        for tokens in (a, b):
            at, own = 0, []
            for i, x in tokens:
                own.append((i, at, at + len(x)))
                at += len(x)
            side.append(own)
        spans.append(side)
        links.append([(i, j) for i, s, e in side[0] for j, u, v in side[1] if max(s, u) < min(e, v)])
        cuts = sorted({e for _, _, e in side[0]} & {e for _, _, e in side[1]})
        text, low = [], 0
        for c in cuts:
            text.append("|".join(",".join(str(i) for i, s, _ in own if low <= s < c) for own in side))
            low = c
        groups.append(";".join(text))
    count = Counter(p for x in links for p in x)
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(len(s[0]), len(s[1]), g.count(";") + 1 if g else 0, len(x), sum(count[p] == most[p[1]] for p in x),
             sum(count[p] for p in x), hashlib.sha256(g.encode()).hexdigest() if g else "", g)
            for s, x, g in zip(spans, links, groups)], count, most


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


def test_like_brute_force_with_edge_cases(spark, libraries):
    rnd = random.Random(3)
    texts = [None, "", " ", "\n\n", "a", "the the the", "naïve 漢字 \U0001F600 text", "a▁b", "<|endoftext|> </s> <s><0x41>",
             "tab\tand\x0b\x00 nul", "same words here", "same words here", "don't  stop   now ", "x" * 300,
             *("".join(rnd.choices("abc dé\n▁!1 the", k=rnd.randint(1, 60))) for _ in range(120))]
    want, count, most = brute(texts, libraries)
    assert [w[0] for w in want[:2]] == [0, 0] and want[7][0] == 0      # null, empty, U+2581
    rows = [Row(doc_id=i if i % 5 else None, text=t, n_a="x", block=i, pair=i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string, block int, pair int").repartition(3)
    got = op.aligned(df, with_groups=True)
    assert got.columns == ["doc_id", *FIELDS]
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        (i if i % 5 else None, *w) for i, w in enumerate(want))
    blocks = op.encoded_blocks(df)
    table = op.pair_table(op.pair_counts(blocks)[1])
    assert {(r.a, r.b): (r.n, r.best) for r in table.collect()} == {p: (n, n == most[p[1]]) for p, n in count.items()}


def test_identity_groups_leave_as_vectors(spark):
    """Pairs of the same bytes are counted in the task, not shuffled by block."""
    df = spark.createDataFrame([(i, "the house and the garden") for i in range(50)], "doc_id long, text string")
    pairs, counts = op.pair_counts(op.encoded_blocks(df))
    assert pairs.count() == 0
    assert sorted(r.n for r in counts.collect()) == [50, 50, 50, 100]


def test_small_blocks_like_large_ones(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = Counter(map(tuple, op.aligned(docs).collect()))
    monkeypatch.setattr(op, "BLOCK_BYTES", 20_000)
    assert Counter(map(tuple, op.aligned(docs.repartition(4)).collect())) == whole


def test_query_like_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs = [d for d in docs if len(d.text or "") < 20_000] + [d for d in docs if len(d.text or "") >= 20_000]
    a_lib, b_lib = libraries
    got = {r.doc_id: r for r in op.q_alignment(spark, SF).collect()}
    assert len(got) == len(docs)
    # all-pairs overlap is quadratic: long texts are counted by merged ends
    sizes = [np.array([len(t) for t in x]) for x in (op.byte_level(open(op.BYTE_LEVEL, "rb").read()).table,
                                                     op.pieces(open(op.PIECES, "rb").read()).table)]
    links = []
    for d in docs:
        a, b = a_lib.encode(" " + d.text, add_special_tokens=False).ids if d.text else [], b_lib.encode(d.text) if d.text else []
        ea, eb = np.cumsum(sizes[0][a]).tolist(), np.cumsum(sizes[1][b]).tolist()
        if (ea[-1:] or [0]) != (eb[-1:] or [0]) or "▁" in (d.text or ""):
            links.append((d.doc_id, [], [], [], 0))
            continue
        i = j = 0
        own = []
        while i < len(a):
            own.append((a[i], b[j]))
            step = ea[i], eb[j]
            i, j = i + (step[0] <= step[1]), j + (step[1] <= step[0])
        links.append((d.doc_id, a, b, own, len(set(ea) & set(eb))))
    count = Counter(p for x in links for p in x[3])
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    for i, a, b, own, n_groups in links:
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), n_groups, len(own))
        assert r.n_best == sum(count[p] == most[p[1]] for p in own) and r.count_sum == sum(count[p] for p in own)


def test_long_runs_like_the_library(libraries):
    a = op.byte_level(open(op.BYTE_LEVEL, "rb").read())
    for t in (" " + "ab" * 30_000, " " * 20_000 + "x", "\n" * 9000, " word" * 5000):
        assert list(a.encode(t)) == libraries[0].encode(t, add_special_tokens=False).ids


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.aligned(df).collect() == []
    assert op.aligned(spark.createDataFrame([(1, None)], "doc_id long, text string")).first().groups_sha256 == ""
