import math
import re

import numpy as np
import pytest
from pyspark.sql import Row

from tessera.llm import ranked_search as op

SF = "/root/testdata/sf0.01"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) of every item, in plain Python."""
    own = [(i, terms(t)) for i, t in docs]
    N, L = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    counts = []
    df = {}
    for _, t in own:
        c = {}
        for x in t:
            c[x] = c.get(x, 0) + 1
        counts.append(c)
        for x in c:
            df[x] = df.get(x, 0) + 1
    out = []
    for item_id, text in items:
        w = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if t in df}
        found = []
        for (i, t), c in zip(own, counts):
            m = 100 - 50 + (50 * len(t) * N) // L if L else 0
            s = sum(x * ((1000000000 * c[q]) // (1000 * c[q] + 20 * m)) for q, x in w.items() if q in c)
            if s > 0:
                found.append((-s, i is None, i, s))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, r + 1, i, s) for r, (_, _, i, s) in enumerate(found[:k])]
    return sorted(out, key=str)


def frames(spark, docs, items):
    d = spark.createDataFrame([Row(doc_id=i, text=t, score=1, item_id="x") for i, t in docs], "doc_id long, text string, score int, item_id string")
    q = spark.createDataFrame([Row(item_id=i, text=t, doc_id=0, rank=0) for i, t in items], "item_id long, text string, doc_id int, rank int")
    return d, q


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def made(seed, n, words, longest):
    r = np.random.default_rng(seed)
    return [(int(i), " ".join(f"w{x}" for x in r.zipf(1.3, r.integers(1, longest)) % words)) for i in range(n)]


def test_like_brute_force(spark):
    docs = made(1, 400, 300, 60) + [(1000 + i, "Same WORDS, w1-w2 w3!") for i in range(90)]
    docs += [(None, "w1 w2 w250"), (None, "w1 w2 w250"), (5, "w7 w7 w7"), (2000, None), (2001, ""), (2002, "?! ..."), (2003, "é漢字 É w1\x00w2"),
             (2004, "w9 " * 50_000)]
    items = made(2, 30, 300, 20) + [(7, "same words w1"), (7, "same words w1"), (None, "É w250"), (90, None), (91, ""), (92, "unknown"), (93, "w9 w7")]
    want = brute(docs, items, 50)
    for parts in (1, 7):
        d, q = frames(spark, docs, items)
        out = op.ranked_search(d.repartition(parts), q)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert got(out) == want
    assert got(op.ranked_search(d, q, k=3)) == brute(docs, items, 3)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "ITEM_ROWS", 10)
    monkeypatch.setattr(op, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(op, "SEED_BLOCKS", 4)
    docs, items = made(3, 600, 500, 40), made(4, 25, 500, 12)
    d, q = frames(spark, docs, items)
    assert got(op.ranked_search(d.repartition(3), q, k=7)) == brute(docs, items, 7)


def test_query_like_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(op.q_ranked_search(spark, SF)) == brute(docs, items, 50)


def test_empty_tables(spark):
    d, q = frames(spark, [(1, "a b")], [(1, "a")])
    assert op.ranked_search(d.limit(0), q).collect() == [] and op.ranked_search(d, q.limit(0)).collect() == []
    assert got(op.ranked_search(d, q)) == brute([(1, "a b")], [(1, "a")], 50)


def arrays(n_items, n_docs, seed):
    """Documents of separate topics, as search_block takes them."""
    r = np.random.default_rng(seed)
    n_terms = 400
    item_terms = [np.unique(r.integers(0, 20, 8) + 20 * (i % 20)) for i in range(n_items)]
    first = np.cumsum([0, *map(len, item_terms)])
    items = op.Items(np.arange(n_items), np.zeros(n_items, bool), first, np.concatenate(item_terms), np.zeros(n_terms, np.uint64),
                     np.zeros(0, np.uint8), np.zeros(n_terms + 1, np.int64))
    doc_terms = [np.unique(r.integers(0, 20, 9) + 20 * (d % 20)) for d in range(n_docs)]
    doc = np.repeat(np.arange(n_docs), [len(x) for x in doc_terms])
    term = np.concatenate(doc_terms)
    return items, r.integers(1, 900, n_terms), np.arange(n_docs), np.full(n_docs, 30), doc, term, r.integers(1, 5, len(term))


@pytest.mark.parametrize("n_items,n_docs", [(1, 1), (1, 500), (60, 1), (60, 2000), (5, 17), (17, 16)])
def test_batches_are_pruned_without_loss(n_items, n_docs):
    items, weight, ids, length, doc, term, tf = arrays(n_items, n_docs, n_items * n_docs)
    tree, best = op.ItemTree(items, weight), op.Best(n_items, 10, np.zeros(n_items, np.int64))
    scored = op.search_block(tree, weight, best, ids, length, doc, term, tf, n_docs, 30 * n_docs)
    g = 1_000_000_000 * tf // (1000 * tf + 20 * 100)
    impact = np.zeros((n_docs, len(weight)), np.int64)
    impact[doc, term] = g
    for q in range(n_items):
        t = items.term[items.first[q]:items.first[q + 1]]
        s = impact[:, t] @ weight[t]
        order = [(int(s[d]), d) for d in np.lexsort((ids, -s)) if s[d] > 0][:10]
        mine = best.item == q
        assert list(zip(best.score[mine].tolist(), best.doc[mine].tolist())) == order
    if n_docs == 2000:
        assert scored < 0.2 * n_items * -(-n_docs // op.LEAF)


def test_terms_of_one_hash_are_told_apart(spark):
    buf = np.frombuffer(b"aabbcc", np.uint8)
    start, end = np.array([0, 2, 4]), np.array([2, 4, 6])
    items = op.Items(np.zeros(1), np.zeros(1, bool), np.array([0, 2]), np.array([0, 1]), np.array([5, 5], np.uint64),
                     np.frombuffer(b"bbaa", np.uint8), np.array([0, 2, 4]))
    assert items.find(buf, start, end, np.array([5, 5, 5], np.uint64)).tolist() == [1, 0, -1]
