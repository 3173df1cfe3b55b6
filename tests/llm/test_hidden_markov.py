import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.llm import chains
from tessera.llm import hidden_markov as op

SF = "/root/testdata/sf0.001"
HELD = "crc32(coalesce(cast(doc_id as string), '')) % 7 = 2"


def tokens(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def base(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = tokens(t)
        out.append((i, held(i), len(w), sum(x in c for x in w), n,
                    sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out


def key(r):
    return tuple(-1 if x is None else x for x in r[:5]) + (round(r[5], 4),)


def check(df, rows):
    got = df.collect()
    for a, b in zip(sorted((tuple(r) for r in got), key=key), sorted(base(rows), key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
    return got


def test_recursions_against_all_paths():
    rng = np.random.default_rng(0)
    start, step = rng.random(3), rng.random((3, 3))
    count = np.array([1, 4, 2, 5])
    first = np.cumsum(count) - count
    fit = rng.random((12, 3))
    order = next(chains.groups(count))
    lay = chains.Layout(first[order], count[order])
    alpha, scale = chains.forward(start, step, fit[lay.source], lay)
    beta = chains.backward(step, fit[lay.source], scale, lay)
    total = np.zeros(4)
    marginal, moves = np.zeros((12, 3)), np.zeros((3, 3))
    for d in range(4):
        rows = fit[first[d]:first[d] + count[d]]
        paths = {}
        for p in itertools.product(range(3), repeat=int(count[d])):
            w = start[p[0]] * rows[0, p[0]]
            for t in range(1, len(p)):
                w *= step[p[t - 1], p[t]] * rows[t, p[t]]
            paths[p] = w
        total[d] = sum(paths.values())
        for p, w in paths.items():
            for t, s in enumerate(p):
                marginal[first[d] + t, s] += w / total[d]
                if t:
                    moves[p[t - 1], s] += w / total[d]
    assert np.allclose(np.bincount(lay.rank, np.log(scale)), np.log(total[order]))
    assert np.allclose(alpha * beta, marginal[lay.source])
    assert np.allclose(chains.pairs(alpha, beta, step, fit[lay.source], scale, lay), moves)


def test_training_raises_likelihood(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        lang = i % 2
        own = np.where(rng.random(80) < .9, rng.integers(0, 20, 80) + 20 * lang, rng.integers(0, 40, 80)) + 2
        rows.append((np.append(own, 1).astype("<u2").tobytes(),))
    df = spark.createDataFrame(rows, "classes binary").repartition(3)

    def fit(passes):
        m = op.train(df, op.Model([b"w%d" % i for i in range(40)], [120] * 40, 60, 4860, 41), passes)
        out = 0.0
        for (raw,) in rows:
            own = np.frombuffer(raw, "<u2")
            a = m.start * m.emit[own[0]]
            for x in own[1:]:
                out += math.log(a.sum())
                a = (a / a.sum()) @ m.step * m.emit[x]
            out += math.log(a.sum())
        return out

    values = [fit(k) for k in (1, 3, 8)]
    assert values[0] < values[1] < values[2]


def test_probabilities_of_all_texts_sum_to_one():
    m = op.Model([b"a", b"b"], [10, 5], 4, 25, 6)
    assert (m.rare_n, m.rare_v) == (6, 3)
    # a rare word's probability within its class: (c + 1) / (rare_n + rare_v + 1), one unknown word included
    assert sum((c + 1) / (m.rare_n + m.rare_v + 1) for c in (1, 2, 3, 0)) == pytest.approx(1)
    assert np.allclose(m.emit.sum(axis=0), 1) and np.allclose(m.step.sum(axis=1), 1) and np.isclose(m.start.sum(), 1)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = check(op.q_hidden_markov(spark, "/root/testdata/sf0.01"), rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert sum(r.score > r.base_score for r in held) > 0.9 * len(held)


def test_exact_score(spark, monkeypatch):
    models = []
    train = op.train
    monkeypatch.setattr(op, "train", lambda *a: models.append(train(*a)) or models[-1])
    rows = [(i, " ".join("abcde"[(i * k * k + k) % 5] + ("q" * (k % 7 == 3)) + str(i) * (k % 11 == 5) for k in range(30))) for i in range(40)]
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows])
    got = {r.doc_id: r for r in op.hidden_markov_scores(df, F.expr(HELD)).collect()}
    m = models[0]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in t.split())
    for i, t in rows:
        a, out = None, 0.0
        for w in [*t.split(), None]:
            k = 1 if w is None else m.number.get(w.encode(), 0)
            p = m.emit[k] * ((c[w] + 1) / (m.rare_n + m.rare_v + 1) if k == 0 else 1)
            a = m.start * p if a is None else (a @ m.step) * p
            out += math.log10(a.sum())
            a = a / a.sum()
        assert got[i].score == pytest.approx(out, rel=1e-9)


@pytest.mark.parametrize("most", [0, 6])
def test_words_beyond_the_broadcast_have_emissions(spark, monkeypatch, most):
    monkeypatch.setattr(op, "CLASSES", most)
    models = []
    train, attach = op.train, op.Model.attach
    monkeypatch.setattr(op, "train", lambda *a: models.append(train(*a)) or models[-1])
    monkeypatch.setattr(op.Model, "attach", lambda m, words, uses: setattr(m, "words", words) or attach(m, words, uses))
    rng = np.random.default_rng(4)
    long = "y" * 70
    rows = [(i, " ".join(f"{'ab'[i % 2]}{k}" for k in rng.integers(0, 25, 40)) + f" {long} once{i}") for i in range(80)]
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows]).repartition(3)
    got = {r.doc_id: r for r in check(op.hidden_markov_scores(df, F.expr(HELD)), rows)}
    m = models[0]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in t.split())
    tail = sorted(tuple(r) for r in m.tail.select("c", *op.WEIGHTS).collect())
    assert [r[0] for r in tail] == sorted(x for w, x in c.items() if x >= op.LEAST_COUNT and w.encode() not in m.number)
    assert np.allclose(m.emit.sum(axis=0) + np.array([r[1:] for r in tail]).sum(axis=0) / m.total, 1, atol=1e-4)
    # the exact recursion with the emissions of the table
    name = {r.id: bytes(r.word).decode() for r in m.words.collect()}
    own = {name[r.id]: np.array([r[x] for x in op.WEIGHTS]) / m.total for r in m.tail.collect()}
    assert long in own and max((p.max() / p.min() for p in own.values())) > 1.5
    for i, t in rows[:40]:
        a, out = None, 0.0
        for w in [*t.split(), None]:
            k = 1 if w is None else m.number.get(w.encode(), 0)
            p = own[w] if w in own else m.emit[k] * ((c[w] + 1) / (m.rare_n + m.rare_v + 1) if k == 0 else 1)
            a = m.start * p if a is None else (a @ m.step) * p
            out += math.log10(a.sum())
            a = a / a.sum()
        assert got[i].score == pytest.approx(out, rel=1e-6)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (None, "a b"), (4, "word " * 50_000), (5, "Ä b\x0bC"), (6, "x" * 100_000), (8, "unseen a")]
    df = spark.createDataFrame([Row(doc_id=i, text=t, c="x", row=1, word=None) for i, t in rows], "doc_id long, text string, c string, row int, word int")
    check(op.hidden_markov_scores(df, F.expr(HELD)), rows)
    assert op.hidden_markov_scores(df.limit(0), F.expr(HELD)).count() == 0
    only_held = df.filter(HELD)
    check(op.hidden_markov_scores(only_held, F.expr(HELD)), [(r.doc_id, r.text) for r in only_held.collect()])


def test_frequent_words_keep_whole_counts(spark):
    rows = [(f"w{i}".encode(), c) for i, c in enumerate([9, 8, 8, 5, 5, 5, 4, 3, 3])] + [(b"x" * 65, 99)]
    df = spark.createDataFrame(rows, "word binary, c long")
    pick = lambda k: sorted((r.c for r in op.frequent_words(df, k).collect()), reverse=True)
    assert pick(1) == [9] and pick(2) == [9] and pick(3) == [9, 8, 8] and pick(100) == [9, 8, 8, 5, 5, 5, 4]
    assert pick(0) == [] and op.frequent_words(df.limit(0), 5).count() == 0


def test_scratch_of_passes_is_bounded(spark, monkeypatch):
    """Weights are joined to a part of the texts at a time; tables of finished passes are gone."""
    import glob
    from tessera.session import checkpoint_dir
    monkeypatch.setattr(op, "CLASSES", 3)
    parts, rounds = [], op.materialise_rounds

    def count(some, tag):
        some = list(some)
        parts.append((tag, len(some)))
        return rounds(some, tag)

    monkeypatch.setattr(op, "materialise_rounds", count)
    words = [f"w{i}" for i in range(30)]
    df = spark.createDataFrame([(d, " ".join(words[(d * 7 + k * k) % 30] for k in range(40))) for d in range(60)], "doc_id long, text string")
    files = lambda tag: set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/**/{tag}-*", recursive=True))
    before = {tag: files(tag) for tag in ("emissions", "expected")}
    got = op.hidden_markov_scores(df, F.col("doc_id") % 7 == 2).collect()
    assert len(got) == 60 and all(r.n_tokens == 41 and r.score < 0 for r in got)
    assert parts == [("expected", op.ROUNDS)] * op.PASSES + [("scored", op.ROUNDS)]
    assert len(files("emissions") - before["emissions"]) == 1 and files("expected") == before["expected"]


def test_blocks_meet_each_word_once(spark, monkeypatch):
    """Words pass between blocks and shards packed: no row for each text and
    word, and neither blocks nor shards nor scaling change a score."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * 7 + k * k) % 23}" for k in range(30)) + f" once{i}") for i in range(60)] + [(70, None), (None, "a1 b2")]
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows], "doc_id long, text string").repartition(2)
    monkeypatch.setattr(op, "CLASSES", 5)
    made, write = {}, op.materialise

    def keep(some, tag):
        made[tag] = write(some, tag)
        return made[tag]

    monkeypatch.setattr(op, "materialise", keep)
    whole = {r.doc_id: r for r in check(op.hidden_markov_scores(df, F.expr(HELD)), rows)}
    assert made["others"].count() <= made["classes"].count() <= 4       # of training and other texts, for each partition
    monkeypatch.setattr(op, "BLOCK", 500)
    monkeypatch.setattr(op, "PAIRS", 40)
    monkeypatch.setattr(op, "EVERY", 1)
    cut = {r.doc_id: r for r in check(op.hidden_markov_scores(df, F.expr(HELD)), rows)}
    assert made["others"].count() > made["classes"].count() > 8
    assert all(cut[i].score == pytest.approx(r.score, rel=1e-7) for i, r in whole.items())
