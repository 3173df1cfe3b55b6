import hashlib
import random
import re

import pytest
from pyspark.sql import Row

from tessera.llm import substring_dedup as op

SF = "/root/testdata/sf0.001"


def brute(rows, n=13):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in docs:
        if i is None:
            continue
        for k in range(len(w) - n + 1):
            g = tuple(w[k:k + n])
            least[g] = min(least.get(g, i), i)
    out = []
    for i, w in docs:
        gone = set()
        if i is not None:
            for k in range(len(w) - n + 1):
                if least[tuple(w[k:k + n])] < i:
                    gone.update(range(k, k + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest())
                   for r in df.collect()), key=str)


def test_cover_has_all_differences():
    assert {(a - b) % op.PERIOD for a in op.COVER for b in op.COVER} == set(range(op.PERIOD))
    for i in range(op.PERIOD):
        for j in range(op.PERIOD):
            assert any((i + k) % op.PERIOD in op.COVER and (j + k) % op.PERIOD in op.COVER for k in range(op.PERIOD))


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op.q_substring_dedup(spark, SF).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_planted_passages_at_every_offset(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    rnd = random.Random(block)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(120):
        w = [f"w{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(0, 40))]
        if i % 2:
            a, b = sorted((rnd.randrange(41), rnd.randrange(41)))
            k = rnd.randrange(len(w) + 1)
            w[k:k] = passage[a:b]
        rows.append((rnd.randrange(90) - 5, (" \t" if i % 3 else "\n").join(w)))
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows], "doc_id long, text string").repartition(5)
    assert digest(op.drop_repeats(df)) == brute(rows)


def test_edge_cases(spark):
    line = " ".join(f"l{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, " \n "), (None, line), (None, line), (5, line), (5, line), (6, line), (7, "x " * 70_000),
            (2 ** 40, line + " tail"), (-(2 ** 40), "head " + line), (8, "x " * 70_000), (9, "a" * 100_000 + " " + line),
            (10, " ".join(["same"] * 12)), (11, " ".join(["same"] * 12)), (12, "é ö " + line)]
    df = spark.createDataFrame([Row(doc_id=i, text=t, block=1, range="r") for i, t in rows],
                               "doc_id long, text string, block int, range string")
    assert digest(op.drop_repeats(df)) == brute(rows)
    assert op.drop_repeats(df.limit(0)).count() == 0
    assert digest(op.drop_repeats(df.limit(3))) == brute(rows[:3])
