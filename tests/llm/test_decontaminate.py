import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from tessera.llm import decontaminate as op

SF = "/root/testdata/sf0.001"


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, n=10):
    phrases = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - n + 1, 1 if w else 0)):
            phrases.setdefault(tuple(w[k:k + n]), set()).add("" if i is None else str(i))
    sizes = {len(p) for p in phrases}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                own = phrases.get(tuple(w[k:k + size]))
                if own:
                    found |= own
                    hit.update(range(k, k + size))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=4), min_size=1, max_size=12))
def test_index_finds_all_occurrences(text, phrases):
    text = np.array([*text, 0], np.int64)
    width = 4
    rows = np.array([[0] * (width - len(p)) + p for p in phrases], np.int64)
    got = op.FMIndex(text, 4).find(rows, np.array([len(p) for p in phrases]))
    want = [(i, k) for i, p in enumerate(phrases) for k in range(len(text)) if text[k:k + len(p)].tolist() == p]
    assert sorted(zip(*(x.tolist() for x in got))) == want


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted(map(tuple, op.q_decontaminate(spark, SF).collect()), key=str)
    assert got == brute(docs, items) and any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("query_bytes", [150, 1 << 20])
def test_planted_and_edge_cases(spark, monkeypatch, query_bytes):
    monkeypatch.setattr(op, "QUERY_BYTES", query_bytes)
    rnd = random.Random(5)
    item = [f"b{i}" for i in range(25)]
    items = [(1, " ".join(item)), (2, "Short item"), (3, ""), (4, None), (None, "null id phrase"), (10, " ".join(item[3:16])),
             (1, " ".join(item)), (5, "ä-ö_ü!"), (6, "...")]
    docs = [(None, None), (None, "a null id phrase"), (1, ""), (2, "SHORT,item short item"), (3, "x " * 50_000 + " ".join(item).upper()),
            (4, " ".join(item[:9])), (5, "ä ö ü Ä ö ü"), (6, " ".join(item) + " " + " ".join(item)), (6, " ".join(item) + " " + " ".join(item))]
    for i in range(60):
        w = [f"b{rnd.randrange(25)}" if rnd.random() < .5 else "other" for _ in range(20)]
        a = rnd.randrange(25)
        docs.append((100 + i, ", ".join(w + item[a:a + rnd.randrange(16)] + w)))
    df = spark.createDataFrame([Row(doc_id=i, text=t, spans=1, raw="r") for i, t in docs],
                               "doc_id long, text string, spans int, raw string").repartition(3)
    bench = spark.createDataFrame([Row(item_id=i, text=t) for i, t in items], "item_id long, text string").coalesce(1)
    found = op.contamination(df, bench)
    assert sorted(map(tuple, op.digest(found).collect()), key=str) == brute(docs, items)
    whole = {(i, t) for i, t in docs}
    for r in found.collect():
        for s in r.spans:
            texts = [t.encode() for i, t in whole if i == r.doc_id and t]
            assert any(len(words(t[s.start:s.end].decode())) == s.words for t in texts)
    clean = op.drop_contaminated(df.filter("doc_id is not null"), bench)
    bad = {x[0] for x in brute(docs, items) if x[-1]}
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in docs if i is not None and i not in bad)


def test_rows_of_one_id_are_judged_one_by_one(spark):
    item = " ".join(f"b{i}" for i in range(12))
    rows = [(None, item), (None, "clean"), (None, None), (7, "clean too"), (7, f"x {item} y"), (8, item)]
    df = spark.createDataFrame([Row(doc_id=i, text=t, _row=0, _bad="b") for i, t in rows], "doc_id long, text string, _row int, _bad string")
    bench = spark.createDataFrame([Row(item_id=1, text=item)], "item_id long, text string")
    left = op.drop_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == [(7, "clean too"), (None, "clean"), (None, None)]


def test_empty_tables(spark):
    df = spark.createDataFrame([Row(doc_id=1, text="a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in op.digest(op.contamination(df, bench)).collect()] == brute([(1, "a b")], [])
    assert op.contamination(df.limit(0), df.withColumnRenamed("doc_id", "item_id")).count() == 0
