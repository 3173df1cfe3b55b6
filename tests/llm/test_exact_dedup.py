import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.llm import exact_dedup as op

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 255), max_size=60), st.integers(1, 4))
def test_directory_keeps_entries_where_they_belong(keys, capacity):
    d = op.Directory(8, capacity)
    for i, k in enumerate(keys):
        d.insert(k, i)
    held = []
    for no, depth, entries in d.buckets():
        assert len(entries) <= capacity or len({k for k, _ in entries}) == 1
        assert all(k >> (8 - depth) == no for k, _ in entries)
        held += [v for _, v in entries]
    assert sorted(held) == list(range(len(keys)))
    assert len(d.slots) == 1 << d.depth


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    top = lambda ids: max((x for x in ids if x is not None), default=None)
    out, seen = [], set()
    for i, t in rows:
        ids = groups[t or ""]
        kept = i == top(ids) and (t or "") not in seen
        if kept:
            seen.add(t or "")
        out.append((i, top(ids), len(ids), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op.q_exact_dedup(spark, SF).collect()), key=str) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, "a"), (None, "a"), (None, "b"), (None, "b"), (4, "A"), (5, "a "),
            (6, "x" * 200_000), (7, "x" * 200_000)] + [(100 + i, "hot") for i in range(3000)]
    df = spark.createDataFrame([Row(doc_id=i, text=t, key="k", n=1, text_sha256=0) for i, t in rows],
                               "doc_id long, text string, key string, n int, text_sha256 int").repartition(7)
    assert sorted(map(tuple, op.exact_groups(df).collect()), key=str) == brute(rows)
    left = op.drop_copies(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str) == sorted(
        ((i, "" if i == 2 else t) for i, t in [(2, ""), (3, "a"), (None, "b"), (4, "A"), (5, "a "), (7, "x" * 200_000), (3099, "hot")]), key=str)
    assert op.exact_groups(df.limit(0)).count() == 0 and op.drop_copies(df.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 255), max_size=60), st.integers(1, 4))
def test_loaded_directory_finds_what_was_filed(keys, capacity):
    d = op.Directory(8, capacity)
    for i, k in enumerate(keys):
        d.insert(k, i)
    rows = [(no, depth, k, v) for no, depth, entries in d.buckets() for k, v in entries]
    again = op.Directory.load(8, iter(rows))
    assert again.depth <= d.depth
    for k in range(256):
        assert sorted(again.find(k)) == [i for i, x in enumerate(keys) if x == k]


def test_rows_are_found_through_the_directory_only(spark, monkeypatch):
    """Without it, or with one that leads to other buckets, there is no result."""
    df = spark.createDataFrame([Row(doc_id=i, text=f"text {i % 1900}") for i in range(3000)])
    index = op.build_index(df, owner_bits=2)
    rows = df.select("doc_id", F.xxhash64(op.text_bytes()).alias("key"), F.sha2(op.text_bytes(), 256).alias("text_sha256"),
                     F.col("doc_id").alias("_row"))
    found = {r.doc_id: (r.keep_id, r.group_size) for r in op.probe(index, rows, 2).collect()}
    want = {i: [j for j in range(3000) if j % 1900 == i % 1900] for i in range(3000)}
    assert found == {i: (max(g), len(g)) for i, g in want.items()}
    assert index.agg(F.max("depth")).first()[0] > 0          # buckets of more than 256 entries were split
    moved = index.withColumn("bucket", F.when(F.col("depth") > 0, F.col("bucket").bitwiseXOR(F.lit(1))).otherwise(F.col("bucket")))
    with pytest.raises(Exception):
        op.probe(moved, rows, 2).collect()


def test_drop_copies_keeps_columns_of_any_name(spark):
    rows = [(None, "a"), (None, "a"), (1, "b"), (1, "b"), (None, None), (2, "")]
    df = spark.createDataFrame([Row(doc_id=i, text=t, _id=5, _none="n", _sha=1.5, _row=2) for i, t in rows],
                               "doc_id long, text string, _id int, _none string, _sha double, _row int")
    left = op.drop_copies(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text, r._id, r._none, r._sha, r._row) for r in left.collect()), key=str) == [
        (1, "b", 5, "n", 1.5, 2), (2, "", 5, "n", 1.5, 2), (None, "a", 5, "n", 1.5, 2)]
