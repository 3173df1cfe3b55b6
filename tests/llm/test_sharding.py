import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from tessera.llm import sharding as op

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("dims,bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_in_unit_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims))).T
    at = op.hilbert_index(list(cells), bits)
    assert sorted(at) == list(range((1 << bits) ** dims))
    path = cells[:, np.argsort(at)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def check_slots(rows, n_shards):
    for s in range(n_shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op.q_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    check_slots(rows, 8)
    counts = [sum(r.shard == s for r in rows) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(docs)
    for r in rows:
        raw = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    keys = [(r.curve, r.text_crc32, r.doc_id) for r in order]
    assert keys == sorted(keys)


def test_cells_of_the_query_recomputed(spark):
    """Every row's place on the curve, from ranks and quantiles in numpy."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    bits, n = 10, len(docs)
    cells = {}
    columns = [[r.lang for r in docs], [r.source for r in docs], [len((r.text or "").encode()) + 1 for r in docs]]
    for i, values in enumerate(columns):
        some = sorted({v for v in values if v is not None})
        code = [None if v is None else float(some.index(v)) for v in values]
        if i == 2:
            code = [float(v) for v in values]
        known = np.sort([c for c in code if c is not None])
        cuts = np.unique([known[max(int(np.ceil(k / (1 << bits) * len(known))) - 1, 0)] for k in range(1 << bits)])
        nulls = int(None in code)
        level = [0 if c is None else max(int(np.searchsorted(cuts, c, side="right")) - 1, 0) + nulls for c in code]
        cells[i] = (np.array(level) << bits) // max(len(cuts) + nulls, 1)
    want = dict(zip((r.doc_id for r in docs), op.hilbert_index([cells[i] for i in range(3)], bits).tolist()))
    assert {r.doc_id: r.curve for r in op.q_sharding(spark, SF).collect()} == want and n == len(want)


def test_sources_with_long_common_prefixes_are_told_apart(spark, tmp_path):
    names = ["books", "commoncrawl-2019", "commoncrawl-2020", "wiki"]
    df = spark.createDataFrame([Row(i=i, source=names[i % 4]) for i in range(2000)])
    sharded = op.hilbert_shards(df, ["source"], 4, tie=("i",))
    rows = sharded.collect()
    assert all(len({r.source for r in rows if r.shard == s}) == 1 for s in range(4))
    op.write_shards(sharded, str(tmp_path / "s"))
    one = op.read_shards(spark, str(tmp_path / "s"), sharded.schema, [rows[0].shard])
    assert {r.source for r in one.collect()} == {rows[0].source} and "PartitionFilters: [" in one._jdf.queryExecution().toString()


def test_dates_times_and_booleans(spark):
    df = spark.sql("SELECT id, date_add(date'2020-01-01', cast(id % 50 as int)) AS d, timestamp_seconds(id * 37 % 1000) AS t, "
                   "id % 2 = 0 AS b, if(id % 7 = 0, null, to_binary(cast(id % 3 as string), 'utf-8')) AS x FROM range(600)")
    rows = op.hilbert_shards(df, ["d", "t", "b", "x"], 8, tie=("id",)).collect()
    assert len(rows) == 600
    check_slots(rows, 8)
    single = sorted(op.hilbert_shards(df, ["d"], 8, tie=("id",)).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.d for r in single] == sorted(r.d for r in single)


def test_bytes_law(spark):
    df = spark.createDataFrame([Row(i=i, size=(i * 7919) % 97 + 1, lang="abc"[i % 3]) for i in range(500)])
    rows = op.hilbert_shards(df, ["lang", "size"], 8, "bytes", "size", tie=("i",)).collect()
    check_slots(rows, 8)
    total = sum(r["size"] for r in rows)
    for s in range(8):
        assert abs(sum(r["size"] for r in rows if r.shard == s) - total / 8) <= 98


def test_files_prune(spark, tmp_path):
    df = spark.createDataFrame([Row(i=i, x=i % 64, y=i // 64) for i in range(4096)])
    sharded = op.hilbert_shards(df, ["x", "y"], 8, tie=("i",))
    op.write_shards(sharded, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 4096
    spans = back.groupBy("shard").agg({"x": "count"}).count()
    boxes = [(max(r.x for r in g) - min(r.x for r in g), max(r.y for r in g) - min(r.y for r in g))
             for g in ([r for r in back.collect() if r.shard == s] for s in range(8))]
    assert spans == 8 and all(a < 63 or b < 63 for a, b in boxes)


def test_edge_cases(spark):
    rows = [Row(doc_id=None, lang=None, source="é" * 9, size=3, curve="old")] * 5 + \
        [Row(doc_id=1, lang="", source=None, size=None, curve=None)] * 4 + \
        [Row(doc_id=2, lang="x" * 70_000, source="http://a", size=10 ** 15, curve=None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, size long, curve string")
    out = op.hilbert_shards(df, ["lang", "source", "size"], tie=("doc_id",)).collect()
    assert len(out) == 10
    check_slots(out, 8)
    counts = [sum(r.shard == s for r in out) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    assert op.hilbert_shards(df.limit(0), ["lang", "size"]).count() == 0
    assert op.hilbert_shards(df.limit(0), ["lang", "size"], law="bytes", size="size").count() == 0
    assert len(op.hilbert_shards(df, ["lang"], law="bytes", size="size").collect()) == 10
