import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from tessera.operators import features as FT


def test_string_index_ties_by_string(spark):
    df = spark.createDataFrame([(v,) for v in [10.0, 10.0, 2.0, 2.0, 1.0, 3.0]], "x double")
    m = FT.fit_indexer(df, ["x"])
    assert m.labelsArray[0] == ["10.0", "2.0", "1.0", "3.0"]
    out = {r.x: r.x_idx for r in m.transform(df).collect()}
    assert out == {10.0: 0.0, 2.0: 1.0, 1.0: 2.0, 3.0: 3.0}


def test_label_tables_rank_like_the_indexer(spark):
    values = ["a"] * 50 + ["b"] * 7 + ["B"] * 7 + [f"x{i % 90}" for i in range(300)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "s string, i int").repartition(5)
    model = FT.fit_indexer(df, ["s", "i"])
    want = {r.i: (r.s_idx, r.i_idx) for r in model.transform(df).collect()}
    got = FT.index_columns(df, ["s", "i"]).collect()
    assert {r.i: (r.s_idx, r.i_idx) for r in got} == want and len(got) == len(values)


def test_label_tables_null_and_unseen(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    test = spark.createDataFrame([("b",), (None,), ("new",)], "s string")
    keep = FT.index_columns(test, ["s"], handle_invalid="keep", fit_on=train)
    assert {r.s: r.s_idx for r in keep.collect()} == {"b": 1.0, None: 2.0, "new": 2.0}
    assert [r.s for r in FT.index_columns(test, ["s"], handle_invalid="skip", fit_on=train).collect()] == ["b"]
    with pytest.raises(Exception, match="unseen label"):
        FT.index_columns(test, ["s"], fit_on=train).collect()
    assert FT.index_columns(train.limit(0), ["s"]).count() == 0


def test_vector_indexer_slots(spark):
    rows = [(float(i % 4 + 5), float(i % 5), float(-(i % 2))) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = FT.vector_indexer("features", "idx", 4).fit(v)
    maps = {int(k): {float(a): int(b) for a, b in m.items()} for k, m in model.categoryMaps.items()}
    assert set(maps) == {0, 2}                     # slot 1 has 5 values → continuous
    assert maps[2] == {0.0: 0, -1.0: 1}            # 0.0 always gets index 0
    assert maps[0] == {5.0: 0, 6.0: 1, 7.0: 2, 8.0: 3}
    out = model.transform(v).select(vector_to_array("idx").alias("x"), "b").collect()
    assert all(r.x[1] == r.b for r in out)


def test_assemble_leak_guard(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "a double, y double, y_idx double, y_before double")
    with pytest.raises(ValueError):
        FT.assemble(df, ["a", "y_idx"], label="y")
    out = FT.assemble(df, ["a", "y_idx"], label="y", allow_leak=True)
    assert list(out.first().features) == [1.0, 3.0]
    honest = FT.assemble(df, ["a", "y_before"], label="y")
    assert list(honest.first().features) == [1.0, 4.0]


def test_decode_label(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "prediction double")
    out = FT.decode_label(df, ["b", "a"]).collect()
    assert [r.predictedLabel for r in out] == ["b", "a"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_columns_cold_labels_like_the_indexer(spark):
    """35 columns of nearly distinct labels: one model, two exchanges of rows."""
    n = 3000
    rows = [(i % 1500, *(f"{(i * (k + 3)) % (1200 + k)}" if (i + k) % 17 else None for k in range(35))) for i in range(n)]
    rows = [(f"{r[0]}", *r[1:]) for r in rows]
    cols = [f"c{k}" for k in range(36)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).repartition(4)
    whole = df.na.fill("none")
    model = FT.fit_indexer(whole, cols)
    want = sorted(tuple(r) for r in model.transform(whole).collect())
    labels = FT.fit_labels(whole, cols)
    got = labels.transform(whole)
    assert got.columns == cols + [c + "_idx" for c in cols]
    assert sorted(tuple(r) for r in got.collect()) == want
    kept = labels.transform(df, handle_invalid="keep")
    assert kept.count() == n and kept.where(f"c1 is null and c1_idx != {labels.sizes[1][1]}").count() == 0


def test_equal_rows_and_clashing_names_keep_their_number(spark):
    rows = [("x" if i < 3000 else f"u{i % 2500}", 1.5, [i % 2], "k") for i in range(6000)] + [("u1", 1.5, [1], "k")] * 5
    df = spark.createDataFrame(rows, "s string, col double, row array<int>, label string")
    model = FT.fit_labels(df, ["s", "label"])
    assert model.sizes[0][2] == 1 and model.sizes[0][1] > 1       # a hot label and cold ones
    out = model.transform(df)
    assert out.columns == ["s", "col", "row", "label", "s_idx", "label_idx"]
    assert out.count() == len(rows)
    want = {r.label: r.idx for r in model.labels("s").collect()}
    assert all(r.s_idx == want[r.s] and r.label_idx == 0.0 for r in out.collect())
    assert out.groupBy("s", "row").count().count() == df.groupBy("s", "row").count().count()


def test_hot_labels_only_need_no_exchange(spark):
    df = spark.createDataFrame([(f"v{i % 20}", i) for i in range(500)], "s string, i int")
    out = FT.fit_labels(df, ["s"]).transform(df)
    plan = _plan(out)
    assert "hashpartitioning" not in plan.replace("BroadcastExchange", "")
    assert out.count() == 500


def test_one_model_for_train_and_test(spark):
    train = spark.createDataFrame([("a", "p")] * 3 + [("b", "q")] * 2, "s string, t string")
    test = spark.createDataFrame([("b", "p"), ("c", None)], "s string, t string")
    model = FT.fit_labels(train, ["s", "t"])
    assert [(r.s_idx, r.t_idx) for r in model.transform(test, handle_invalid="keep").orderBy("s").collect()] == [(1.0, 0.0), (2.0, 2.0)]
    assert [r.s for r in model.transform(test, handle_invalid="skip").collect()] == ["b"]
    assert model.transform(test.limit(0)).count() == 0
