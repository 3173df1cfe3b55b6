import pytest
from pyspark.sql import functions as F

from tessera.functions import key_bucket, with_rank, with_row_index
from tessera.operators import split as S


def test_key_split_disjoint_complete_and_layout_free(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a_train, a_test = S.key_split(df, "k", 0.7, 5)
    b = df.repartition(13)
    b_train, _ = S.key_split(b, "k", 0.7, 5)
    ta = {r.k for r in a_train.collect()}
    te = {r.k for r in a_test.collect()}
    assert ta.isdisjoint(te) and len(ta) + len(te) == 5000
    assert ta == {r.k for r in b_train.collect()}
    assert 0.65 < len(ta) / 5000 < 0.75


def test_key_folds_range_and_balance(spark):
    df = S.key_folds(spark.range(0, 3000).withColumnRenamed("id", "k"), "k", 3, 7)
    counts = {r.fold: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2}
    assert min(counts.values()) > 800


def test_pair_key_uses_both_ids(spark):
    df = spark.createDataFrame([(u, i) for u in range(30) for i in range(30)], "u int, i int")
    d = S.with_split(df, S.pair_key("u", "i"), 0.5, 1)
    per_item = d.groupBy("i").agg(F.countDistinct("part").alias("n"))
    # with a pair hash, items land on both sides
    assert per_item.where("n = 2").count() > 20


def test_random_split_passthrough(spark):
    a, b = S.random_split(spark.range(1000), (0.7, 0.3), 100)
    assert a.count() + b.count() == 1000


def test_copies_are_split_like_other_rows(spark, tmp_path):
    """A block of identical lines (a third of the file) must not land on one side."""
    from tessera.plans.programs import read_labeled
    lines = ["1,0.5,0.5"] * 300 + [f"{i % 2},{i / 7:.3f},{i / 11:.3f}" for i in range(600)]
    f = tmp_path / "dup.csv"
    f.write_text("\n".join(lines) + "\n")
    d = read_labeled(spark, str(f), ",", 0, 1, 2)
    train, test = S.key_split(d, "split_key", 0.7, 100)
    dup = F.expr("features[0] = 0.5 AND features[1] = 0.5")
    from pyspark.ml.functions import vector_to_array
    a = train.withColumn("features", vector_to_array("features")).where(dup).count()
    b = test.withColumn("features", vector_to_array("features")).where(dup).count()
    assert a + b == 300 and 150 < a < 260


def test_with_row_index_dense_in_file_order(spark, tmp_path):
    f = tmp_path / "lines.txt"
    f.write_text("\n".join(f"line{i:05d}" for i in range(5000)) + "\n")
    # several scan splits of one file
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = spark.read.text(str(f))
        assert df.rdd.getNumPartitions() > 3
        rows = with_row_index(df, "rid").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    ids = sorted(r.rid for r in rows)
    assert ids == list(range(5000))
    assert all(r.value == f"line{r.rid:05d}" for r in rows)


@pytest.mark.parametrize("split_bytes", ["16k", "1m"])
def test_row_index_follows_files_of_unequal_size(spark, tmp_path, split_bytes):
    """Spark packs large files first; positions still follow path and place."""
    sizes = [300, 9000, 700]
    for i, n in enumerate(sizes):
        (tmp_path / f"part-{i}.txt").write_text("".join(f"f{i} {k:06d}\n" for k in range(n)))
    want = [f"f{i} {k:06d}" for i, n in enumerate(sizes) for k in range(n)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = with_row_index(spark.read.text(str(tmp_path)), "rid").orderBy("rid").collect()
        derived = with_row_index(spark.read.text(str(tmp_path)).select(F.upper("value").alias("u")), "rid").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in rows] == want and [r.rid for r in rows] == list(range(len(want)))
    assert all(want[r.rid].upper() == r.u for r in derived)


def test_seeds_give_independent_splits(spark):
    keys = spark.range(1, 15001).withColumnRenamed("id", "k")
    sides = keys.select(*[S.in_train("k", 0.7, s).alias(f"s{s}") for s in (0, 99, 100, 101)])
    r = sides.agg(*[F.avg((F.col(a) & F.col(b)).cast("int")).alias(a + b) for a, b in
                    (("s0", "s99"), ("s99", "s100"), ("s100", "s101"), ("s0", "s101"))]).first()
    assert all(abs(x - 0.49) < 0.02 for x in r)
    folds = keys.select(*[key_bucket("k", 3, s).alias(f"f{s}") for s in (7, 8)])
    both = {(x.f7, x.f8): x["count"] for x in folds.groupBy("f7", "f8").count().collect()}
    assert len(both) == 9 and min(both.values()) > 1400


def test_with_rank_is_dense_and_ordered(spark):
    df = spark.range(2000).select(((F.col("id") * 7919) % 501).alias("x"), "id").repartition(6)
    rows = with_rank(df, [F.desc("x"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(2000))
    assert [(r.x, r.id) for r in rows] == sorted([(r.x, r.id) for r in rows], key=lambda t: (-t[0], t[1]))
    assert with_rank(df.limit(0), [F.asc("x")]).count() == 0


def test_null_keys_are_not_dropped(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,)], "k long")
    train, test = S.key_split(df, "k", 0.5, 3)
    assert train.count() + test.count() == 4
    assert S.key_folds(df, "k", 3).where("fold IS NULL").count() == 0
