import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tessera.sources as SRC
from tessera.sources import (label_features, parse_numeric, preview, read_lines,
                             read_ratings, read_table, write_vectors)
from tessera.sources.sinks import vectors_as_text


def _write(p, text):
    p.write_text(text)
    return str(p)


def test_read_lines_min_partitions(spark, tmp_path):
    f = _write(tmp_path / "a.txt", "\n".join(str(i) for i in range(100)))
    df = read_lines(spark, f, min_partitions=7)
    assert df.rdd.getNumPartitions() >= 7
    assert df.count() == 100


def test_two_headers_drop_both(spark, tmp_path):
    d = tmp_path / "two_headers"
    d.mkdir()
    _write(d / "a.csv", "a;b\n1;2\n3;4\n")
    _write(d / "b.csv", "a;b\n5;6\n7;8\n")
    df = read_table(spark, str(d), schema="a double, b double", sep=";")
    assert df.count() == 4
    assert sorted(r.a for r in df.collect()) == [1.0, 3.0, 5.0, 7.0]


def test_read_table_infer_and_drop_nulls(spark, tmp_path):
    f = _write(tmp_path / "t.csv", "x,y,z\n1,a,2.5\n2,,3.5\n3,c,4.5\n")
    df = read_table(spark, f, infer_schema=True, drop_nulls=True)
    assert df.count() == 2
    assert dict(df.dtypes)["x"] == "int"


def test_parse_numeric_and_label_features(spark, tmp_path):
    f = _write(tmp_path / "n.csv", "1,0.5,0.25,9\n0,1.5,2.5,9\n")
    df = parse_numeric(read_lines(spark, f), ",")
    lf = label_features(df, 0, 1, 2)
    rows = sorted((r.label, list(r.features)) for r in lf.collect())
    assert rows == [(0.0, [1.5, 2.5]), (1.0, [0.5, 0.25])]


def test_parse_numeric_label_last_and_id_first(spark, tmp_path):
    f = _write(tmp_path / "w.csv", "id7;1;2;3\n")
    df = parse_numeric(read_lines(spark, f), ";", drop_first=False)
    with pytest.raises(PySparkException):
        df.collect()  # 'id7' is not a number
    df = parse_numeric(read_lines(spark, f), ";", drop_first=True)
    assert df.first().values == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("text", ["1,2,abc\n", "1,2\n"])
def test_bad_number_or_short_row_fails_even_when_pruned(spark, tmp_path, text):
    f = _write(tmp_path / "bad.csv", "1,2,3\n" + text)
    df = parse_numeric(read_lines(spark, f), ",", min_fields=3)
    with pytest.raises(PySparkException):
        df.select(F.lit(1)).collect()
    with pytest.raises(PySparkException):
        df.count()


def test_label_features_short_row_fails(spark, tmp_path):
    f = _write(tmp_path / "s.csv", "1,2,3\n1,2\n")
    df = label_features(parse_numeric(read_lines(spark, f), ","), 0, 1, 2)
    with pytest.raises(PySparkException):
        df.collect()


def test_read_ratings(spark, tmp_path):
    f = _write(tmp_path / "r.train", "1::10::4.5::999\n2::11::3::998\n")
    r = read_ratings(spark, f)
    assert r.dtypes == [("user", "int"), ("item", "int"), ("rating", "double")]
    assert sorted(tuple(x) for x in r.collect()) == [(1, 10, 4.5), (2, 11, 3.0)]


@pytest.mark.parametrize("bad", ["3::12::5\n", "3::12::5::1::9\n", "x::12::5::1\n"])
def test_read_ratings_strict_even_when_pruned(spark, tmp_path, bad):
    f = _write(tmp_path / "r.bad", "1::10::4.5::999\n" + bad)
    r = read_ratings(spark, f)
    with pytest.raises(PySparkException):
        r.select("user").collect()
    with pytest.raises(PySparkException):
        r.count()


def test_write_vectors_roundtrip_and_exists(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 2.5],), ([3.0, -1.0],)], "v array<double>")
    out = str(tmp_path / "vecs")
    write_vectors(df, "v", out)
    back = sorted(r.value for r in spark.read.text(out).collect())
    assert back == ["1.0,2.5", "3.0,-1.0"]
    with pytest.raises(Exception):
        write_vectors(df, "v", out)


def test_vectors_as_text_from_ml_vector(spark):
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>").select(
        array_to_vector("v").alias("v"))
    assert vectors_as_text(df, "v").first().value == "1.0,2.0"


def test_preview(spark):
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    p = preview(df, ["y"], 5)
    assert p.columns == ["y"] and p.count() == 5


def test_read_table_failfast_on_malformed_row(spark, tmp_path):
    f = _write(tmp_path / "m.csv", "a,b\n1,2\n3,x\n")
    df = read_table(spark, f, schema="a double, b double")
    with pytest.raises(Exception):
        df.collect()


def test_vector_text_uses_jvm_double_format(spark):
    df = spark.createDataFrame([([1e-05, 1234567.0, -0.5],)], "v array<double>")
    # same text as the JVM's Double.toString, as the reference's mkString gives
    assert vectors_as_text(df, "v").first().value == "1.0E-5,1234567.0,-0.5"


def test_first_rows_read_a_prefix_of_the_files(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"part-{i:02d}.txt").write_text("".join(f"{i}:{k}\n" for k in range(10 if i != 3 else 0)))
    every = [f"{i}:{k}" for i in range(12) for k in range(10) if i != 3]
    for n in (0, 1, 9, 10, 11, 35, 110, 500):
        got = SRC.first_rows(spark, str(tmp_path), n).orderBy("position").collect()
        assert [(r.position, r.value) for r in got] == list(enumerate(every[:n]))
    few = SRC.first_rows(spark, str(tmp_path), 15)
    assert len(set(few.inputFiles())) == 3                  # 1 + 2 of 12


def test_first_rows_of_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(path)
    got = SRC.first_rows(spark, path, 300, "parquet").orderBy("position").collect()
    assert [r.id for r in got] == list(range(300))
    csv = str(tmp_path / "c")
    spark.range(100).selectExpr("id", "id * 2 as twice").repartitionByRange(4, "id").sortWithinPartitions("id").write.option("header", True).csv(csv)
    got = SRC.first_rows(spark, csv, 30, "csv", header=True, inferSchema=True).orderBy("position").collect()
    assert [(r.id, r.twice) for r in got] == [(i, 2 * i) for i in range(30)]
