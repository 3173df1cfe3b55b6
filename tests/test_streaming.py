import uuid

from tessera.operators import text as T
from tessera.streaming import stream_word_counts


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("Windmill windmill animals\nthe pigs\n")
    name = "wc_" + uuid.uuid4().hex[:8]
    q = (stream_word_counts(spark, str(src)).writeStream.outputMode("complete").format("memory")
         .queryName(name).option("checkpointLocation", str(tmp_path / "ck")).start())
    try:
        q.processAllAvailable()
        (src / "b.txt").write_text("animals pigs pigs\n")
        q.processAllAvailable()
        got = {r.word: r.n for r in spark.sql(f"SELECT * FROM {name}").collect()}
    finally:
        q.stop()
    batch = T.word_counts(spark.read.text(str(src)))
    assert got == {r.word: r.n for r in batch.collect()}
    assert got == {"windmill": 2, "animals": 2, "pigs": 3}
