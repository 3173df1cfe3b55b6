import re

import sentencepiece

import corpus_pipeline
from tessera.llm import sentence_pieces, toxicity

from .test_decontaminate import brute as contaminated
from .test_near_dedup import brute as classes

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), f"test-{name}")
        after = docs.collect()
        rows = [(i, r.text) for i, r in before.items()]
        if name == "toxicity":
            tagger = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"),
                                    toxicity.training_rows(spark.read.parquet(f"{SF}/labels.parquet")))
            scores = {r.doc_id: r.toxicity for r in toxicity.score(spark.read.parquet(f"{SF}/documents.parquet"), tagger).collect()}
            want = {i for i in before if scores[i] < 0.5}
        elif name == "exact_dedup":
            want = set({t or "": i for i, t in sorted(rows)}.values())
        elif name == "near_dedup":
            want = {c for _, c, _ in classes(rows)}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            want = {r[0] for r in contaminated(rows, items) if not r[-1]}
        else:
            want = set(before)
            library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.DEFAULT_MODEL)
            assert all(list(r.piece_ids) == library.encode(texts[r.doc_id] or "") and r.round_trip for r in after)
        assert sorted(r.doc_id for r in after) == sorted(want)
        if name != "sentence_pieces":
            assert docs.columns == columns
            assert all(r == before[r.doc_id] for r in after)
            assert name == "exact_dedup" or len(after) < len(before)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "sentence_pieces"]
    assert all(re.fullmatch(r"\w+", n) for n, _ in corpus_pipeline.STAGES)


def test_stages_with_null_ids_and_any_column_names(spark):
    """Each filtering stage but toxicity, on rows of null and repeated ids and
    with columns that the operators use inside; and on no rows."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, item), (None, None), (3, "g h"), (3, "g h"), (3, f"x {item}")]
    names = ["_row", "_id", "_sha", "_gone", "_bad", "key", "raw"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
    df = spark.createDataFrame([(*r, *names) for r in rows], schema)
    want = {"exact_dedup": 5, "near_dedup": 4, "decontamination": 5}
    for name, stage in corpus_pipeline.STAGES:
        if name in want:
            out = stage(spark, df, SF)
            got = out.collect()
            assert out.columns == df.columns and len(got) == want[name], name
            assert all(tuple(r)[2:] == tuple(names) for r in got)
            assert stage(spark, df.limit(0), SF).collect() == []
