import random

import pytest
from pyspark.sql import Row

from tessera.llm import sentence_pieces as op

SF = "/root/testdata/sf0.001"


def marked(text):
    s = text.replace(" ", op.MARK)
    return op._WORD.findall(op.MARK + s if s else s)


def ids_of(encoder, text):
    import numpy as np
    words = sorted(set(marked(text)))
    by = dict(zip(words, encoder.encode_sorted(words)))
    return [int(i) for w in marked(text) for i in np.frombuffer(by[w], np.int32)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=op.DEFAULT_MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return op.Vocabulary()


def test_ids_like_the_library_on_odd_texts(library, vocabulary):
    encoder = op.Encoder(vocabulary)
    rnd = random.Random(3)
    alphabet = "abcdefghijklmnoprstuveeee     ,.\t\nAÉéß漢😀\x00'0129"
    for text in ["", " ", "   ", "Hello  world", "a", "\n\n", "tschüß naïve 漢字 😀", *(
            "".join(rnd.choices(alphabet, k=rnd.randint(1, 80))) for _ in range(1500))]:
        assert ids_of(encoder, text) == library.encode(text), text


def test_unigram_like_the_library(tmp_path, vocabulary):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    model = pb.ModelProto()
    model.ParseFromString(open(op.DEFAULT_MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    path = str(tmp_path / "u.model")
    open(path, "wb").write(model.SerializeToString())
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder = op.Encoder(op.Vocabulary(path, "unigram"))
    rnd = random.Random(4)
    for _ in range(400):
        text = "".join(rnd.choices("abcdeinorst  éß漢", k=rnd.randint(1, 30)))
        mine, theirs = ids_of(encoder, text), lib.encode(text)
        total = lambda ids: sum(encoder.unk_score if encoder.v.pieces[i].startswith("<0x") else encoder.v.scores[i] for i in ids)
        assert mine == theirs or (total(mine) == total(theirs) and lib.decode(mine) == lib.decode(theirs)), text


def test_whole_documents_like_the_library(spark, library, vocabulary):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op.q_sentence_pieces(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert list(r.piece_ids) == library.encode(docs[r.doc_id] or "")
        assert r.n_pieces == len(r.piece_ids) and r.round_trip


def test_edge_cases_and_clashing_columns(spark, library, vocabulary):
    long = ("x" * 3000 + " word  ") * 30
    rows = [Row(doc_id=1, text=None, piece_ids="old", _utf8=1), Row(doc_id=2, text="", piece_ids="old", _utf8=1),
            Row(doc_id=3, text=long, piece_ids=None, _utf8=1), Row(doc_id=3, text=long, piece_ids=None, _utf8=1),
            Row(doc_id=None, text="a▁b ퟿\x00", piece_ids=None, _utf8=None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string, _utf8 int")
    out = op.encode(df, vocabulary)
    assert out.columns == ["doc_id", "text", "_utf8", "piece_ids"]
    for r in out.collect():
        assert list(r.piece_ids) == library.encode(r.text or "")
    back = op.decode(out, vocabulary, out="back").collect()
    assert all(r.back == (r.text or "").replace("▁", " ") for r in back)
    assert op.encode(df.limit(0), vocabulary).count() == 0
    digest = op.encoded_digest(df.select("doc_id", "text"), vocabulary).collect()
    assert all(r.round_trip for r in digest)


def test_a_worker_keeps_what_it_learned(spark, library, vocabulary, monkeypatch):
    import pickle

    copy = pickle.loads(pickle.dumps(vocabulary))
    encoder, decoder, known = copy.in_worker()
    assert copy.in_worker() == (encoder, decoder, known) and pickle.loads(pickle.dumps(copy)).tools is None
    monkeypatch.setattr(op, "MAX_MEMO", 3)
    # "a" comes in each batch and is encoded once, the words between come once and go
    times = []
    for i in range(30):
        new = known.missing({"a", f"b{i}", f"c{i}"})
        times += [w for w in new if w == "a"]
        known.new |= dict(zip(new, encoder.encode_sorted(new)))
        assert len(known.new) <= 3 + 3 and len(known.old) <= 3 + 3
    assert times == ["a"]
    monkeypatch.setattr(op, "BATCH", 40)
    texts = [f"the word{i % 7} and {'long' * 50}{i % 3} the end" for i in range(40)]
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in enumerate(texts)]).coalesce(1)
    got = {r.doc_id: r for r in op.encode(df, vocabulary, decoded="back").collect()}
    assert all(got[i].piece_ids == library.encode(t) and got[i].back == t for i, t in enumerate(texts))
