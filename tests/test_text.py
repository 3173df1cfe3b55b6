from pyspark.ml.feature import StopWordsRemover

from tessera.constants import ENGLISH_STOP_WORDS
from tessera.operators import text as T


def test_stop_words_equal_spark_list(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_ascii_word_split(spark):
    df = spark.createDataFrame([("Être d'été foo_bar, x",), ("",), ("Should",)], "value string")
    toks = sorted(r.token for r in T.words(df).collect())
    # Java's \W is ASCII: accented letters are separators; empty tokens dropped
    assert toks == sorted(["tre", "d", "t", "foo_bar", "x", "Should"])
    clean = sorted(r.word for r in T.clean_words(df).collect())
    # t and should are Spark stop words; d is not in Spark's list
    assert clean == sorted(["d", "tre", "foo_bar", "x"])


def test_top_and_rare_ordering_with_ties(spark):
    text = ["zeta alpha alpha", "gamma gamma beta", "omega omega omega", "lengthy lengthier"]
    df = spark.createDataFrame([(t,) for t in text], "value string")
    top = [(r.word, r.n) for r in T.top_words(df, k=3).collect()]
    assert top == [("omega", 3), ("alpha", 2), ("gamma", 2)]
    rare = [(r.word, r.n) for r in T.rare_words(df, k=2, min_len=6).collect()]
    assert rare == [("lengthier", 1), ("lengthy", 1)]


def test_pipeline_form_matches_expression_form(spark):
    df = spark.createDataFrame([("The Quick brown fox",), ("jumps over the lazy dog",)],
                               "value string")
    pipe = T.token_pipeline("value", "filtered").fit(df).transform(df)
    words = sorted(w for r in pipe.collect() for w in r.filtered)
    assert words == sorted(r.word for r in T.clean_words(df).collect())
