"""Operator 10: toxic spans and document scores by a linear-chain CRF.

Tokens are tagged clean or toxic by a conditional random field. A token's
feature is the longest lexicon entry it offers: the word itself or one of its
first 6, 5 or 4 letters. The lexicon holds word forms and stems that labelled
documents tell apart, and it labels the tokens to learn from: a token of a
toxic document whose feature hardly occurs in clean ones is toxic, all others
are clean. Half of the texts show their words' stems only, so that both words and
stems are learned. Weights are fitted by gradients of the conditional likelihood,
summed over the partitions. Forward-backward marginals give the spans'
offsets and, aggregated, the document's score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chains
from .common import batches, binary_column, materialise, text_bytes

SAMPLE = 20_000             # labelled rows learned from, at most (the lowest hashes of their ids)
LEAST_DOCS = 3              # labelled documents a feature occurs in; every such feature is kept
PARTS = 16                  # sums of the model's size that a pass brings together
STEMS = (6, 5, 4)           # letters
SURE = 0.8                  # share of toxic documents from which a feature labels its tokens
PASSES = 12                 # of gradient ascent
MAX_MEMO = 300_000          # words a task remembers (speed only)
SPAN = 0.5                  # marginal of a token that belongs to a span
_WORD = re.compile(r"[^\W_]+")


def features(word: str) -> list[str]:
    """A lower-case word's possible features, longest first."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def _decode(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


class Tagger:
    """Lexicon, weights of the CRF and of the document score."""

    def __init__(self, lexicon: list[str], toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int):
        self.number = {f: i + 1 for i, f in enumerate(lexicon)}               # 0: no feature
        t, c = (np.concatenate(([0.0], x)) for x in (toxic, clean))
        self.sure = (t + 0.5) / (t + c + 1) >= SURE
        self.sure[0] = False
        odds = np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1))
        odds[0] = 0
        self.weight = np.clip(odds, -4, 8)     # of the toxic state, for each feature
        self.bias = -4.0
        self.step = np.array([[0.0, 0.0], [0.0, 0.5]])
        self.start = np.zeros(2)
        self.score = np.array([-2.0, 1.0, 0.0])

    def feature(self, word: str, stem: bool = False) -> int:
        """The number of the word's feature; with ``stem`` as if the word were
        not in the lexicon (if it has stems)."""
        get = self.number.get
        for f in features(word)[stem and len(word) > min(STEMS):]:
            i = get(f)
            if i is not None:
                return i
        return 0

    def fit(self, seen: np.ndarray) -> np.ndarray:
        out = np.ones((len(seen), 2))
        out[:, 1] = np.exp(np.clip(self.weight + self.bias, -30, 30))[seen]
        return out

    def marginals(self, seen: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The probability that each token is toxic."""
        out = np.zeros(len(seen))
        step, start = np.exp(self.step), np.exp(self.start)
        for group in chains.groups(count):
            lay = chains.Layout(first[group], count[group])
            fit = self.fit(seen[lay.source])
            alpha, scale = chains.forward(start, step, fit, lay)
            out[lay.source] = (alpha * chains.backward(step, fit, scale, lay))[:, 1]
        return out

    def summary(self, p: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Of each document: 1, the log-odds that any token is toxic, and the
        logarithm of the expected number of toxic tokens (0 without tokens)."""
        total = np.concatenate(([0.0], np.cumsum(p)))
        none = np.concatenate(([0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-9)))))
        last = first + count
        clean = np.minimum(none[last] - none[first], -1e-9)
        any_ = np.clip(np.log(-np.expm1(clean)) - clean, -12, 12)
        any_[count == 0] = -12
        return np.stack((np.ones(len(first)), any_, np.log1p(np.maximum(total[last] - total[first], 0))), axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.score, -35, 35)))


def _document_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in batches(it, 8 << 20, "raw"):
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for raw, toxic in zip(table["raw"].to_pylist(), table["toxic"].to_pylist()):
            found[toxic].update({f for w in set(_WORD.findall(_decode(raw).lower())) for f in features(w)})
        names = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([found[k][f] for f in names], pa.int64()) for k in (1, 0))],
                                         ["feature", "t", "c"])


def _seen(texts: list[bytes], tagger: Tagger, memo: dict[str, int], stem: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all tokens, and where each text's begin and their count."""
    out, count = [], []
    for raw in texts:
        words = _WORD.findall(_decode(raw).lower())
        try:
            own = [memo[w] for w in words]
        except KeyError:
            if len(memo) > MAX_MEMO:
                memo.clear()
            own = []
            for w in words:
                i = memo.get(w)
                if i is None:
                    i = tagger.feature(w, stem)
                    if len(w) < 100:
                        memo[w] = i
                own.append(i)
        out.append(np.array(own, np.int32))
        count.append(len(own))
    size = np.array(count, np.int64)
    return np.concatenate([*out, np.zeros(0, np.int32)]), np.cumsum(size) - size, size


def train(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Tagger:
    """Learns from the documents that ``labels`` (doc_id, toxic 0/1) names.

    Rows with a null id or label are left out; an id with both labels counts
    as toxic. At most SAMPLE labelled rows are used, those with the lowest
    hashes of their ids, so the ids can be broadcast; the texts are sampled in
    place, without a shuffle. Without any labelled document every score is low.
    """
    spark = df.sparkSession
    sample = (labels.filter(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull())
              .groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(SAMPLE))
    docs = materialise(df.select(F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("raw"))
                       .join(F.broadcast(sample), "id").select("raw", "toxic"), "labelled")
    n_toxic, n = docs.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    # every feature of enough sampled documents: bounded by the sample
    lexicon = materialise(docs.mapInArrow(_document_counts, "feature string, t long, c long").groupBy("feature")
                          .agg(F.sum("t").alias("t"), F.sum("c").alias("c")).filter(F.col("t") + F.col("c") >= LEAST_DOCS), "lexicon")
    lexicon = lexicon.orderBy("feature").toArrow()
    tagger = Tagger(lexicon["feature"].to_pylist(), lexicon["t"].to_numpy(), lexicon["c"].to_numpy(), n_toxic, n - n_toxic)
    if not n_toxic or n_toxic == n:
        tagger.score = np.array([-6.0 if not n_toxic else 6.0, 0.0, 0.0])
        return tagger
    first = spark.sparkContext.broadcast(tagger)

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for table in batches(it, 8 << 20, "raw"):
            texts, out = table["raw"].to_pylist(), []
            for raw in texts:
                # half of the texts show the stems only, so that these are learned too
                stem = zlib.crc32(raw) & 1
                out.append(_seen([raw], first.value, memos[stem], bool(stem))[0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), table["toxic"].combine_chunks()], ["seen", "toxic"])

    encoded = materialise(docs.mapInArrow(encode, "seen binary, toxic int"), "tokens")
    moving = np.full(len(tagger.weight) + 8, 0.5)
    before = np.zeros(len(moving))
    for turn in range(PASSES):
        shared = spark.sparkContext.broadcast(tagger)

        def slope(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tagger = shared.value
            size = len(tagger.weight)
            step, start = np.exp(tagger.step), np.exp(tagger.start)
            wanted = np.zeros(size + 7)
            for table in batches(it, 8 << 20, "seen"):
                raw, off = binary_column(table["seen"])
                seen, off = np.frombuffer(raw.tobytes(), np.int32), off // 4
                toxic = table["toxic"].to_numpy() == 1
                count = np.diff(off)
                for group in chains.groups(count):
                    lay = chains.Layout(off[:-1][group], count[group])
                    own = seen[lay.source]
                    truth = (tagger.sure[own] & toxic[group][lay.rank]).astype(int)
                    fit = tagger.fit(own)
                    alpha, scale = chains.forward(start, step, fit, lay)
                    beta = chains.backward(step, fit, scale, lay)
                    p = alpha * beta
                    wanted[:size] += np.bincount(own, truth - p[:, 1], size)
                    ones = slice(0, lay.begin[1])
                    wanted[size] += truth.sum() - p[:, 1].sum()
                    wanted[size + 1:size + 3] += np.bincount(truth[ones], minlength=2) - p[ones].sum(axis=0)
                    known = np.stack((1 - truth, truth), axis=1).astype(float)
                    # the labels' own transitions, counted like the model's
                    moves = chains.pairs(known, np.ones_like(known), np.ones((2, 2)), known, np.ones(len(known)), lay)
                    wanted[size + 3:] += (moves - chains.pairs(alpha, beta, step, fit, scale, lay)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([wanted.tobytes()], pa.binary())], ["wanted"])

        # one vector of the model's size for each of a bounded number of partitions
        slopes = encoded.select("seen", "toxic").coalesce(PARTS).mapInArrow(slope, "wanted binary").collect()
        total = sum(np.frombuffer(r.wanted) for r in slopes)
        shared.destroy()
        weights = np.concatenate((tagger.weight, [tagger.bias], tagger.start, tagger.step.ravel()))
        total = np.concatenate((total, [0.0])) - 0.05 * np.concatenate((weights, [0.0]))
        # resilient steps: grow while the sign holds, shrink when it turns
        moving = np.clip(np.where(total * before > 0, moving * 1.2, np.where(total * before < 0, moving * 0.5, moving)), 1e-4, 2)
        before = total
        weights = np.clip(weights + (np.sign(total) * moving)[:-1], -12, 12)
        size = len(tagger.weight)
        tagger.weight, tagger.bias = weights[:size], float(weights[size])
        tagger.weight[0] = 0
        tagger.start, tagger.step = weights[size + 1:size + 3], weights[size + 3:].reshape(2, 2)
    final = spark.sparkContext.broadcast(tagger)

    def summarise(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it, 8 << 20, "seen"):
            raw, off = binary_column(table["seen"])
            seen, off = np.frombuffer(raw.tobytes(), np.int32), off // 4
            x = final.value.summary(final.value.marginals(seen, off[:-1], np.diff(off)), off[:-1], np.diff(off))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), table["toxic"].combine_chunks()], ["a", "b", "y"])

    # three numbers of each sampled row: a logistic fit by Newton's steps
    rows = np.array([tuple(r) for r in encoded.mapInArrow(summarise, "a double, b double, y int").collect()], float)
    x, y = np.column_stack((np.ones(len(rows)), rows[:, :2])), rows[:, 2]
    w, ridge = np.zeros(3), np.diag([1e-3, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    tagger.score = w
    return tagger


_SPAN = "struct<start:int,end:int,text:string,p:double>"


def score(df: DataFrame, tagger: Tagger, text: str = "text", out: str = "toxicity", spans: str | None = "toxic_spans") -> DataFrame:
    """Adds ``out`` (0 to 1) and ``spans``: runs of toxic tokens in the whole
    text, with their character offsets and largest marginal.

    Null and empty texts have no tokens; their score is that of no sign of
    toxicity. Rows, repeated ones too, are scored one by one from the text
    alone. All columns pass through, those named like an output are replaced.
    Narrow: no shuffle; the broadcast model is bounded by the training sample.
    """
    shared = df.sparkSession.sparkContext.broadcast(tagger)
    kept = [c for c in df.columns if c not in (out, spans)]
    raw = "_utf8"
    while raw in kept:
        raw += "_"
    work = df.select(*kept, text_bytes(text).alias(raw))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in work.schema if f.name != raw]
                       + [f"`{out}` double"] + ([f"`{spans}` array<{_SPAN}>"] if spans else []))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger, memo = shared.value, {}
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("p", pa.float64())]))
        for table in batches(it, 8 << 20, raw):
            texts = table[raw].to_pylist()
            seen, first, count = _seen(texts, tagger, memo)
            p = tagger.marginals(seen, first, count)
            table = table.drop_columns([raw]).append_column(out, pa.array(tagger.scores(tagger.summary(p, first, count))))
            if spans:
                found = []
                for t, a, k in zip(texts, first, count):
                    own = p[a:a + k]
                    found.append(_spans(_decode(t), own) if k and own.max() >= SPAN else [])
                table = table.append_column(spans, pa.array(found, kind))
            yield from table.to_batches()

    return work.mapInArrow(run, schema)


def _spans(text: str, p: np.ndarray) -> list[dict]:
    # lower-casing may change a text's length, so offsets are of its own words
    words = [m.span() for m in _WORD.finditer(text)]
    if len(words) != len(p):
        text = text.lower()
        words = [m.span() for m in _WORD.finditer(text)]
    hit = np.concatenate(([False], p >= SPAN, [False]))
    turns = np.flatnonzero(hit[1:] != hit[:-1])
    return [{"start": words[a][0], "end": words[b - 1][1], "text": text[words[a][0]:words[b - 1][1]], "p": float(p[a:b].max())}
            for a, b in zip(turns[::2], turns[1::2])]


def training_rows(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels that may be learned from: crc32 of the id as text modulo 5 is not 0."""
    return labels.filter(F.crc32(F.col(doc_id).cast("string")) % 5 != 0)


def drop_toxic(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without the documents whose score is 0.5 or more, all columns."""
    column = "_toxicity"
    while column in df.columns:
        column += "_"
    tagger = train(df, training_rows(labels), doc_id, text)
    return score(df, tagger, text, column, None).filter(F.col(column) < 0.5).drop(column)


def q_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    out = score(docs, train(docs, training_rows(labels)), out="score", spans="spans")
    return out.select("doc_id", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
