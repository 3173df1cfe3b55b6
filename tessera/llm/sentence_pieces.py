"""Operator 2: SentencePiece encoding and decoding by a shared-prefix forward pass.

A text is cut into marked words (a run of marks, then other characters); no
vocabulary entry crosses such a cut, so each word is encoded by itself. The
distinct words of a batch are sorted, which lays their trie out depth-first:
a word keeps the forward states of the prefix it shares with the word before
it and only its own rest is computed.

The forward state of a prefix depends on the kind of the model:

* ``unigram``: best score sum of any split of the prefix, and its last piece
  (Viterbi). Unknown characters score 10 below the worst piece.
* ``bpe``: the last piece of the prefix's own encoding. Score sums do not
  give a merge model's splits, so Viterbi's maximum is replaced by a test: a
  piece may follow another if merging their joined characters gives just
  these two; exactly one piece that ends at a place may follow the encoding
  before it. Everything else (sorting, sharing, back-trace) is the same.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, binary_column, text_bytes

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_PIECES = 1_000_000      # of the broadcast vocabulary; checked
MAX_MEMO = 200_000          # distinct words in each half of a worker's memo (speed only)
BATCH = 4 << 20             # bytes of text whose distinct words are sorted together
MAX_MEMO_WORD = 128         # characters; longer words are encoded each time
MARK = "▁"
UNKNOWN_PENALTY = 10.0
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Vocabulary:
    """Pieces, scores and special ids of a model file (read on the driver)."""

    def __init__(self, path: str = DEFAULT_MODEL, kind: str = "bpe"):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        if kind not in ("bpe", "unigram"):
            raise ValueError(f"unknown kind of model: {kind}")
        if sp.get_piece_size() > MAX_PIECES:
            raise ValueError("the vocabulary is too large to broadcast")
        probe = "Ａ  b"
        marked = sp.normalize(probe).replace(" ", MARK)
        self.prefix = marked.startswith(MARK)
        if marked.removeprefix(MARK) != probe.replace(" ", MARK):
            raise ValueError("only models with identity normalisation are supported")
        self.kind = kind
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.scores = [sp.get_score(i) for i in range(len(self.pieces))]
        special = [i for i in range(len(self.pieces))
                   if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)]
        self.control = {i for i in special if sp.is_control(i)}
        self.byte_ids = [i for i in special if sp.is_byte(i)]   # 256 in order, or none
        self.unk = sp.unk_id()
        self.normal = sorted(set(range(len(self.pieces))) - set(special))
        if any(MARK in self.pieces[i].lstrip(MARK) for i in self.normal):
            raise ValueError("a piece crosses a word boundary")
        self.tools: tuple[Encoder, Decoder, Memo] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tools": None}

    def in_worker(self) -> tuple[Encoder, Decoder, Memo]:
        """Encoder, decoder and memo, made once: a worker keeps a broadcast
        vocabulary, and what was learned with it, from task to task."""
        if self.tools is None:
            self.tools = Encoder(self), Decoder(self), Memo()
        return self.tools


class Memo:
    """Ids of the words met of late, at most about twice MAX_MEMO of them and a
    batch's: once the new half is full it becomes the old one, from which words
    move on when they are met again."""

    def __init__(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, words: set[str]) -> list[str]:
        """Those of ``words`` not known, sorted; all others are in ``new``."""
        if len(self.new) > MAX_MEMO:
            self.old, self.new = self.new, {}
        words = words.difference(self.new)
        again = words.intersection(self.old)
        self.new |= {w: self.old[w] for w in again}
        return sorted(words - again)


class Encoder:
    """Encodes marked words; keeps what it has learned about pairs of pieces."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.ids = {v.pieces[i]: i for i in v.normal}
        self.unk_score = min((v.scores[i] for i in v.normal), default=0.0) - UNKNOWN_PENALTY
        self.pairs: dict[tuple[int, int], bool] = {}
        usable = v.normal
        if v.kind == "bpe":   # pieces that merging can reach
            usable = [i for i in v.normal if self.merge(v.pieces[i]) == [v.pieces[i]]]
        self.usable = {v.pieces[i]: i for i in usable}
        ends: dict[str, set[int]] = {}
        for p in self.usable:
            ends.setdefault(p[-3:], set()).add(len(p))
        self.ends = {k: sorted(x, reverse=True) for k, x in ends.items()}
        self.lengths: dict[str, tuple[int, ...]] = {}

    def fitting(self, end: str) -> tuple[int, ...]:
        """Lengths that pieces ending in these three characters (or all there
        are) can have, longest first."""
        if len(self.lengths) > 500_000:
            self.lengths.clear()
        shorter = (n for n in (2, 1) if n < len(end) and end[-n:] in self.usable)
        out = self.lengths[end] = (*self.ends.get(end, ()), *shorter)
        return out

    def merge(self, s: str) -> list[str]:
        """Merges of the best-scored neighbours, leftmost first, until none fits."""
        ids, scores = self.ids, self.v.scores
        if len(s) <= 16:
            short = list(s)
            while True:
                top, at = None, 0
                for i in range(len(short) - 1):
                    k = ids.get(short[i] + short[i + 1])
                    if k is not None and (top is None or scores[k] > top):
                        top, at = scores[k], i
                if top is None:
                    return short
                short[at:at + 2] = [short[at] + short[at + 1]]
        parts: list[str | None] = list(s)
        left, right = list(range(-1, len(s) - 1)), list(range(1, len(s) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < len(parts):
                both = parts[i] + parts[j]
                if both in ids:
                    heapq.heappush(heap, (-scores[ids[both]], i, j, both))

        for i in range(len(s) - 1):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or right[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p is not None]

    def may_follow(self, a: int, b: int) -> bool:
        if a < 0:               # nothing or an unknown character before
            return True
        ok = self.pairs.get((a, b))
        if ok is None:
            p, q = self.v.pieces[a], self.v.pieces[b]
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.merge(p + q) == [p, q]
        return ok

    def encode_sorted(self, words: list[str]) -> list[bytes]:
        """Ids (int32 bytes) of each word; ``words`` are sorted."""
        unigram, lengths, fitting, usable = self.v.kind == "unigram", self.lengths, self.fitting, self.usable
        may_follow, known, scores, unk_score = self.may_follow, self.pairs.get, self.v.scores, self.unk_score
        # per place of the current word: last piece (-1: unknown character), its
        # length and, for unigram, the best sum
        last, width, best = [-1], [0], [0.0]
        before, out = "", []
        for word in words:
            keep, most = 0, min(len(before), len(word))
            while keep < most and before[keep] == word[keep]:
                keep += 1
            del last[keep + 1:], width[keep + 1:], best[keep + 1:]
            for j in range(keep + 1, len(word) + 1):
                end = word[j - 3 if j > 3 else 0:j]
                fit = lengths.get(end)
                if fit is None:
                    fit = fitting(end)
                found, size = -1, 1
                if unigram:
                    top = None
                    for n in fit if 1 in fit else (*fit, 1):
                        i = usable.get(word[j - n:j], -1) if n <= j else -1
                        if i < 0 and n > 1:
                            continue
                        score = best[j - n] + (scores[i] if i >= 0 else unk_score)
                        if top is None or score > top:
                            top, found, size = score, i, n
                    best.append(top)
                else:
                    for n in fit:
                        if n > j:
                            continue
                        i = usable.get(word[j - n:j])
                        if i is None:
                            continue
                        a = last[j - n]
                        if a >= 0:
                            ok = known((a, i))
                            if not (may_follow(a, i) if ok is None else ok):
                                continue
                        found, size = i, n
                        break
                last.append(found)
                width.append(size)
            before = word
            j, back = len(word), []
            while j:
                i = last[j]
                back.append(i if i >= 0 else word[j - 1])
                j -= width[j]
            back.reverse()
            out.append(array("i", back).tobytes() if str not in map(type, back) else self.finish(back))
        return out

    def finish(self, steps: list[int | str]) -> bytes:
        """Ids of a split that has unknown characters in it."""
        ids: list[int] = []
        for i in steps:
            if isinstance(i, int):
                ids.append(i)
            elif self.v.byte_ids:
                ids.extend(self.v.byte_ids[b] for b in i.encode("utf-8", "replace"))
            elif not ids or ids[-1] != self.v.unk:    # a run of unknowns is one piece
                ids.append(self.v.unk)
        return array("i", ids).tobytes()


class Decoder:
    """Ids back to text: pieces joined, byte pieces as bytes, marks as spaces."""

    def __init__(self, v: Vocabulary):
        raw = []
        as_byte = {i: b for b, i in enumerate(v.byte_ids)}
        for i, p in enumerate(v.pieces):
            raw.append(b"" if i in v.control else " ⁇ ".encode() if i == v.unk
                       else bytes([as_byte[i]]) if i in as_byte else p.encode())
        self.raw, self.prefix = raw, v.prefix

    def decode(self, ids) -> str:
        raw = self.raw
        s = b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return s[1:] if self.prefix and s.startswith(" ") else s


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "piece_ids",
           decoded: str | None = None) -> DataFrame:
    """Adds ``out`` (array<int>): the ids of the whole ``text``; with
    ``decoded``, also the text decoded from these ids.

    Null and empty texts give an empty array. Decoding gives the text back
    but for the mark character itself, which becomes a space. Rows, repeated
    ones too, are handled one by one; all columns pass through, columns named
    like an output are replaced. Narrow: no shuffle; a task holds one batch,
    a worker a bounded memo of words.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    new = [out] + ([decoded] if decoded else [])
    kept = [c for c in df.columns if c not in new]
    raw = "_utf8"
    while raw in kept:
        raw += "_"
    work = df.select(*kept, text_bytes(text).alias(raw))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in work.schema if f.name != raw]
                       + [f"`{out}` array<int>"] + ([f"`{decoded}` string"] if decoded else []))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        encoder, decoder, known = v.in_worker()
        for table in batches(it, BATCH, raw):
            buf, off = binary_column(table[raw])
            data = buf.tobytes()
            cut = []
            for i in range(len(off) - 1):
                s = data[off[i]:off[i + 1]].decode("utf-8", "replace").replace(" ", MARK)
                cut.append(_WORD.findall((MARK if v.prefix and s else "") + s))
            new_words = known.missing(set().union(*cut))
            memo, own = known.new, dict(zip(new_words, encoder.encode_sorted(new_words)))
            memo |= {w: x for w, x in own.items() if len(w) <= MAX_MEMO_WORD}
            own = {w: x for w, x in own.items() if len(w) > MAX_MEMO_WORD}
            parts = []
            for words in cut:
                try:
                    parts.append(b"".join([memo[w] for w in words]))
                except KeyError:
                    parts.append(b"".join([memo[w] if w in memo else own[w] for w in words]))
            ends = np.cumsum([0] + [len(p) // 4 for p in parts])
            ids = np.frombuffer(b"".join(parts), np.int32)
            table = table.drop_columns([raw])
            table = table.append_column(out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)))
            if decoded:
                table = table.append_column(decoded, pa.array(
                    [decoder.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])], pa.string()))
            yield from table.to_batches()

    return work.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "piece_ids", out: str = "text") -> DataFrame:
    """Adds ``out``: the text of the piece ids (null ids: null). Ids outside
    the vocabulary raise. Narrow."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(shared.value)
        for col in it:
            yield col.map(lambda x: None if x is None else decoder.decode(x))

    return df.withColumn(out, run(F.col(ids)))


def q_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded_digest(docs, Vocabulary())


def encoded_digest(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids, their number, and whether decoding gave the text back."""
    done = encode(docs, vocabulary, decoded="decoded")
    return done.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.regexp_replace(F.coalesce("text", F.lit("")), MARK, " ")).alias("round_trip"))
