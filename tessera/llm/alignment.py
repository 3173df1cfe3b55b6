"""Operator 11: alignment of two tokenizers over one corpus.

Every text is encoded by two tokenizers, A (byte-level) and B (pieces).
Byte offsets where tokens of both end cut the tokens into groups; an A and a
B token whose byte ranges overlap are linked. How often an id pair is linked
in the whole corpus says which ids stand for each other.

Identity-map fast path: an array holds for each A id the B id of the same
bytes. A group of exactly these two tokens is counted in a vector as long as
A's vocabulary, one for each task; only pairs of the other, irregular groups
are shuffled, summed once for each block of texts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, materialise, text_bytes
from .token_counts import byte_symbols

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 64 << 20       # of each broadcast tokenizer file; checked
BLOCK_BYTES = 1 << 20            # texts encoded and kept together, about
# the split of byte-level tokenizers of this family (fixed value)
BYTE_LEVEL_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 4096                  # texts with such long words or gaps go to the slower, linear library


@dataclass
class Tokenizer:
    """``encode`` a text to ids; ``table`` has the bytes of each id."""
    encode: Callable[[str], Sequence[int]]
    table: list[bytes]


# tokenizers are built once in each worker, not in each task
@lru_cache(4)
def byte_level(raw: bytes) -> Tokenizer:
    """A byte-level BPE file of the ``tokenizers`` library; special tokens in
    texts are plain text. Where ids follow the order of merges, as is usual,
    texts go to the faster ``tiktoken`` with the same vocabulary."""
    import tiktoken

    doc = json.loads(raw)
    symbols = byte_symbols()
    vocab: dict[str, int] = doc["model"]["vocab"]
    special = {t["id"] for t in doc.get("added_tokens", []) if t.get("special")}
    table = [b""] * (max([*vocab.values(), *special], default=-1) + 1)
    for piece, i in vocab.items():
        if i not in special:
            table[i] = bytes(symbols[c] for c in piece)
    split = doc.get("pre_tokenizer") or {}
    merges = [m if isinstance(m, str) else " ".join(m) for m in doc["model"]["merges"]]
    by_merge = [vocab[m.replace(" ", "", 1)] for m in merges]
    plain = (by_merge == sorted(by_merge) and not doc.get("normalizer") and split.get("type") == "ByteLevel"
             and split.get("use_regex", True) and not split.get("add_prefix_space"))
    fast = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_SPLIT, special_tokens={}, mergeable_ranks={
        t: i for i, t in enumerate(table) if t}) if plain else None
    long_run = re.compile(rf"\s{{{LONG_RUN}}}|\S{{{LONG_RUN}}}")

    @lru_cache(1)
    def library():
        from tokenizers import Tokenizer as Library
        own = Library.from_str(raw.decode())
        own.encode_special_tokens = True
        return own

    def encode(text: str) -> Sequence[int]:
        # long runs take the fast library time that grows with their square
        if fast is None or (len(text) > LONG_RUN and long_run.search(text)):
            return library().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return Tokenizer(encode, table)


@lru_cache(4)
def pieces(raw: bytes) -> Tokenizer:
    """A SentencePiece model; U+2581 stands for a space, <0xHH> for a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=raw)
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            table.append(bytes([int(piece[3:-1], 16)]))
        else:
            table.append(b"" if model.is_control(i) else piece.replace("▁", " ").encode())
    return Tokenizer(model.encode, table)


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each A id the (smallest) B id of the same bytes, or -1."""
    ids: dict[bytes, int] = {}
    for i, t in enumerate(b):
        if t:
            ids.setdefault(t, i)
    return np.array([ids.get(t, -1) if t else -1 for t in a], np.int64)


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MAX_MODEL_BYTES + 1)
    if len(raw) > MAX_MODEL_BYTES:
        raise ValueError(f"{path}: more than {MAX_MODEL_BYTES} bytes")
    return raw


@dataclass
class Links:
    """Links of a block of encoded texts, in order of their place."""
    a: np.ndarray            # A id of each link
    b: np.ndarray            # B id
    identity: np.ndarray     # the link is a whole group, of A's identity
    group_end: np.ndarray    # the link ends a group
    a_groups: np.ndarray     # A tokens up to the end of each group
    b_groups: np.ndarray     # B tokens
    end: np.ndarray          # byte offset of each link's end


def link(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, same: np.ndarray) -> Links:
    """Links between token sequences of the same bytes. Between two
    neighbouring token ends, of either side, lies the overlap of one pair."""
    a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    end = np.union1d(a_end, b_end)
    i, j = np.searchsorted(a_end, end), np.searchsorted(b_end, end)
    both = (a_end[i] == end) & (b_end[j] == end) if len(end) else np.zeros(0, bool)
    alone = both.copy()
    alone[1:] &= both[:-1]
    la, lb = a[i], b[j]
    return Links(la, lb, alone & (same[la] == lb), both, i[both] + 1, j[both] + 1, end)


def _pack(ids: list[list[int]]) -> bytes:
    """All ids, byte planes apart (the high ones are nearly empty), compressed."""
    flat = np.fromiter(chain.from_iterable(ids), "<u4", sum(map(len, ids)))
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T).tobytes())


def _ids(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def encoded_blocks(df: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Texts encoded by both tokenizers, a row for about a MB of texts: block,
    doc_id, n_a, n_b (arrays), and all ids of A and of B (packed)."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((_model_bytes(a_path), _model_bytes(b_path)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(shared.value[0]), pieces(shared.value[1])
        for table in batches(it, BLOCK_BYTES, "raw"):
            raw = table["raw"].to_pylist()
            texts = [t.decode("utf-8", "replace") for t in raw]
            some = [i for i, t in enumerate(texts) if t]
            ids_a = {i: first.encode(" " + texts[i]) for i in some}
            ids_b = {i: second.encode(texts[i]) for i in some}
            a: list[list[int]] = []
            b: list[list[int]] = []
            for i, t in enumerate(raw):
                # only texts that both tokenizers give back
                want = b" " + t
                whole = bool(t) and b"".join(map(first.table.__getitem__, ids_a[i])) == want == b"".join(
                    map(second.table.__getitem__, ids_b[i]))
                a.append(ids_a[i] if whole else [])
                b.append(ids_b[i] if whole else [])
            count = [pa.array([[len(x) for x in y]], pa.list_(pa.int64())) for y in (a, b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([table["id"].to_pylist()], pa.list_(pa.int64())), *count,
                 *(pa.array([_pack(y)], pa.binary()) for y in (a, b))], ["doc_id", "n_a", "n_b", "a", "b"])

    rows = df.select(F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("raw"))
    return materialise(rows.mapInArrow(run, "doc_id array<long>, n_a array<long>, n_b array<long>, a binary, b binary")
                       .withColumn("block", F.monotonically_increasing_id()), "encoded")


def _unpack(batch: pa.RecordBatch, row: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    get = lambda c: batch.column(c).slice(row, 1)
    n = [get(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n_a", "n_b")]
    ids = [_ids(batch.column(c)[row].as_py()) for c in ("a", "b")]
    return get("doc_id").flatten().to_pylist(), *n, *ids


def _shared_tables(df: DataFrame, a_path: str, b_path: str):
    a, b = byte_level(_model_bytes(a_path)).table, pieces(_model_bytes(b_path)).table
    sizes = [np.array([len(t) for t in x], np.int64) for x in (a, b)]
    return df.sparkSession.sparkContext.broadcast((*sizes, identity_map(a, b)))


def pair_counts(blocks: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES) -> tuple[DataFrame, DataFrame]:
    """(irregular pairs of each block: block, pair; all pairs: pair, n, best).

    ``pair`` is A id x (size of B) + B id, ``n`` how many links hold it in the
    whole corpus, ``best`` whether no other A id is linked to this B id more
    often. Of a block's rows each pair is one; a task's identity groups are
    summed in a vector and leave it as at most one row for each A id.
    """
    shared = _shared_tables(blocks, a_path, b_path)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_size, b_size, same = shared.value
        whole = np.zeros(len(a_size), np.int64)

        def rows(block: int | None, pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block] * len(pair), pa.int64()), pa.array(pair), pa.array(n)],
                                              ["block", "pair", "n"])
        for batch in it:
            for row, block in enumerate(batch.column("block").to_pylist()):
                _, _, _, a, b = _unpack(batch, row)
                x = link(a, b, a_size, b_size, same)
                whole += np.bincount(x.a[x.identity], minlength=len(whole))
                rest = ~x.identity
                pair, n = np.unique(x.a[rest] * len(b_size) + x.b[rest], return_counts=True)
                yield rows(block, pair, n)
        some = np.flatnonzero(whole)
        yield rows(None, some * len(b_size) + same[some], whole[some])

    pairs = materialise(blocks.mapInArrow(run, "block long, pair long, n long"), "pairs")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    b_id = F.col("pair") % len(shared.value[1])
    counts = materialise(counts.withColumn("b", b_id), "pair-counts")
    # one row for each B id at most: bounded by the vocabulary
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    counts = counts.join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    return pairs.filter("block is not null").select("block", "pair"), counts


def pair_table(counts: DataFrame, b_path: str = PIECES) -> DataFrame:
    """All linked id pairs: a, b, n (links in the corpus), best."""
    n_b = len(pieces(_model_bytes(b_path)).table)
    return counts.select((F.col("pair") / n_b).cast("long").alias("a"), (F.col("pair") % n_b).alias("b"), "n", "best")


def aligned(df: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES, doc_id: str = "doc_id",
            text: str = "text", with_groups: bool = False) -> DataFrame:
    """One row for each row of ``df``: doc_id, n_a, n_b (tokens), n_groups,
    n_links, n_best (links whose count is the highest of their B id, ties
    included), count_sum (of all links' counts), groups_sha256 and, if asked
    for, groups (``a1,a2|b1;a3|b2,b3``).

    Null and empty texts, and texts that a tokenizer does not give back (as
    those with U+2581 in them), have no tokens: zeros and an empty digest.
    Repeated rows and ids count each, null ids stay null; an empty table gives
    no rows; other columns play no part.
    """
    blocks = encoded_blocks(df, a_path, b_path, doc_id, text)
    pairs, counts = pair_counts(blocks, a_path, b_path)
    shared = _shared_tables(df, a_path, b_path)
    a_size, b_size, same = shared.value
    known = np.flatnonzero(same >= 0)
    # of the identity pairs the counts come as vectors of A's vocabulary
    own = df.sparkSession.createDataFrame(pa.table({"pair": known * len(b_size) + same[known]})) if len(known) else None
    count, best = np.zeros(len(a_size), np.int64), np.zeros(len(a_size), bool)
    for r in counts.join(F.broadcast(own), "pair").collect() if own is not None else []:
        count[r.pair // len(b_size)], best[r.pair // len(b_size)] = r.n, r.best
    vectors = df.sparkSession.sparkContext.broadcast((count, best))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_size, b_size, same = shared.value
        whole_count, whole_best = vectors.value
        names = [b"%d%c" % (i, c) for i in range(len(a_size)) for c in (0x2C, 0x7C)]
        names += [b"%d%c" % (i, c) for i in range(len(b_size)) for c in (0x2C, 0x3B)]
        for batch in it:
            found = batch.column("found")
            for row in range(batch.num_rows):
                ids, n_a, n_b, a, b = _unpack(batch, row)
                x = link(a, b, a_size, b_size, same)
                pair, times, best = (c.to_numpy(zero_copy_only=False) for c in found.slice(row, 1).flatten().flatten())
                order = np.argsort(pair)
                at = order[np.searchsorted(pair[order], x.a[~x.identity] * len(b_size) + x.b[~x.identity])]
                n, top = whole_count[x.a], whole_best[x.a]
                n[~x.identity], top[~x.identity] = times[at], best[at]
                # tokens of a document end where its bytes end
                a_to, b_to = np.cumsum(n_a), np.cumsum(n_b)
                ends = np.concatenate(([0], np.cumsum(a_size[a])))[a_to]
                to = np.searchsorted(x.end, ends, side="right")

                def of_docs(v: np.ndarray) -> np.ndarray:
                    return np.diff(np.concatenate(([0], np.cumsum(v, dtype=np.int64)))[np.concatenate(([0], to))])

                # the tokens of A and B in the order of the text form
                g_a, g_b = np.searchsorted(x.a_groups, np.arange(len(a)), side="right"), np.searchsorted(
                    x.b_groups, np.arange(len(b)), side="right")
                code = np.empty(len(a) + len(b), np.int64)
                before = np.concatenate(([0], x.b_groups))
                last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                last_a[x.a_groups - 1] = 1
                last_b[x.b_groups - 1] = 1
                code[np.arange(len(a)) + before[g_a]] = 2 * a + last_a
                code[np.arange(len(b)) + x.a_groups[g_b]] = 2 * (len(a_size) + b) + last_b
                groups, at = [], 0
                for end in (a_to + b_to).tolist():
                    groups.append(b"".join(map(names.__getitem__, code[at:end].tolist()))[:-1])
                    at = end
                cols = [pa.array(ids, pa.int64()), pa.array(n_a), pa.array(n_b), pa.array(of_docs(x.group_end)),
                        pa.array(np.diff(to, prepend=0)), pa.array(of_docs(top)), pa.array(of_docs(n)),
                        pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string())]
                if with_groups:
                    cols.append(pa.array([g.decode() for g in groups], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, fields)

    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string" + (", groups string" if with_groups else ""))
    fields = [c.split()[0] for c in schema.split(", ")]
    of_block = pairs.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("found"))
    none = F.array().cast("array<struct<pair:bigint,n:bigint,best:boolean>>")
    return (blocks.join(of_block, "block", "left").withColumn("found", F.coalesce("found", none))
            .select("doc_id", "n_a", "n_b", "a", "b", "found").mapInArrow(run, schema))


def q_alignment(spark, sf_dir: str) -> DataFrame:
    return aligned(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
