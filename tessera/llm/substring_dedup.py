"""Operator 6: repeated passages, found by difference-cover anchors.

A passage of ``n`` words that occurs at word ``i`` of one document and word
``j`` of another has, for a difference cover D modulo a period v, some
k < v with both (i + k) mod v and (j + k) mod v in D. So it is enough to hash
windows of ``n - v + 1`` words at the places in D (3 of 7 here): every longer
match shares such an aligned anchor. Only where an anchor is shared, the match
is extended: the full windows around it are hashed and compared.

Documents are packed into blocks (compressed texts, a few MB). Blocks and hash
ranges exchange packed arrays: a block sends each anchor once, so a passage
that is in very many documents costs a range one entry a block, and gets back
one bit for each entry it sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NOT_SPACE, batches, binary_column, hash_windows, hash_words, materialise, text_bytes,
                     words_of)

WINDOW = 13
PERIOD, COVER = 7, (1, 2, 4)     # every difference modulo 7 is one of two members
BLOCK_BYTES = 3 << 20
RANGE_ENTRIES = 2_000_000        # a hash range's share of all entries, about
ANCHOR_BYTES = 5                 # sent of an anchor's hash, behind the range's bits

_BLOCK = "block long, ids array<long>, offsets binary, packed binary, n_words long"


def _pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in batches(it, BLOCK_BYTES, "raw"):
        buf, off = binary_column(table["raw"])
        n = len(words_of(buf, off, NOT_SPACE)[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([table["id"].to_pylist()], pa.list_(pa.int64())), pa.array([off.tobytes()]),
             pa.array([zstandard.ZstdCompressor(3).compress(buf.tobytes())]), pa.array([n], pa.int64())],
            ["ids", "offsets", "packed", "n_words"])


class Block:
    """The words of a block and their hashes."""

    def __init__(self, row: dict, range_bits: int):
        self.no, self.range_bits = row["block"], range_bits
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        size = int(self.offsets[-1])
        self.data = zstandard.ZstdDecompressor().decompress(row["packed"], max_output_size=max(size, 1)) if size else b""
        buf = np.frombuffer(self.data, np.uint8)
        self.ids = row["ids"]
        self.starts, self.ends, self.first = words_of(buf, self.offsets, NOT_SPACE)
        self.hash = hash_words(buf, self.starts, self.ends)
        count = np.diff(self.first)
        # documents without an id take no part in the comparison
        count_of = np.where([i is None for i in self.ids], 0, count) if self.ids else count
        self.doc = np.repeat(np.arange(len(count)), count)
        self.place = np.arange(len(self.doc)) - self.first[:-1][self.doc]
        self.left = count_of[self.doc] - self.place      # words from here to the document's end
        self.doc_id = np.array([0 if i is None else i for i in self.ids], np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in order, whether two documents here share each,
        the anchors' word numbers and which distinct anchor each one is."""
        size = WINDOW - PERIOD + 1
        in_cover = np.zeros(PERIOD, bool)
        in_cover[list(COVER)] = True
        at = np.flatnonzero(in_cover[self.place % PERIOD] & (self.left >= size) & (self.left + self.place >= WINDOW))
        hashes = hash_windows(self.hash, size)[at]
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.ones(len(order), bool)
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        heads = np.flatnonzero(new)
        doc = self.doc[at][order]
        shared = (np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)) if len(heads) else np.zeros(0, bool)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        return ordered[heads], shared, at, which

    def candidates(self, shared: np.ndarray, at: np.ndarray, which: np.ndarray):
        """Windows that hold a shared anchor: distinct (hash, check) in order,
        the smallest id of each, the windows' word numbers and which they are."""
        mark = np.zeros(len(self.doc) + PERIOD + 1, np.int64)
        mark[at[shared[which]] + 1] = 1
        run = np.cumsum(mark)
        n = len(self.doc)
        at = np.flatnonzero((run[PERIOD:PERIOD + n] - run[:n] > 0) & (self.left >= WINDOW))
        main = hash_windows(self.hash, WINDOW)[at]
        check = (hash_windows(self.hash, WINDOW, 1)[at] >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(main)
        a, b = main[order], check[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        heads = np.flatnonzero(new)
        least = np.minimum.reduceat(self.doc_id[self.doc[at]][order], heads) if len(heads) else np.zeros(0, np.int64)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        return a[heads], b[heads], least, at, which

    def ranges(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(range, from, to) of the ordered hashes."""
        if len(hashes) == 0:
            return
        no = (hashes >> np.uint64(64 - self.range_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(no)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(no)]):
            yield int(no[a]), int(a), int(b)

    def answer(self, hashes: np.ndarray, answers: list[dict] | None) -> np.ndarray:
        """The bits that the hash ranges sent back, in the hashes' order."""
        by = {x["range"]: x["bits"] for x in answers or ()}
        out = np.zeros(len(hashes), bool)
        for no, a, b in self.ranges(hashes):
            out[a:b] = np.unpackbits(np.frombuffer(by[no], np.uint8), count=b - a)
        return out


def _rows(it: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in it:
        for i in range(batch.num_rows):
            yield {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}


def _grouped(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each range, which come one range after another."""
    held: list[dict] = []
    for row in _rows(it):
        if held and row["range"] != held[0]["range"]:
            yield held[0]["range"], held
            held = []
        held.append(row)
    if held:
        yield held[0]["range"], held


def _replies(rows: list[dict], bits: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum([r["n"] for r in rows])
    return pa.RecordBatch.from_arrays(
        [pa.array([r["block"] for r in rows], pa.int64()), pa.array([r["range"] for r in rows], pa.int32()),
         pa.array([np.packbits(b).tobytes() for b in np.split(bits, ends[:-1])])], ["block", "range", "bits"])


def _shared_anchors(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _grouped(it):
        wide = np.zeros((sum(r["n"] for r in rows), 8), np.uint8)
        wide[:, :ANCHOR_BYTES] = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8).reshape(-1, ANCHOR_BYTES)
        values = wide.view(np.uint64).ravel()
        here = np.concatenate([np.unpackbits(np.frombuffer(r["shared"], np.uint8), count=r["n"]) for r in rows]).astype(bool)
        order = np.argsort(values)
        v = values[order]
        same = np.zeros(len(v) + 1, bool)
        same[1:-1] = v[1:] == v[:-1]
        bits = np.empty(len(v), bool)
        bits[order] = same[1:] | same[:-1]          # two blocks have it (or their hashes' ends agree: extending tells)
        yield _replies(rows, bits | here)


def _smaller_elsewhere(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _grouped(it):
        main = np.frombuffer(b"".join(r["data"] for r in rows), np.uint64)
        check = np.frombuffer(b"".join(r["checks"] for r in rows), np.uint32)
        least = np.concatenate([np.frombuffer(r["least"], r["kind"]).astype(np.int64) + r["base"] for r in rows])
        order = np.argsort(main)
        a, b = main[order], check[order]
        if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():   # hashes collide, their checks tell them apart
            order = np.lexsort((check, main))
            a, b = main[order], check[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        smallest = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        bits = np.empty(len(order), bool)
        bits[order] = smallest < least[order]
        yield _replies(rows, bits)


def drop_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, n_words, n_removed, kept_text.

    Words are separated by ASCII white space. Every word is removed that lies
    in a window of 13 words which also starts in a document with a smaller id;
    windows are judged on the input. Kept words are joined by one space. Null
    and empty texts have no words; a row without an id is neither a source nor
    changed; rows with one id are no sources for each other. Other columns
    play no part. An empty table gives an empty result.

    Exchanges: 3/7 of all windows at 5 bytes, the candidates' windows at
    16 to 20 bytes, one bit back for each, and the packed texts twice. The
    number of hash ranges follows the word count, so a range task's arrays are
    bounded; a block task holds one block.
    """
    source = df.select(F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("raw"))
    blocks = materialise(
        source.mapInArrow(_pack, "ids array<long>, offsets binary, packed binary, n_words long")
        .withColumn("block", F.monotonically_increasing_id()).select("block", "ids", "offsets", "packed", "n_words"), "blocks")
    words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = max(4, (words // RANGE_ENTRIES).bit_length())
    low = np.uint64(64 - bits - 8 * ANCHOR_BYTES)

    def send_anchors(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(it):
            block = Block(row, bits)
            hashes, shared, _, _ = block.anchors()
            ends = np.ascontiguousarray((hashes >> low)).view(np.uint8).reshape(-1, 8)[:, :ANCHOR_BYTES]
            out = [(block.no, no, b - a, ends[a:b].tobytes(), np.packbits(shared[a:b]).tobytes())
                   for no, a, b in block.ranges(hashes)]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(
                zip(*out) if out else [()] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                ["block", "range", "n", "data", "shared"])

    def exchange(sent: DataFrame, reply) -> DataFrame:
        back = (sent.repartition(1 << bits, "range").sortWithinPartitions("range")
                .mapInArrow(reply, "block long, range int, bits binary"))
        return materialise(back, "replies")

    def with_replies(*replies: DataFrame) -> DataFrame:
        out = blocks
        for i, r in enumerate(replies):
            own = r.groupBy("block").agg(F.collect_list(F.struct("range", "bits")).alias(f"reply{i}"))
            out = out.join(own, "block", "left")
        return out

    def send_windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(it):
            block = Block(row, bits)
            hashes, _, at, which = block.anchors()
            main, check, least, _, _ = block.candidates(block.answer(hashes, row["reply0"]), at, which)
            out = []
            for no, a, b in block.ranges(main):
                own = least[a:b]
                base = int(own.min())
                kind = "<u4" if int(own.max()) - base < 1 << 32 else "<i8"
                out.append((block.no, no, b - a, main[a:b].tobytes(), check[a:b].tobytes(),
                            (own - (base if kind == "<u4" else 0)).astype(kind).tobytes(), base if kind == "<u4" else 0, kind))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(
                zip(*out) if out else [()] * 8,
                (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.string()))],
                ["block", "range", "n", "data", "checks", "least", "base", "kind"])

    def remove(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(it):
            block = Block(row, bits)
            hashes, _, at, which = block.anchors()
            main, check, least, at, which = block.candidates(block.answer(hashes, row["reply0"]), at, which)
            elsewhere = block.answer(main, row["reply1"])
            gone = at[elsewhere[which] | (block.doc_id[block.doc[at]] > least[which])]
            change = np.zeros(len(block.doc) + 1, np.int64)
            np.add.at(change, gone, 1)
            np.add.at(change, gone + WINDOW, -1)
            out_word = np.cumsum(change)[:-1] > 0
            removed = np.bincount(block.doc[out_word], minlength=len(block.ids))
            texts = []
            for d in range(len(block.ids)):
                if not removed[d]:
                    texts.append(b" ".join(block.data[block.offsets[d]:block.offsets[d + 1]].split()))
                    continue
                a, b = block.first[d], block.first[d + 1]
                kept = np.concatenate(([False], ~out_word[a:b], [False]))
                turns = np.flatnonzero(kept[1:] != kept[:-1]) + a
                texts.append(b" ".join(b" ".join(block.data[block.starts[x]:block.ends[y - 1]].split())
                                       for x, y in zip(turns[::2], turns[1::2])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), pa.array(np.diff(block.first), pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "n_words", "n_removed", "raw"])

    anchors = exchange(blocks.mapInArrow(send_anchors, "block long, range int, n long, data binary, shared binary"),
                       _shared_anchors)
    windows = exchange(with_replies(anchors).mapInArrow(
        send_windows, "block long, range int, n long, data binary, checks binary, least binary, base long, kind string"),
        _smaller_elsewhere)
    return with_replies(anchors, windows).mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, raw binary").withColumn(
        "kept_text", F.col("raw").cast("string")).drop("raw")


def q_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
