"""Operator 7: benchmark decontamination with an FM-index for each shard.

A shard is a batch of documents. Its words become symbols: words of the
benchmark by number, all others (and document borders) by separators, runs of
which shrink to one; no benchmark phrase holds a separator, so nothing that
could match is lost. Suffixes are sorted up to their separator, which gives
the Burrows-Wheeler transform; a wavelet matrix over it answers ranks.
All phrases walk backwards through it together; occurrences are located by
stepping to a sampled suffix. Spans of hits are merged for removal.
"""

from __future__ import annotations

import pickle
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, batches, binary_column, hash_words, materialise, numbered, packed, ragged, text_bytes, words_of

PHRASE = 10                      # words
SHARD_BYTES = 8 << 20            # of text in an index
QUERY_BYTES = 16 << 20           # of benchmark text searched in one pass; more text, more passes
SAMPLE = 8                       # every so many suffix positions is kept


class Ranks:
    """A bit vector with rank: ones before a position."""

    def __init__(self, bits: np.ndarray):
        size = (len(bits) + 64) // 64
        raw = np.zeros(size * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        raw[:len(packed)] = packed
        self.words = raw.view("<u8")
        self.before = np.zeros(size + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """A wavelet matrix: symbols by bits from the highest, one rank vector a level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels = []
        for level in range(self.depth - 1, -1, -1):
            bits = (symbols >> level) & 1 == 1
            ranks = Ranks(bits)
            self.levels.append((level, ranks, len(symbols) - ranks.ones))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``at``."""
        begin = np.zeros_like(at)
        for level, ranks, zeros in self.levels:
            one = (symbol >> level) & 1 == 1
            a, b = ranks.rank(begin), ranks.rank(at)
            begin, at = np.where(one, zeros + a, begin - a), np.where(one, zeros + b, at - b)
        return at - begin

    def step(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbol, begin = np.zeros_like(at), np.zeros_like(at)
        for level, ranks, zeros in self.levels:
            one = ranks.get(at)
            symbol |= one.astype(np.int64) << level
            a, b = ranks.rank(begin), ranks.rank(at)
            begin, at = np.where(one, zeros + a, begin - a), np.where(one, zeros + b, at - b)
        return symbol, at - begin


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` (ending in a 0) in order, compared up to and with
    their first 0; zeros count as different symbols, earlier ones smaller.

    Prefix doubling: ranks by the first four symbols, then only suffixes
    whose rank is still shared are sorted by the rank behind them."""
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    to_zero = zeros[np.searchsorted(zeros, np.arange(n))] - np.arange(n)
    width = 4 if int(text.max(initial=0)) < 1 << 16 else 2
    key = np.zeros(n, np.uint64)
    for k in range(width):
        part = np.zeros(n, np.uint64)
        inside = np.flatnonzero(to_zero >= k)
        part[inside] = text[inside + k]
        key = (key << np.uint64(64 // width)) | part
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(n, np.int64)

    def heads_of(change: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))

    change = np.ones(n, bool)
    change[1:] = ordered[1:] != ordered[:-1]
    rank[order] = heads_of(change)
    shared = np.zeros(n + 1, bool)
    shared[1:-1] = ~change[1:]
    open_ = np.flatnonzero(shared[:-1] | shared[1:])       # places of shared ranks
    known = width
    while len(open_):
        at = order[open_]
        behind = np.where(to_zero[at] < known, at, rank[np.minimum(at + known, n - 1)])
        by = np.argsort((rank[at].astype(np.uint64) << np.uint64(32)) | behind.astype(np.uint64))
        at, behind = at[by], behind[by]
        order[open_] = at
        head = rank[at]
        change = np.ones(len(at), bool)
        change[1:] = (head[1:] != head[:-1]) | (behind[1:] != behind[:-1])
        rank[at] = open_[heads_of(change)]
        shared = np.zeros(len(at) + 1, bool)
        shared[1:-1] = ~change[1:]
        open_ = open_[shared[:-1] | shared[1:]]
        known *= 2
    return order


class FMIndex:
    """Count and locate phrases in a symbol text (0: separator)."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        order = suffix_order(text)
        before = text[order - 1]
        before[order == 0] = 0
        self.wavelet = Wavelet(before, n_symbols)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        kept = (order % SAMPLE == 0) | (before == 0)       # there is no step over a separator
        self.kept = Ranks(kept)
        self.samples = order[kept]
        self.size = len(text)

    def find(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences (phrase, place) of all phrases (rows, aligned at the right)."""
        which = np.arange(len(phrases))
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        found = []
        for k in range(phrases.shape[1]):
            done = lengths[which] == k
            if done.any():
                found.append((which[done], lo[done], hi[done]))
                which, lo, hi = which[~done], lo[~done], hi[~done]
            symbol = phrases[which, phrases.shape[1] - 1 - k]
            ranks = self.wavelet.rank(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
            start = self.smaller[symbol]
            lo, hi = start + ranks[:len(which)], start + ranks[len(which):]
            some = lo < hi
            which, lo, hi = which[some], lo[some], hi[some]
            if len(which) == 0:
                break
        found.append((which, lo, hi))
        which, lo, hi = (np.concatenate(x) for x in zip(*found))
        phrase, row = np.repeat(which, hi - lo), ragged(lo, hi - lo)
        place, steps = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        walking = np.arange(len(row))
        while len(walking):
            here = self.kept.get(row[walking])
            stop = walking[here]
            place[stop] = self.samples[self.kept.rank(row[stop])] + steps[stop]
            walking = walking[~here]
            symbol, rank = self.wavelet.step(row[walking])
            row[walking] = self.smaller[symbol] + rank
            steps[walking] += 1
        return phrase, place


class Phrases:
    """The phrases of some benchmark items, over a vocabulary of their words."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int = PHRASE):
        offsets = np.concatenate(([0], np.cumsum([len(t) for _, t in items]))).astype(np.int64)
        buf = LOWER[np.frombuffer(b"".join(t for _, t in items), np.uint8)]
        starts, ends, first = words_of(buf, offsets, ALNUM)
        data = buf.tobytes()
        words = [data[a:b] for a, b in zip(starts, ends)]
        own = hash_words(buf, starts, ends)
        self.hashes, number = np.unique(own, return_inverse=True)
        self.words = [b""] * len(self.hashes)
        for i, w in zip(number, words):
            if self.words[i] not in (b"", w):
                raise ValueError("two benchmark words have one hash")
            self.words[i] = w
        seen: dict[bytes, int] = {}
        rows, owners = [], []
        number = number.astype(np.int64) + 1               # 0 is the separator
        for (item, _), a, b in zip(items, first[:-1], first[1:]):
            for k in range(a, b if b - a < n else b - n + 1):
                phrase = number[k:min(k + n, b)]
                if len(phrase) < n and k > a:
                    break
                i = seen.setdefault(phrase.tobytes(), len(rows))
                if i == len(rows):
                    rows.append(phrase)
                    owners.append(set())
                owners[i].add(item or "")
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.phrases = np.zeros((len(rows), n), np.int64)
        for i, r in enumerate(rows):
            self.phrases[i, n - len(r):] = r
        self.items = sorted({x for o in owners for x in o})
        place = {x: i for i, x in enumerate(self.items)}
        self.owner_count = np.array([len(o) for o in owners], np.int64)
        self.owners = np.array([place[x] for o in owners for x in sorted(o)], np.int64)
        self.owner_first = np.cumsum(self.owner_count) - self.owner_count


def search(p: Phrases, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[str]], tuple]:
    """Words of each text, hit flag of each word, items found in each text, word spans."""
    buf = LOWER[buf]
    starts, ends, first = words_of(buf, offsets, ALNUM)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hit, items = np.zeros(len(starts), bool), [[] for _ in range(len(offsets) - 1)]
    if len(starts) == 0 or len(p.lengths) == 0:
        return first, hit, items, (starts, ends, doc)
    own = hash_words(buf, starts, ends)
    number = np.minimum(np.searchsorted(p.hashes, own), len(p.hashes) - 1)
    symbol = np.where(p.hashes[number] == own, number + 1, 0)
    while True:
        # separators at document borders; runs of separators become one
        border = np.zeros(len(symbol) + 1, bool)
        border[first[1:]] = True
        text = np.zeros(2 * len(symbol) + 1, np.int64)
        word = np.full(2 * len(symbol) + 1, -1)
        text[0:-1:2], word[0:-1:2] = symbol, np.arange(len(symbol))
        keep = np.ones(len(text), bool)
        keep[1::2] = border[1:]
        zero = (text == 0) & keep
        kept = np.flatnonzero(keep)
        keep[kept[1:][zero[kept[1:]] & zero[kept[:-1]]]] = False
        text, word = text[keep], word[keep]
        if text[-1] != 0:
            text, word = np.append(text, 0), np.append(word, -1)
        phrase, place = FMIndex(text, len(p.hashes) + 1).find(p.phrases, p.lengths)
        at, size = word[place], p.lengths[phrase]
        change = np.zeros(len(symbol) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
        hit = np.cumsum(change)[:-1] > 0
        # exact check: hashes of words may collide, their bytes do not
        data = buf.tobytes()
        wrong = [i for i in np.flatnonzero(hit) if data[starts[i]:ends[i]] != p.words[symbol[i] - 1]]
        if not wrong:
            break
        symbol[wrong] = 0
    pairs = np.unique(np.repeat(doc[at], p.owner_count[phrase]) * np.int64(len(p.items) + 1)
                      + p.owners[ragged(p.owner_first[phrase], p.owner_count[phrase])])
    for d, i in zip(*(x.tolist() for x in np.divmod(pairs, len(p.items) + 1))):
        items[d].append(p.items[i])
    return first, hit, items, (starts, ends, doc)


_FOUND = "n_words long, spans array<struct<word:long,words:long,start:long,end:long>>, items array<string>"


def _pass(work: DataFrame, p: Phrases, key: str, kind: str, only_hits: bool) -> DataFrame:
    shared = work.sparkSession.sparkContext.broadcast(p)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for table in batches(it, SHARD_BYTES, "raw"):
            buf, offsets = binary_column(table["raw"])
            first, hit, items, (starts, ends, doc) = search(p, buf, offsets)
            spans: list[list] = [[] for _ in items]
            edge = np.ones(len(hit) + 1, bool)
            if len(hit):
                edge[1:-1] = (hit[1:] != hit[:-1]) | (doc[1:] != doc[:-1])
                cuts = np.flatnonzero(edge)
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if hit[a]:
                        d = doc[a]
                        spans[d].append({"word": int(a - first[d]), "words": int(b - a),
                                         "start": int(starts[a] - offsets[d]), "end": int(ends[b - 1] - offsets[d])})
            out = pa.table({key: table[key], "n_words": np.diff(first), "spans": pa.array(spans, span_type),
                            "items": pa.array(items, pa.list_(pa.string()))})
            if only_hits:
                out = out.filter(pa.array([bool(s) for s in spans], pa.bool_()))
            yield from out.to_batches()

    span_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("word", "words", "start", "end")]))
    return work.select(key, "raw").mapInArrow(run, f"{key} {kind}, {_FOUND}")


def phrase_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``block, data``: the phrases of at most QUERY_BYTES of items (a longer
    item alone), built in tasks and written; the driver lists the blocks and
    passes them on one at a time."""
    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at, block in enumerate(batch.column("block").to_pylist()):
                items, texts = (c.to_pylist() for c in batch.column("rows").slice(at, 1).flatten().flatten())
                data = pickle.dumps(Phrases(list(zip(items, texts))))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data], pa.binary())], ["block", "data"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), text_bytes(text).alias("raw"))
    blocks = packed(rows, ["item", "raw"], "raw", QUERY_BYTES, max(QUERY_BYTES, 1), "benchmark")
    return materialise(blocks.mapInArrow(build, "block long, data binary"), "phrases")


def contamination(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, n_words, spans, items.

    Texts are lower-cased (A-Z); words are runs of digits, letters a-z and
    bytes beyond ASCII. A phrase is 10 consecutive words of an item; an item
    of fewer words, but not none, is one phrase. ``spans`` are the merged
    runs of words covered by occurrences (word number and count, byte range
    for cutting); ``items`` the ids, as strings in order, of the items with an
    occurring phrase (a null id is the empty string). Null and empty texts
    have no words. Rows, repeated ones too, are judged one by one; empty
    tables on either side give no rows or no hits.

    Narrow: no shuffle while the benchmark fits one pass. The item texts are
    broadcast in blocks of at most ``QUERY_BYTES`` (a longer single item is a
    block of its own), so what is broadcast is bounded and a larger benchmark
    takes more passes, whose hits are joined by row number.
    """
    df, kind = df.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("raw")), dict(df.dtypes)[doc_id]
    blocks = phrase_blocks(benchmark, item_id, item_text)
    numbers = [r.block for r in blocks.select("block").collect()]

    def phrases(block: int) -> Phrases:
        return pickle.loads(blocks.filter(F.col("block") == block).first().data)

    if len(numbers) < 2:
        return _pass(df, phrases(numbers[0]) if numbers else Phrases([]), "doc_id", kind, False)
    rows = materialise(df.withColumn("row", F.monotonically_increasing_id()), "contamination")
    parts = [materialise(_pass(rows, phrases(b), "row", "long", True), "contamination-pass") for b in numbers]
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    # words hit in any pass, as merged spans of one document
    merged = hits.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("s"),
                                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    span = "struct<word:bigint,words:bigint,start:bigint,end:bigint>"
    merged = merged.select("row", "items", F.expr(f"""aggregate(array_sort(s), cast(array() as array<{span}>), (done, x) ->
        if(size(done) > 0 and element_at(done, -1).word + element_at(done, -1).words >= x.word,
           concat(slice(done, 1, size(done) - 1), array(named_struct('word', element_at(done, -1).word,
             'words', greatest(element_at(done, -1).words, x.word + x.words - element_at(done, -1).word),
             'start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, x.end)))),
           concat(done, array(x))))""").alias("spans"))
    empty = _pass(rows, Phrases([]), "row", "long", False).select("row", "n_words")
    return (rows.select("row", "doc_id").join(empty, "row").join(merged, "row", "left")
            .select("doc_id", "n_words", F.coalesce("spans", F.expr(f"cast(array() as array<{span}>)")).alias("spans"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items")))


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without the rows in whose text a benchmark phrase occurs, all
    columns. Each row is decided by itself, whatever its id (null and repeated
    ids too); null and empty texts stay, as does all of an empty table or
    beside an empty benchmark."""
    rows, row = numbered(df, "benchmark-rows")
    bad = contamination(rows, benchmark, row, text).filter(F.size("spans") > 0).select(F.col("doc_id").alias(row))
    return rows.join(bad, row, "left_anti").drop(row)


def q_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
