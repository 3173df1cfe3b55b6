"""Operator 5: a hidden Markov language model.

Latent states emit word classes: each word of LEAST_COUNT occurrences is a
class, all other words (rare and unknown ones) share one, the end of a text is
one. The most frequent classes are numbered and broadcast; the emissions of
the others stay in a Spark table. Texts are encoded in blocks, and a block
meets each of its other words once: words and blocks are dealt to shards of
words, in which counts, weights and expected counts pass between the two as
packed arrays. Within the shared class a word has its add-one probability
among the rare words, which does not depend on the state; so it leaves the
recursion and is summed on its own. Training is Baum-Welch: each pass collects
expected counts in the partitions and adds them up; scoring is the scaled
forward recursion over the whole text, which gives its exact probability under
the model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import chains
from .common import batches, binary_column, discard, free_shuffles, materialise, materialise_rounds, ragged, text_bytes

STATES = 8
PASSES = 4
CLASSES = 60_000            # words whose emissions are broadcast, at most; those of others are joined
LEAST_COUNT = 4             # of a word with emissions of its own
LONGEST_CLASS = 64          # bytes of a word that is broadcast
PRIOR = 2000.0              # pseudo-tokens a state's emissions take from the corpus
RARE, END = 0, 1
MAX_COUNTED = 300_000       # words a task counts before it sends them on
BLOCK = 8 << 20             # bytes of texts in a block
PAIRS = 1_000_000           # of blocks and words that are not broadcast, in a shard of words, about
PIECE = 512                 # rows of broadcast counts that are added up together
HELD_TOKENS = 3_000_000     # tokens a task works on together
EVERY = 4                   # steps of a recursion from scaling to scaling
ROUNDS = 2                  # parts of the texts that a pass joins with weights one after another: bounds its scratch files
WEIGHTS = [f"x{s}" for s in range(STATES)]


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def send() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

    for table in batches(it, 4 << 20, "raw"):
        buf, off = binary_column(table["raw"])
        # texts are joined by a space: the same words as one by one
        data = buf.tobytes().lower()
        for a, b in zip(off[:-1], off[1:]):
            held.update(data[a:b].split())
            if len(held) > MAX_COUNTED:
                yield send()
                held.clear()
    if held:
        yield send()


def _array(col: pa.ChunkedArray, i: int, kind: str) -> np.ndarray:
    """The packed array in row ``i`` of a binary column."""
    return np.frombuffer(col[i].as_buffer(), kind)


def _deal(shards: int):
    """Blocks' words → a row for each block and shard: its words and their places."""
    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch["words"][i].as_buffer(), np.uint8)
                size = np.frombuffer(batch["sizes"][i].as_buffer(), "<i4").astype(np.int64)
                ends = np.cumsum(size)
                raw = data.tobytes()
                own = np.fromiter((crc32(raw[a:b]) for a, b in zip((ends - size).tolist(), ends.tolist())), np.int64, len(size)) % shards
                order = np.argsort(own, kind="stable")
                cuts = np.searchsorted(own[order], np.arange(shards + 1))
                out: list[list] = [[], [], [], [], [], []]
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    at = order[cuts[k]:cuts[k + 1]]
                    words = data[ragged((ends - size)[at], size[at])].tobytes()
                    for x, y in zip(out, (k, batch["block"][i].as_py(), batch["held_out"][i].as_py(), at.astype("<i4").tobytes(), words, size[at].astype("<i4").tobytes())):
                        x.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 3))],
                                                 ["shard", "block", "held_out", "places", "words", "sizes"])
    return deal


LINKS = "shard int, block long, held_out boolean, places binary, c binary, at binary"


def _look_up(broadcast_words):
    """Blocks' words of a shard and its counted words → the places of the
    counted words in the blocks and their counts; first those with emissions
    that are not broadcast, whose rank by id in the shard is ``at``."""
    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        known = broadcast_words.value[0]
        words = right["word"].combine_chunks().cast(pa.large_binary())
        c, ids = right["c"].to_numpy(), right["id"].to_numpy()
        own = np.array([i for i in np.flatnonzero(c >= LEAST_COUNT).tolist() if words[i].as_py() not in known], np.int64)
        rank = np.full(len(c), -1, np.int64)
        rank[own[np.argsort(ids[own])]] = np.arange(len(own))
        size = np.frombuffer(binary_column(left["sizes"])[0].tobytes(), "<i4")
        places = np.frombuffer(binary_column(left["places"])[0].tobytes(), "<i4")
        off = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        asked = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(off), pa.py_buffer(binary_column(left["words"])[0])])
        found = pc.index_in(asked, value_set=words).fill_null(-1).to_numpy().astype(np.int64)
        cuts = binary_column(left["sizes"])[1] // 4
        out: list[list] = [[], [], []]
        for a, b in zip(cuts[:-1], cuts[1:]):
            hit = np.flatnonzero(found[a:b] >= 0) + a
            at = rank[found[hit]]
            order = np.argsort(at < 0, kind="stable")
            hit, at = hit[order], at[order]
            for x, y in zip(out, (places[hit], c[found[hit]].astype("<i8"), at[at >= 0].astype("<i4"))):
                x.append(y.tobytes())
        return pa.Table.from_arrays([left["shard"], left["block"], left["held_out"], *(pa.array(x, pa.binary()) for x in out)],
                                    ["shard", "block", "held_out", "places", "c", "at"])
    return look_up


GIVEN = "shard int, block long, places binary, c binary, weights binary"


def _sorted_weights(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Order by id, and the weights in it."""
    order = np.argsort(table["id"].to_numpy())
    return order, np.stack([table[x].to_numpy()[order] for x in WEIGHTS], axis=1) if len(order) else np.zeros((0, STATES))


def _give(whole: bool):
    """Weights of a shard's words → to each block those of its words; ``whole``:
    and the counts of all its words."""
    def give(links: pa.Table, words: pa.Table) -> pa.Table:
        weights = _sorted_weights(words)[1].astype("<f4")
        out: list[list] = [[], [], []]
        for i in range(links.num_rows):
            at = _array(links["at"], i, "<i4")
            places = _array(links["places"], i, "<i4")
            for x, y in zip(out, (places if whole else places[:len(at)], _array(links["c"], i, "<i8") if whole else at[:0], weights[at])):
                x.append(y.tobytes())
        return pa.Table.from_arrays([links["shard"], links["block"], *(pa.array(x, pa.binary()) for x in out)], ["shard", "block", "places", "c", "weights"])
    return give


SUMS = "shard int, sums binary"


def _add(table: pa.Table) -> pa.Table:
    """Expected counts of a shard's words, by block, and the words' ranks
    (``at``), by block → their sums by rank. Without ranks rows are added up
    as they are."""
    ranks = {}
    counts = []
    for i, (block, at) in enumerate(zip(table["block"].to_pylist(), table["at"])):
        if at.is_valid:
            ranks[block] = np.frombuffer(at.as_buffer(), "<i4")
        else:
            counts.append((block, _array(table["counts"], i, "<f8").reshape(-1, STATES)))
    if ranks:
        out = np.zeros((1 + max((int(x.max()) for x in ranks.values() if len(x)), default=-1), STATES))
        for block, x in counts:
            out[ranks[block]] += x                     # a block has a word once
    else:
        out = np.zeros_like(counts[0][1])
        for _, x in counts:
            out += x
    return pa.Table.from_arrays([table["shard"].slice(0, 1), pa.array([out.tobytes()], pa.binary())], ["shard", "sums"])


class Model:
    """Start, transition and emission probabilities (classes × states)."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, n: int, v: int, seed: int = 11,
                 tail_n: int = 0, tail_v: int = 0):
        self.number = {w: i + 2 for i, w in enumerate(words)}
        self.logs = np.zeros(len(words) + 2)                 # log10(c + 1) of each class
        self.logs[2:] = np.log10(np.array(counts, float) + 1)
        self.logs[END] = np.log10(ends + 1)
        self.ends, self.n, self.v = ends, n, v
        self.rare_n = n - ends - sum(counts) - tail_n
        self.rare_v = v - len(words) - (ends > 0) - tail_v
        base = np.concatenate(([self.rare_n + 1.0, ends + 1.0], counts))
        self.unit = base.sum() + tail_n
        self.base = base / self.unit
        rng = np.random.default_rng(seed)
        self.emit = self.base[:, None] * np.exp(rng.normal(size=(len(base), STATES)))
        self.total = self.emit.sum(axis=0)                   # of all weights of a state; emissions are weight / total
        self.emit /= self.total
        self.tail = self.uses = None
        self.start = np.full(STATES, 1 / STATES)
        self.step = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(self.step, 0.9)

    def attach(self, words: DataFrame, uses: DataFrame) -> None:
        """Words (word, id, c, shard) that are not broadcast, and their places
        in blocks of texts: ``uses`` (LINKS)."""
        even = lambda *x: (F.shiftrightunsigned(F.xxhash64("word", *map(F.lit, x)), 11) + 1) * 2.0 ** -53
        normal = lambda s: F.sqrt(-2 * F.ln(even(s, 0))) * F.cos(even(s, 1) * (2 * np.pi))
        self.tail = materialise(words.select("id", "c", "shard", *((F.col("c") / float(self.unit) * F.exp(normal(s))).alias(x)
                                                                   for s, x in enumerate(WEIGHTS))), "emissions")
        self.uses = uses
        total = self.total + np.array(self.tail.agg(*(F.sum(x) for x in WEIGHTS)).first(), float)
        self.emit *= self.total / total
        self.total = total

    def placed(self, encoded: DataFrame, links: DataFrame | None = None) -> Iterator[tuple[DataFrame, DataFrame | None]]:
        """Encoded texts with the weights of their words that are not
        broadcast, in ROUNDS parts, and the ranks of those words; with
        ``links`` also the counts of all their words."""
        if self.tail is None and links is None:
            yield encoded, None
            return
        for i in range(ROUNDS):
            part = F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == i
            uses = (self.uses if links is None else links).filter(part)
            if self.tail is None:
                own = uses.withColumn("weights", F.lit(b""))
            else:
                own = uses.groupBy("shard").cogroup(self.tail.select("shard", "id", *WEIGHTS).groupBy("shard")).applyInArrow(_give(links is not None), GIVEN)
            own = own.groupBy("block").agg(F.collect_list(F.struct("shard", "places", "c", "weights")).alias("tail"))
            yield encoded.filter(part).join(own, "block", "left"), uses

    def update(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray, total: np.ndarray | None = None,
               tail: DataFrame | None = None) -> None:
        """Probabilities from expected counts; emissions shrink towards the
        corpus. ``total``: expected tokens of each state, ``tail``: (SUMS)
        expected counts of words that are not broadcast."""
        self.start = (start + 1) / (start + 1).sum()
        self.step = (step + 1) / (step + 1).sum(axis=1, keepdims=True)
        emit = emit + PRIOR * self.base[:, None]
        self.total = emit.sum(axis=0) if total is None else total + PRIOR
        self.emit = emit / self.total
        if tail is not None:
            prior = PRIOR / float(self.unit)

            def renew(words: pa.Table, sums: pa.Table) -> pa.Table:
                # a word without expected counts keeps the prior
                order = np.argsort(words["id"].to_numpy())
                out = np.repeat(prior * words["c"].to_numpy()[order, None], STATES, axis=1)
                for i in range(sums.num_rows):
                    own = _array(sums["sums"], i, "<f8").reshape(-1, STATES)
                    out[:len(own)] += own
                return pa.Table.from_arrays([*(words[x].take(pa.array(order)) for x in ("id", "c", "shard")),
                                             *(pa.array(np.ascontiguousarray(x)) for x in out.T)], ["id", "c", "shard", *WEIGHTS])

            before = self.tail
            kinds = "id long, c long, shard int, " + ", ".join(f"{x} double" for x in WEIGHTS)
            self.tail = materialise(before.groupBy("shard").cogroup(tail.groupBy("shard")).applyInArrow(renew, kinds), "emissions")
            discard(before)


def _held(it: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Encoded texts in portions: table, class numbers, where each text's
    begin; weights of the words numbered from ``size`` on."""
    for table in batches(it, 2 * HELD_TOKENS, "classes"):
        raw, off = binary_column(table["classes"])
        classes, off = np.frombuffer(raw.tobytes(), "<u2").astype(np.int64), off // 2
        if "counts" in table.column_names:
            # a row is a block of texts
            off = np.concatenate(([0], np.cumsum(np.frombuffer(binary_column(table["counts"])[0].tobytes(), "<i4"), dtype=np.int64)))
        weights = np.zeros((0, STATES))
        if "tail" in table.column_names:
            # the words of a block that are not broadcast, by place: their number or RARE
            lists = table["tail"].combine_chunks()
            part = lists.flatten()
            weights = np.frombuffer(binary_column(part.field("weights"))[0].tobytes(), "<f4").reshape(-1, STATES).astype(float)
            n = table["n_other"].to_numpy()
            first = np.cumsum(n) - n
            block = np.repeat(np.arange(len(n)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            own = np.diff(binary_column(part.field("weights"))[1]) // (4 * STATES)
            places, cuts = binary_column(part.field("places"))
            numbers = np.full(int(n.sum()), RARE, np.int64)
            numbers[np.frombuffer(places.tobytes(), "<i4")[ragged(cuts[:-1] // 4, own)] + np.repeat(first[block], own)] = size + np.arange(len(weights))
            places, ends = binary_column(table["places"])
            classes[classes == RARE] = numbers[np.frombuffer(places.tobytes(), "<i4") + np.repeat(first, np.diff(ends) // 4)]
        yield table, classes, off, weights


def train(encoded: DataFrame, model: Model, passes: int = PASSES) -> Model:
    """Baum-Welch over the texts of ``encoded`` (column ``classes``)."""
    spark = encoded.sparkSession
    size = len(model.base)
    for _ in range(passes):
        shared = spark.sparkContext.broadcast((model.start, model.step, model.emit, model.total))

        def expect(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, step, known, total = shared.value
            starts, steps, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, size))
            tokens = np.zeros(STATES)
            names = ["shard", "block", "counts"]
            for table, classes, off, weights in _held(it, size):
                count = np.diff(off)
                emit = np.concatenate((known, weights / total))
                own = np.zeros((STATES, len(emit)))
                for group in chains.groups(count):
                    lay = chains.Layout(off[:-1][group], count[group])
                    seen = classes[lay.source]
                    fit = emit.take(seen, axis=0)
                    alpha, scale = chains.forward(start, step, fit, lay, EVERY)
                    beta, ahead = chains.backward_and_ahead(step, fit, scale, lay)
                    steps += chains.moves(alpha, ahead, step, lay)
                    alpha *= beta
                    starts += alpha[:lay.begin[1]].sum(axis=0)
                    tokens += alpha.sum(axis=0)
                    for s in range(STATES):
                        own[s] += np.bincount(seen, alpha[:, s], len(emit))
                emits += own[:, :size]
                if len(weights):
                    # back to the blocks and shards that the weights came from
                    lists = table["tail"].combine_chunks()
                    part = lists.flatten()
                    blocks = np.repeat(table["block"].to_numpy(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                    cuts = size + binary_column(part.field("weights"))[1] // (4 * STATES)
                    back = np.ascontiguousarray(own.T)
                    yield pa.RecordBatch.from_arrays([part.field("shard"), pa.array(blocks), pa.array(
                        [back[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], names)
            # what is broadcast has shards below 0: classes, then start, step and tokens
            sums = np.concatenate((emits.T, starts[None], steps, tokens[None]))
            cut = [sums[i:i + PIECE].tobytes() for i in range(0, len(sums), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(-1 - np.arange(len(cut)), pa.int32()), pa.nulls(len(cut), pa.int64()), pa.array(cut, pa.binary())], names)

        wanted = ["classes"] + [x for x in ("counts",) if x in encoded.columns] + ["block", "n_other", "places", "tail"] * (model.tail is not None)

        def summed(texts: DataFrame, uses: DataFrame | None) -> DataFrame:
            rows = texts.select(*wanted).mapInArrow(expect, "shard int, block long, counts binary").withColumn("at", F.lit(None).cast("binary"))
            if uses is not None:
                rows = rows.unionByName(uses.select("shard", "block", F.lit(None).cast("binary").alias("counts"), "at"))
            return rows.groupBy("shard").applyInArrow(_add, SUMS)

        parts = materialise_rounds((summed(*x) for x in model.placed(encoded)), "expected")
        # these rows have the size of what is broadcast, which is bounded
        known = parts.filter("shard < 0").toArrow()
        found = np.zeros((size + STATES + 2, STATES))
        for i, k in enumerate(known["shard"].to_pylist()):
            own = _array(known["sums"], i, "<f8").reshape(-1, STATES)
            found[(-1 - k) * PIECE:][:len(own)] += own
        shared.destroy()
        if not known.num_rows:
            break
        model.update(found[size], found[size + 1:-1], found[:size], found[-1],
                     None if model.tail is None else parts.filter("shard >= 0"))
        discard(parts)
        free_shuffles(spark)
    return model


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, as many whole counts as give at most
    ``most`` words: a threshold from the histogram of counts, so that no task
    and not the driver gets more than these words."""
    words = counts.filter((F.col("c") >= LEAST_COUNT) & (F.octet_length("word") <= LONGEST_CLASS))
    # a row for each different count
    down = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = (words.groupBy("c").agg(F.count("*").alias("n")).withColumn("n", F.sum("n").over(down))
             .filter(F.col("n") <= most).agg(F.min("c")).first()[0])
    return words.filter(F.lit(False) if least is None else F.col("c") >= least)


def hidden_markov_scores(df: DataFrame, held_out: F.Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    The model learns from all texts for which ``held_out`` (of the column
    doc_id) is false. Tokens are the text's words, separated by ASCII white
    space and lower-cased (A-Z), and one end. ``base_score`` is the add-one
    unigram log10 probability, ``score`` the model's log10 probability of the
    whole text. Null counts as empty (its only token is the end). Repeated
    rows count, and are scored, each. With nothing to learn from all
    probabilities are those of the prior. Other columns play no part.

    All counts are over all training texts, and every word of LEAST_COUNT
    occurrences has emissions. Those of the CLASSES most frequent words are
    broadcast; emissions and counts of all others are joined.
    """
    spark = df.sparkSession
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("raw")).withColumn("held_out", held_out)
    learn = source.filter("not held_out")
    counts = materialise(learn.select("raw").mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
                         .withColumn("id", F.monotonically_increasing_id()), "words")
    ends = learn.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = frequent_words(counts, CLASSES).orderBy("word").collect()
    modelled = counts.filter(F.col("c") >= LEAST_COUNT).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    model = Model([bytes(r.word) for r in top], [r.c for r in top], ends, total.n + ends, total.v + (ends > 0),
                  tail_n=modelled.n - sum(r.c for r in top), tail_v=modelled.v - len(top))
    lookup = spark.sparkContext.broadcast((model.number, model.logs))

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {**lookup.value[0], b"": END}.get              # no word is empty
        for table in batches(it, BLOCK, "raw"):
            buf, off = binary_column(table["raw"])
            data = buf.tobytes().lower()
            ids, side = table["doc_id"].combine_chunks(), np.array([-1 if x is None else x for x in table["held_out"].to_pylist()])
            for held in (False, True, None):
                rows = np.flatnonzero(side == (-1 if held is None else held))
                if not len(rows):
                    continue
                words: list[bytes] = []
                ends = []
                for a, b in zip(off[rows].tolist(), off[rows + 1].tolist()):
                    words += data[a:b].split()
                    words.append(b"")
                    ends.append(len(words))
                own = np.fromiter(map(get, words, repeat(RARE)), "<u2", len(words))
                others = [words[i] for i in np.flatnonzero(own == RARE).tolist()]
                place = {w: i for i, w in enumerate(dict.fromkeys(others))}
                places = np.fromiter(map(place.__getitem__, others), "<i4", len(others))
                sizes = np.fromiter(map(len, place), "<i4", len(place))
                packed = (own.tobytes(), np.diff(ends, prepend=0).astype("<i4").tobytes(), places.tobytes(), b"".join(place), sizes.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([held], pa.bool_()), pa.ListArray.from_arrays([0, len(rows)], ids.take(pa.array(rows))), *(pa.array([x], pa.binary()) for x in packed),
                     pa.array([len(place)], pa.int64())],
                    ["held_out", "doc_ids", "classes", "counts", "places", "words", "sizes", "n_other"])

    encoded = materialise(source.mapInArrow(
        encode, "held_out boolean, doc_ids array<long>, classes binary, counts binary, places binary, words binary, sizes binary, n_other long")
        .withColumn("block", F.monotonically_increasing_id()), "classes")
    # words that are not broadcast: their counts, looked up once for a block
    shards = 1 + (encoded.agg(F.sum("n_other")).first()[0] or 0) // PAIRS
    counted = counts.withColumn("shard", F.pmod(F.crc32("word"), F.lit(shards)).cast("int"))
    asked = encoded.select("block", "held_out", "words", "sizes").mapInArrow(
        _deal(shards), "shard int, block long, held_out boolean, places binary, words binary, sizes binary")
    links = materialise(asked.groupBy("shard").cogroup(counted.groupBy("shard")).applyInArrow(_look_up(lookup), LINKS), "others")
    if modelled.v > len(top):
        words = counted.filter(F.col("c") >= LEAST_COUNT).join(frequent_words(counts, CLASSES).select("id"), "id", "left_anti")
        model.attach(words, links.filter("not held_out"))
    free_shuffles(spark)
    model = train(encoded.filter("not held_out"), model)
    unit, rare_unit = float(np.log10(model.n + model.v + 1)), float(np.log10(model.rare_n + model.rare_v + 1))
    ended = ends > 0
    shared = spark.sparkContext.broadcast((model.start, model.step, model.emit, model.total))

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, step, known, total = shared.value
        logs = lookup.value[1]
        for table, classes, off, weights in _held(it, len(known)):
            count = np.diff(off)
            emit = np.concatenate((known, weights / total))
            path = np.zeros(len(count))
            for group in chains.groups(count):
                lay = chains.Layout(off[:-1][group], count[group])
                _, scale = chains.forward(start, step, emit.take(classes[lay.source], axis=0), lay, EVERY)
                path[group] = np.bincount(lay.rank, np.log10(scale), len(group))
            # counts of the words that are not broadcast, by place
            n = table["n_other"].to_numpy()
            first = np.cumsum(n) - n
            c = np.zeros(int(n.sum()), np.int64)
            lists = table["tail"].combine_chunks()
            part = lists.flatten()
            block = np.repeat(np.arange(len(n)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            places, cuts = binary_column(part.field("places"))
            c[np.frombuffer(places.tobytes(), "<i4") + np.repeat(first[block], np.diff(cuts) // 4)] = np.frombuffer(binary_column(part.field("c"))[0].tobytes(), "<i8")
            own = np.frombuffer(binary_column(table["classes"])[0].tobytes(), "<u2")
            places, cuts = binary_column(table["places"])
            places = np.frombuffer(places.tobytes(), "<i4") + np.repeat(first, np.diff(cuts) // 4)
            token_logs, met = logs[own], np.where(own == END, ended, True)
            other = own == RARE
            token_logs[other], met[other] = np.log10(c + 1.0)[places], c[places] > 0
            add = lambda x: np.add.reduceat(x, off[:-1]) if len(count) else x[:0]     # each text has a token
            rare = classes == RARE
            texts = table["doc_ids"].combine_chunks()
            row = np.repeat(np.arange(len(n)), texts.value_lengths().to_numpy())
            yield from pa.Table.from_arrays(
                [texts.flatten(), table["held_out"].combine_chunks().take(pa.array(row)),
                 pa.array(count, pa.int64()), pa.array(add(met.astype(np.int64))), pa.array(add(token_logs) - count * unit),
                 pa.array(path + add(np.where(rare, token_logs, 0.0)) - add(rare.astype(np.int64)) * rare_unit)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]).to_batches()

    wanted = ["block", "held_out", "doc_ids", "classes", "counts", "n_other", "places", "tail"]
    scored = materialise_rounds((x.select(*wanted).mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        for x, _ in model.placed(encoded, links)), "scored")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def q_hidden_markov(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return hidden_markov_scores(docs, held_out)
