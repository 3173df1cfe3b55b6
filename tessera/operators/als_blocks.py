"""Explicit ALS for ratings that MLlib's blocks cannot hold.

MLlib deals users and items to a fixed number of blocks, builds each block of
ratings in one task's heap, and keeps the exchanged factors of all half
iterations on disk until the fit ends. Here ratings are packed once a side
into pieces of ``PIECE`` ratings, which a task reads one after another, and
the factors of a half iteration are freed as soon as the next one has used
them.

The steps and equations are MLlib's: first factors of users on the unit
sphere, then items and users in turn, each by (Σ v vᵀ + λ n I) x = Σ r v in
double precision, factors kept as floats. An id's first factors hang on the
seed and the id alone, and its sums run in the order of its partners, so a fit
does not depend on the number of blocks or the layout of the input.

A block is a task of each half iteration: the ids of a side whose hash falls
to it. A factor is sent once to each block with a rating of it. A task keeps
the partners' factors of its block in a file beside Spark's own if they are
many; it holds their ids, one piece and its factors. The ratings of an id of
more than ``PIECE`` come in several pieces, whose sums are added up.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 19             # ratings that are solved at once
SORTED = 1 << 21            # ratings that are sorted by one task
BLOCK = 40_000_000          # ratings of a block, by which there are more blocks than cores
HELD = 32 << 20             # bytes of partners' factors that a task keeps in memory, not in a file
MIX = 0x45D9F3B             # of the hash that deals ids to blocks; under 2^31, as SQL has signed products


def hashed(c: Column) -> Column:
    """The hash of an int id, 0 to 2^32 - 1, as ``_kernels`` has it."""
    mask = F.lit(0xFFFFFFFF)
    x = c.cast("long").bitwiseAND(mask)
    for _ in range(2):
        x = (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(MIX)).bitwiseAND(mask)
    return x.bitwiseXOR(F.shiftright(x, 16))


def _kernels(rank: int, reg: float, seed: int, blocks: int) -> tuple[Callable, Callable, Callable]:
    """What the tasks run: ``pack``, ``half`` and ``first``. They are made
    here so that workers need no import of this package."""
    ids_at_once, rows_at_once, window = 1 << 13, 1 << 15, 1 << 16
    piece_size, held_size, mix = PIECE, HELD, MIX
    i4, f4 = np.dtype("<i4"), np.dtype("<f4")
    schema = pa.schema([("block", pa.int32()), ("part", pa.bool_()),
                        *((n, pa.binary()) for n in ("ids", "counts", "partners", "places", "ratings"))])

    def block_of(ids: np.ndarray) -> np.ndarray:
        x = ids.astype(np.uint32)
        for _ in range(2):
            x = (x ^ (x >> np.uint32(16))) * np.uint32(mix)
        return ((x ^ (x >> np.uint32(16))) % np.uint32(blocks)).astype(np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows (id and partner in one number, rating) to pieces. The ids of a piece are sorted by their
        number of ratings: those of equal numbers are solved together."""
        held, size, cut = [], 0, None           # cut: an id of which a piece is out already

        def piece(ids: np.ndarray, partners: np.ndarray, ratings: np.ndarray, part: bool) -> Iterator[pa.RecordBatch]:
            own, start, count = np.unique(ids, return_index=True, return_counts=True)
            block = block_of(own)
            for b in np.unique(block):
                at = np.flatnonzero(block == b)
                at = at[np.argsort(count[at], kind="stable")]
                n = count[at]
                rows = np.repeat(start[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                known, places = np.unique(partners[rows], return_inverse=True)
                yield pa.RecordBatch.from_pylist([{
                    "block": int(b), "part": part, "ids": own[at].astype(i4).tobytes(), "counts": n.astype(i4).tobytes(),
                    "partners": known.astype(i4).tobytes(), "places": places.astype(i4).tobytes(),
                    "ratings": ratings[rows].astype(f4).tobytes()}], schema=schema)

        def pieces(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, cut
            ids, partners, ratings = (np.concatenate(x) for x in zip(*held))
            begin = 0 if cut is None else int(np.searchsorted(ids, cut, "right"))
            end = len(ids) if last else max(begin, int(np.searchsorted(ids, ids[-1])))
            if begin:
                yield from piece(ids[:begin], partners[:begin], ratings[:begin], True)
            if end > begin:
                yield from piece(ids[begin:end], partners[begin:end], ratings[begin:end], False)
            if len(ids) - end >= piece_size:
                yield from piece(ids[end:], partners[end:], ratings[end:], True)
                cut, end = ids[-1], len(ids)
            held = [(ids[end:].copy(), partners[end:].copy(), ratings[end:].copy())]
            size = len(ids) - end

        for batch in batches:
            if batch.num_rows:
                key, rating = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                held.append(((key >> 32).astype(i4), (key & 0xFFFFFFFF).astype(np.uint32).view(i4), rating))
                size += batch.num_rows
            if size >= piece_size:
                yield from pieces(False)
        if size:
            yield from pieces(True)

    def first(ids: np.ndarray) -> np.ndarray:
        """First factors: normal numbers by hash of seed, id and axis, scaled
        to length 1."""
        out = np.empty((len(ids), rank), f4)
        for i in range(0, len(ids), ids_at_once):
            out[i:i + ids_at_once] = drawn(ids[i:i + ids_at_once])
        return out

    def drawn(ids: np.ndarray) -> np.ndarray:
        def uniform(salt: int) -> np.ndarray:
            x = (ids.astype(np.int64).view(np.uint64)[:, None] * np.uint64(2 * rank) + np.arange(rank, dtype=np.uint64) + np.uint64(salt * rank))
            x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % 2**64)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53

        x = np.sqrt(-2 * np.log1p(-uniform(0))) * np.cos(2 * np.pi * uniform(1))
        size = np.sqrt((x * x).sum(1, keepdims=True))
        return x / np.where(size > 0, size, 1)

    def store() -> tuple[Callable, Callable]:
        """Factors of the partners of a block: ``add`` them, then ``look`` up
        those of some ids."""
        ids, at, order, held = [], None, None, None
        top = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=top if os.path.isdir(top) else None, buffering=0)

        def add(own: bytes, x: bytes) -> None:
            if at is not None:
                raise RuntimeError("factors come after ratings")
            ids.append(np.frombuffer(own, i4))
            rest = memoryview(x)
            while rest:
                rest = rest[file.write(rest):]

        def look(wanted: np.ndarray) -> np.ndarray:
            nonlocal ids, at, order, held
            if at is None:
                ids = np.concatenate(ids or [np.empty(0, i4)])
                order = np.argsort(ids).astype(i4)
                at = ids[order]
                n, ids = len(ids), []
                if n * rank * 4 <= held_size:
                    held = np.frombuffer(os.pread(file.fileno(), n * rank * 4, 0), f4).reshape(-1, rank).take(order, 0)
            place = np.searchsorted(at, wanted)
            if len(wanted) and (place[-1] >= len(at) or (at.take(place) != wanted).any()):
                raise RuntimeError("the ratings of users and of items differ: they were not the same when read again")
            if held is not None:
                return held.take(place, 0)
            rows = order.take(place)
            out, by = np.empty((len(rows), rank), f4), np.argsort(rows)
            rows = rows.take(by)
            edges = np.searchsorted(rows, np.arange(0, len(at) + window, window))
            for w, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a < b:
                    part = np.frombuffer(os.pread(file.fileno(), window * rank * 4, w * window * rank * 4), f4).reshape(-1, rank)
                    out[by[a:b]] = part.take(rows[a:b] - w * window, 0)
            return out

        return add, look

    def solve(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        a = sums[:, :rank, :rank].copy()
        a[:, range(rank), range(rank)] += reg * counts[:, None]
        b = sums[:, :rank, rank:]
        # without a penalty few ratings leave a system of lower rank
        return (np.linalg.solve(a, b) if reg > 0 else np.linalg.pinv(a, hermitian=True) @ b)[:, :, 0].astype(f4)

    def half(rows: Iterator, start: bool, send: bool, keep: bool) -> Iterator:
        """One block of a half iteration: the partners' factors, then the
        pieces. ``start``: the partners have their first factors; ``send``:
        factors go to the blocks with ratings of them, ``keep``: also to the
        table of factors."""
        add, look = store()
        parts: dict[int, list] = {}

        def out(ids: np.ndarray, x: np.ndarray, need: np.ndarray, to: dict) -> None:
            for b in np.flatnonzero(need.any(0)) if send else ():
                w = need[:, b]
                to[int(b)].append((ids[w], x[w]))
            if keep:
                to[None].append((ids, x))

        def sent(to: dict, block: int) -> Iterator:
            for b, found in to.items():
                ids, x = (np.concatenate(v) for v in zip(*found))
                yield (block, (ids.tobytes(), x.tobytes(), True)) if b is None else (b, (ids.tobytes(), x.tobytes()))

        block, space = 0, np.empty((rows_at_once, rank + 1))
        for block, row in rows:
            if len(row) < 6:
                if len(row) == 2:
                    add(*row)
                continue
            part, ids, counts, partners, places, ratings = row[0], *(np.frombuffer(v, t) for v, t in zip(row[1:], (i4, i4, i4, i4, f4)))
            v = first(partners) if start else look(partners)
            target = block_of(partners)
            ends, i, to = np.cumsum(counts, dtype=np.int64), 0, defaultdict(list)
            while i < len(ids):
                s = int(ends[i] - counts[i])
                j = max(i + 1, min(i + ids_at_once, int(np.searchsorted(ends, s + rows_at_once, "right"))))
                e, n = int(ends[j - 1]), counts[i:j]
                sums = np.zeros((j - i, rank + 1, rank + 1))
                for s_ in range(s, e, rows_at_once):            # more than once if one id fills more
                    e_ = min(e, s_ + rows_at_once)
                    x = space[:e_ - s_]
                    x[:, :rank] = v.take(places[s_:e_], 0)
                    x[:, rank] = ratings[s_:e_]
                    edges = [0, *(np.flatnonzero(np.diff(n)) + 1), j - i]
                    for a, b in zip(edges[:-1], edges[1:]):
                        f = int(ends[i + a] - n[a]) - s
                        y = x[None] if j == i + 1 else x[f:f + (b - a) * int(n[a])].reshape(b - a, int(n[a]), rank + 1)
                        sums[a:b] += np.matmul(y.transpose(0, 2, 1), y)
                need = np.zeros((j - i, blocks), bool)
                need[np.repeat(np.arange(j - i), n), target.take(places[s:e])] = True
                if part:
                    parts.setdefault(int(ids[0]), []).append((int(n[0]), sums[0], need[0]))
                else:
                    out(ids[i:j], solve(sums, n), need, to)
                i = j
            yield from sent(to, block)
        for k, found in parts.items():
            to, n = defaultdict(list), np.array([sum(f[0] for f in found)])
            out(np.array([k], i4), solve(sum(f[1] for f in found)[None], n), np.any([f[2] for f in found], axis=0)[None], to)
            yield from sent(to, block)

    return pack, half, first


def _shuffles(rdd: RDD, above: bool = False) -> list[int]:
    """The shuffle that ``rdd`` reads, or those last before it."""
    todo, found = [(rdd._jrdd.rdd(), 0)], []
    while todo:
        at, depth = todo.pop()
        deps = at.dependencies()
        for dep in (deps.apply(k) for k in range(deps.size())):
            mine = dep.getClass().getSimpleName() == "ShuffleDependency"
            if mine and bool(depth) == above:
                found.append(dep.shuffleId())
            if not mine or (above and not depth):
                todo.append((dep.rdd(), depth + mine))
    return found


def _free(sc: SparkContext, shuffles: list[int]) -> None:
    """Remove shuffle files that nothing reads again. A lost executor's part
    is made again from the ratings."""
    cleaner = sc._jsc.sc().cleaner()
    for k in shuffles if cleaner.isDefined() else ():
        cleaner.get().doCleanupShuffle(k, False)


def fit(ratings: DataFrame, count: int, rank: int, max_iter: int, reg: float, seed: int, checkpoint_interval: int,
        stored: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """User and item factors (``id int, features array<float>``) of ``count``
    rows ``user int, item int, rating float`` without nulls. ``stored`` writes
    a table to the shared folder and reads it back. The ratings are read once
    for each side and must be the same rows both times. Factors sent after
    every ``checkpoint_interval`` iterations are checkpointed, so that a lost
    executor does not replay the iterations before."""
    spark = ratings.sparkSession
    sc = spark.sparkContext
    blocks = max(sc.defaultParallelism, -(-count // BLOCK))
    sorts = blocks * -(-count // (blocks * SORTED))
    pack, half, _ = _kernels(rank, reg, seed, blocks)
    place = lambda block: block

    def packed(side: str, partner: str) -> RDD:
        # one number, as Spark sorts those without comparing rows
        key = F.shiftleft(F.col(side).cast("long"), 32).bitwiseOR(F.col(partner).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        rows = (ratings.select(key.alias("key"), "rating")
                .repartitionById(sorts, (hashed(F.shiftright("key", 32)) % sorts).cast("int"))
                .sortWithinPartitions("key")
                .mapInArrow(pack, "block int, part boolean, ids binary, counts binary, partners binary, places binary, ratings binary"))
        out = rows.rdd.map(lambda r: (r[0], tuple(r[1:]))).partitionBy(blocks, place)
        out._jrdd.isEmpty()     # runs the shuffle, reads one batch of it
        _free(sc, _shuffles(out, above=True))
        return out

    def solved(pieces: RDD, factors: RDD | None, send: bool, keep: bool) -> RDD:
        start = factors is None
        rows = pieces if start else factors.union(pieces)
        out = rows.mapPartitions(lambda it: half(it, start, send, keep))
        return out.partitionBy(blocks, place) if send else out

    def table(rows: RDD, name: str) -> DataFrame:
        i4, f4 = np.dtype("<i4"), np.dtype("<f4")
        fields = pa.schema([("id", pa.int32()), ("features", pa.list_(pa.float32()))])

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for own, x in zip(*(c.to_pylist() for c in batch.columns)):
                    ids, x = np.frombuffer(own, i4), np.frombuffer(x, f4)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) + 1, rank, dtype=i4)), pa.array(x))
                    yield pa.RecordBatch.from_arrays([pa.array(ids), lists], schema=fields)

        packed_ = spark.createDataFrame(rows.filter(lambda r: len(r[1]) == 3).map(lambda r: r[1][:2]),
                                        "ids binary, x binary", verifySchema=False)
        return stored(packed_.mapInArrow(unpack, "id int, features array<float>"), name)

    users, items = packed("user", "item"), packed("item", "user")
    to_items, old = None, []        # old: the shuffle of the factors that the last half iteration has read
    for k in range(max_iter):
        last = k == max_iter - 1
        to_users = solved(items, to_items, True, last)
        to_users._jrdd.isEmpty()
        _free(sc, old)
        old = _shuffles(to_users)
        to_items = solved(users, to_users, not last, last)
        if last:
            item_table, user_table = table(to_users, "item-factors"), table(to_items, "user-factors")
            break
        mine, cut = _shuffles(to_items), checkpoint_interval > 0 and (k + 1) % checkpoint_interval == 0
        if cut:
            to_items.checkpoint()
        to_items._jrdd.isEmpty()
        _free(sc, old + mine if cut else old)
        old = [] if cut else mine
    _free(sc, old + _shuffles(users) + _shuffles(items))
    return user_table, item_table
