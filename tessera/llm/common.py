"""Helpers the training-data operators share.

Texts are handled as UTF-8 bytes; numpy works on whole Arrow batches inside
tasks, Spark deals the batches out and moves them.
"""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# word bytes of the tokenisations used here
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) | _U(1)
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2 ** 64)
_CHUNK = 1 << 20
_LONG_WORD = 1 << 16


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage is cut and a lost executor loses nothing."""
    path = scratch(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Remove the shuffle files of steps that are written: Spark keeps them
    until the driver drops the plans that made them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialise_rounds(rounds: Iterable[DataFrame], tag: str) -> DataFrame:
    """As ``materialise``, of tables of one schema that are made and written
    one after another, so that the shuffles of only one are on disk at a time."""
    path = None
    for df in rounds:
        path = path or scratch(df.sparkSession, tag)
        df.write.mode("append").option("compression", "zstd").parquet(path)
        spark, schema = df.sparkSession, df.schema
        del df
        free_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table of ``materialise`` that nothing reads any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)


def numbered(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` written with a number for each row, and the number's column,
    whose name no column of ``df`` has. Decisions that go back by this number
    meet the row they were made for, whatever its id."""
    name = "_row"
    while name in df.columns:
        name += "_"
    return materialise(df.withColumn(name, F.monotonically_increasing_id()), tag), name


def text_bytes(col: str = "text") -> F.Column:
    """The whole text in UTF-8; null counts as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def packed(df: DataFrame, cols: list[str], raw: str, most_bytes: int, most_rows: int, tag: str) -> DataFrame:
    """The rows of a query table in blocks of about ``most_bytes`` of ``raw``
    and ``most_rows`` rows at most (a longer row makes its block longer):
    block, rows (array of ``cols``). Rows are dealt by number, so the blocks
    do not depend on how many partitions there are."""
    rows = materialise(df.select(*cols).withColumn("row", F.monotonically_increasing_id()), tag)
    size = rows.agg(F.coalesce(F.sum(F.octet_length(raw)), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    parts = max(1, -(-size.b // most_bytes), -(-size.n // most_rows))
    blocks = rows.groupBy(F.pmod(F.xxhash64("row"), F.lit(parts)).alias("block"))
    return blocks.agg(F.collect_list(F.struct(*cols)).alias("rows"))


def binary_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary Arrow column without nulls → (bytes, offsets), not copied."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes in ``table``) of each text.

    Returns their starts and ends in ``buf`` and ``first``: text ``i`` has
    words ``first[i]`` to ``first[i + 1]``. No word crosses two texts.
    """
    inside = table[buf]
    edge = np.empty(len(buf) + 1, bool)
    if len(buf) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge[0], edge[-1] = True, True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    keep = inside[cuts[:-1]]
    starts, ends = cuts[:-1][keep], cuts[1:][keep]
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher on uint64 (all bits depend on all bits)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: list[np.ndarray] = []


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every task."""
    if not _TABLES:
        _TABLES.extend((_powers(_P, _CHUNK + _LONG_WORD + 1), _powers(_P_INV, _CHUNK + _LONG_WORD + 1)))
    up, down = _TABLES
    out = np.zeros(len(starts), np.uint64)
    size = ends - starts
    long = np.flatnonzero(size > _LONG_WORD)
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(int(np.searchsorted(starts, lo + _CHUNK)), at + 1)
        hi = min(int(ends[to - 1]), lo + _CHUNK + _LONG_WORD)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[buf[lo:hi]] * up[:hi - lo], out=sums[1:])
        a, b = starts[at:to] - lo, np.minimum(ends[at:to], hi) - lo
        out[at:to] = (sums[b] - sums[a]) * down[a]
        at = to
    if len(long):
        import hashlib
        for i in long:
            out[i] = int.from_bytes(hashlib.blake2b(buf[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(out + size.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def hash_windows(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of every ``n`` consecutive word hashes (len(h) - n + 1 of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    q = _powers(_P + 2 * seed, n)
    base = mix(h + _U(seed)) if seed else h
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out += base[k:k + m] * q[k]
    return mix(out)


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, … (count[0] of them), then first[1], …"""
    total = int(count.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(first - (ends - count), count)


def batches(it: Iterator[pa.RecordBatch], max_bytes: int, col: str = "text",
            max_rows: int = 100_000) -> Iterator[pa.Table]:
    """Regroup Arrow batches to about ``max_bytes`` of ``col`` each, so that
    memory depends neither on the batch size nor on the longest run of long
    texts (a single longer text is a batch of its own)."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for b in it:
        i = b.schema.get_field_index(col)
        off = binary_column(b.column(i))[1]
        at = 0
        while at < b.num_rows:
            room = max_bytes - size
            to = int(np.searchsorted(off, off[at] + room, side="right")) - 1
            to = min(max(to, at + (not held)), b.num_rows, at + max_rows - rows)
            if to > at:
                held.append(b.slice(at, to - at))
                size += int(off[to] - off[at])
                rows += to - at
                at = to
            if at < b.num_rows or size >= max_bytes or rows >= max_rows:
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def join_with_hot(rows: DataFrame, groups: DataFrame, keys: list[str], size: str,
                  share: int = 1000, n: int | None = None) -> DataFrame:
    """``rows`` left-joined with ``groups`` (unique on ``keys``), safe for hot keys.

    A group of more than 1/``share`` of all rows is hot; there can be fewer
    than ``share`` of those, whatever the input, so they are broadcast and
    their rows never meet in one task. The other groups join by a shuffle in
    which no key has more than 1/``share`` of the rows. ``n`` is the number
    of rows (counted if not given). Both inputs are read twice: pass tables
    that are cheap to read. Keys are not null.
    """
    n = rows.count() if n is None else n
    hot = groups.filter(F.col(size) * share > n)
    cold = groups.filter(F.col(size) * share <= n)
    with_hot = rows.join(F.broadcast(hot), keys, "inner")
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return with_hot.unionByName(rest.join(cold, keys, "left"))


def lockstep(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order in which many sequences can be walked together.

    Sequences sorted by length, longest first; ``active[t]`` of them have a
    step ``t``. A recursion over all of them is then one numpy call a step.
    """
    order = np.argsort(-count, kind="stable")
    longest = int(count[order[0]]) if len(order) else 0
    per = np.bincount(count, minlength=longest + 1)
    active = len(count) - np.cumsum(per)[:longest] if longest else np.zeros(0, np.int64)
    return order, active
