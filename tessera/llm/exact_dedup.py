"""Operator 4: exact duplicates by an extendible-hash index on shared files.

The 64-bit hash of a text is its key. Owner tasks hold key ranges (the top
bits of the key). A task gets its range sorted by key, compares bytes along
the chain of texts with one key, and files each distinct text in an
extendible hash: a directory over the next bits of the key points to buckets
of bounded size; an overfull bucket is split, and the directory doubles when
the split needs one bit more. The buckets are written to the shared folder.
Documents are looked up there: each owner task loads its buckets, builds its
directory from their depths and probes it by the bits of the keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, materialise, numbered, text_bytes

HOT = 1000                  # a text with over 1/HOT of the rows is hot
BUCKET = 256                # entries a bucket holds before it is split
OWNER_ROWS = 100_000        # an owner task's share of the rows, about
OWNER_BYTES = 64 << 20      # and of the bytes


class Directory:
    """Extendible hashing over the top bits of ``bits``-bit keys."""

    def __init__(self, bits: int, capacity: int = BUCKET):
        self.bits, self.capacity, self.depth = bits, capacity, 0
        # a bucket: [local depth, entries]; entries are (key, value)
        self.slots: list[list] = [[0, []]]

    def insert(self, key: int, value) -> None:
        while True:
            bucket = self.slots[key >> (self.bits - self.depth) if self.depth else 0]
            local, entries = bucket
            # keys that are all alike cannot be split: they stay as one chain
            if len(entries) < self.capacity or local == self.bits or all(k == key for k, _ in entries):
                entries.append((key, value))
                return
            if local == self.depth:                      # directory doubling
                self.slots = [b for b in self.slots for _ in (0, 1)]
                self.depth += 1
            shift = self.bits - local - 1
            halves = [[local + 1, []], [local + 1, []]]
            for k, v in entries:
                halves[(k >> shift) & 1][1].append((k, v))
            run = 1 << (self.depth - local)              # slots that point to the bucket
            first = (key >> (self.bits - self.depth)) // run * run
            for i in range(run):
                self.slots[first + i] = halves[i >= run // 2]

    @classmethod
    def load(cls, bits: int, rows: Iterator[tuple[int, int, int, object]]) -> Directory:
        """From stored rows (bucket, depth, key, value) of one owner."""
        held: dict[tuple[int, int], list] = {}
        for number, depth, key, value in rows:
            held.setdefault((number, depth), []).append((key, value))
        own = cls(bits)
        own.depth = max((d for _, d in held), default=0)
        own.slots = [[own.depth, []] for _ in range(1 << own.depth)]
        for (number, depth), entries in held.items():
            bucket, run = [depth, entries], 1 << (own.depth - depth)
            own.slots[number * run:(number + 1) * run] = [bucket] * run
        return own

    def find(self, key: int) -> Iterator:
        """The values filed under a key, along its chain."""
        entries = self.slots[key >> (self.bits - self.depth) if self.depth else 0][1]
        return (value for k, value in entries if k == key)

    def buckets(self) -> Iterator[tuple[int, int, list]]:
        """(first slot's number, local depth, entries) of each bucket."""
        last = None
        for i, b in enumerate(self.slots):
            if b is not last:
                yield i >> (self.depth - b[0]), b[0], b[1]
            last = b


def _owner(bits: int) -> F.Column:
    return F.shiftrightunsigned("key", 64 - bits).cast("int")


def _by_owner(df: DataFrame, bits: int) -> DataFrame:
    """Rows dealt to tasks by runs of neighbouring owners, so that no two runs
    meet in a task while others stay idle. There are as many tasks as the
    session's shuffles have, or as owners if these are fewer."""
    tasks = min(1 << bits, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1))
    return df.repartitionById(tasks, F.floor(F.col("owner").cast("long") * tasks / (1 << bits)).cast("int"))


def build_index(df: DataFrame, doc_id: str = "doc_id", text: str = "text", owner_bits: int | None = None) -> DataFrame:
    """One row for each distinct text, from the files of the index.

    Columns: owner, bucket, depth (the bucket's place below its owner),
    key, chain (place among the texts with this key), n_bytes, text_sha256,
    keep_id (largest id; null only if all are) and group_size.

    Copies are combined in each map task before the exchange, so a hot text
    costs an owner at most a row for each batch of the input. Texts are moved
    once and compared byte by byte; an owner task holds one chain of texts
    and the fixed-size entries of its range.
    """
    raw = text_bytes(text)
    texts = df.select(F.col(doc_id).cast("long").alias("id"), raw.alias("raw"), F.xxhash64(raw).alias("key"))
    owner_bits = choose_owners(df, text) if owner_bits is None else owner_bits

    def combine(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(it, 16 << 20, "raw"):
            found: dict[bytes, list] = {}
            for i, t, k in zip(*(table[c].to_pylist() for c in ("id", "raw", "key"))):
                entry = found.get(t)
                if entry is None:
                    found[t] = [k, i, 1]
                else:
                    entry[2] += 1
                    if i is not None and (entry[1] is None or i > entry[1]):
                        entry[1] = i
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), *(pa.array([x[j] for x in found.values()], pa.int64()) for j in range(3))],
                ["raw", "key", "id", "n"])

    combined = texts.mapInArrow(combine, "raw binary, key long, id long, n long")
    owned = _by_owner(combined.withColumn("owner", _owner(owner_bits)), owner_bits).sortWithinPartitions("owner", "key")
    mask = (1 << (64 - owner_bits)) - 1

    def own(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = key = None
        chain: list[list] = []
        index = Directory(64 - owner_bits, BUCKET)

        def file_chain() -> None:
            for place, (raw, i, n) in enumerate(chain):
                index.insert(key & mask, (key, place, len(raw), hashlib.sha256(raw).hexdigest(), i, n))

        def files() -> pa.RecordBatch:
            rows = [(owner, no, depth, *v) for no, depth, entries in index.buckets() for _, v in entries]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

        for batch in it:
            for o, k, i, n, raw in zip(*(batch.column(c).to_pylist() for c in ("owner", "key", "id", "n", "raw"))):
                if (o, k) != (owner, key):
                    if chain:
                        file_chain()
                    if o != owner:
                        if owner is not None:
                            yield files()
                        index = Directory(64 - owner_bits)
                    owner, key, chain = o, k, []
                for entry in chain:                      # compare bytes along the chain
                    if entry[0] == raw:
                        entry[2] += n
                        if i is not None and (entry[1] is None or i > entry[1]):
                            entry[1] = i
                        break
                else:
                    chain.append([raw, i, n])
        if owner is not None:
            file_chain()
            yield files()

    schema = pa.schema([("owner", pa.int32()), ("bucket", pa.int64()), ("depth", pa.int32()), ("key", pa.int64()),
                        ("chain", pa.int32()), ("n_bytes", pa.int64()), ("text_sha256", pa.string()),
                        ("keep_id", pa.int64()), ("group_size", pa.int64())])
    return materialise(owned.mapInArrow(
        own, "owner int, bucket long, depth int, key long, chain int, n_bytes long, text_sha256 string, keep_id long, group_size long"),
        "hash-index")


def choose_owners(df: DataFrame, text: str = "text") -> int:
    """Bits of the key that name an owner: enough that an owner has about
    OWNER_ROWS rows and OWNER_BYTES bytes of texts."""
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(text_bytes(text))), F.lit(0)).alias("b")).first()
    return max(8, (max(size.n // OWNER_ROWS, size.b // OWNER_BYTES)).bit_length() + 2)


def probe(index: DataFrame, rows: DataFrame, owner_bits: int) -> DataFrame:
    """Looks ``rows`` (key, text_sha256, _row, doc_id) up in a stored index:
    adds keep_id and group_size. An owner task reads its buckets, then its
    rows; it holds one owner's directory at a time."""
    entries = index.select("owner", F.lit(0).alias("kind"), "key", "text_sha256", "bucket", "depth", "keep_id", "group_size",
                           F.lit(None).cast("long").alias("_row"), F.lit(None).cast("long").alias("doc_id"))
    asked = rows.select(_owner(owner_bits).alias("owner"), F.lit(1).alias("kind"), "key", "text_sha256",
                        F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("int").alias("depth"),
                        F.lit(None).cast("long").alias("keep_id"), F.lit(None).cast("long").alias("group_size"), "_row", "doc_id")
    both = _by_owner(entries.unionByName(asked), owner_bits).sortWithinPartitions("owner", "kind")
    mask = (1 << (64 - owner_bits)) - 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, filed, index = None, [], Directory(64 - owner_bits)
        for batch in it:
            out: list[tuple] = []
            for o, kind, key, sha, bucket, depth, keep, n, row, doc in zip(*(c.to_pylist() for c in batch.columns)):
                if o != owner:
                    owner, filed, index = o, [], None
                if kind == 0:
                    filed.append((bucket, depth, key & mask, (sha, keep, n)))
                    continue
                if index is None:
                    index, filed = Directory.load(64 - owner_bits, iter(filed)), []
                keep, n = next((k, n) for s, k, n in index.find(key & mask) if s == sha)
                out.append((row, doc, key, sha, keep, n))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    schema = pa.schema([("_row", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("text_sha256", pa.string()),
                        ("keep_id", pa.int64()), ("group_size", pa.int64())])
    return both.mapInArrow(run, "_row long, doc_id long, key long, text_sha256 string, keep_id long, group_size long")


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row for each row of ``df``: doc_id, keep_id, group_size, kept, text_sha256
    (and ``row``, if ``df`` has a column of row numbers of that name).

    Equal texts form a group (null counts as empty, nothing is normalised).
    The row with the largest id stays; a null id is smaller than any other.
    Of rows that repeat this id and text exactly one is marked kept. Empty
    input gives no rows; other columns play no part.
    """
    raw = text_bytes(text)
    owner_bits = choose_owners(df, text)
    index = build_index(df, doc_id, text, owner_bits)
    rows = materialise(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(raw).alias("key"),
                                 F.sha2(raw, 256).alias("text_sha256"),
                                 (F.col(row) if row else F.monotonically_increasing_id()).alias("_row")), "hash-rows")
    # fewer than HOT texts have over 1/HOT of the rows each: their groups are
    # broadcast, so that no owner gets their rows; all others are looked up
    n = rows.count()
    hot = materialise(index.filter(F.col("group_size") * HOT > n).select("key", "text_sha256", "keep_id", "group_size"), "hash-hot")
    others = rows.join(F.broadcast(hot.select("key", "text_sha256")), ["key", "text_sha256"], "left_anti")
    found = materialise(rows.join(F.broadcast(hot), ["key", "text_sha256"]).unionByName(probe(index, others, owner_bits)), "hash-found")
    heads = (found.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy("key", "text_sha256").agg(F.min("_row").alias("_row")).select("_row", F.lit(True).alias("kept")))
    return found.join(heads, "_row", "left").select(
        "doc_id", "keep_id", "group_size", F.coalesce("kept", F.lit(False)).alias("kept"), "text_sha256",
        *([F.col("_row").alias(row)] if row else []))


def drop_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without the rows that ``exact_groups`` does not keep, all columns.

    Of equal texts (null counts as empty) one row stays: the one with the
    largest id, null ids being smaller than any; of rows that repeat that id
    too, one. Rows are told apart by number, so repeated and null ids and any
    other column names do no harm. An empty table stays empty.
    """
    rows, row = numbered(df, "exact-rows")
    gone = exact_groups(rows, doc_id, text, row).filter("not kept").select(row)
    return rows.join(gone, row, "left_anti").drop(row)


def q_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL_EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)"""
