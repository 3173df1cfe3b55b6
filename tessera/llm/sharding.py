"""Operator 3: sharding along a Hilbert curve over several metadata columns.

Each dimension is quantised into cells of about equal row counts, the cells'
place on the Hilbert curve orders the rows, and the order is cut into runs.
Rows that are near in all dimensions lie in the same few runs, so the files'
minima and maxima prune filters on any of the dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import with_rank
from .common import join_with_hot, materialise, scratch, text_bytes


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Place of each cell on the Hilbert curve over ``len(cells)`` axes of
    ``2 ** bits`` cells, at most 62 bits in all: the coordinates' rotations
    are undone axis by axis from the highest bit, then Gray-coded and
    interleaved."""
    x = [c.astype(np.int64) for c in cells]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(up, p, swap)
            if i:
                x[i] ^= swap
            else:
                x[0] ^= swap  # an axis swapped with itself stays
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x = [v ^ turn for v in x]
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for v in x:
            out = (out << 1) | ((v >> level) & 1)
    return out


def _coded(df: DataFrame, dims: list[str], names: list[str]) -> DataFrame:
    """Adds each dimension as a number in the column's own order (null stays
    null): strings and binaries by the rank of their distinct values, dates and
    times by their seconds, all else by value. Values that many rows share are
    broadcast, the others joined (``join_with_hot``)."""
    kinds = {f.name: f.dataType for f in df.schema}
    n = None
    for d, name in zip(dims, names):
        if isinstance(kinds[d], (T.DateType, T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn(name, F.col(d).cast("timestamp").cast("double"))
        elif not isinstance(kinds[d], (T.StringType, T.BinaryType)):
            df = df.withColumn(name, F.col(d).cast("double"))
        else:
            n = df.count() if n is None else n
            value, null = F.col(d).cast("binary"), F.col(d).isNull()
            df = df.withColumn("_curve_key", F.when(null, F.lit(b"")).otherwise(F.concat(F.lit(b"="), value)))
            values = with_rank(df.groupBy("_curve_key").agg(F.count("*").alias("_curve_size")), [F.asc("_curve_key")], "_curve_rank")
            values = values.select("_curve_key", "_curve_size", F.when(
                F.octet_length("_curve_key") > 0, F.col("_curve_rank").cast("double")).alias(name))
            df = join_with_hot(df, values, ["_curve_key"], "_curve_size", n=n).drop("_curve_key", "_curve_size")
    return df


def hilbert_shards(df: DataFrame, dims: list[str], n_shards: int = 8, law: str = "rows",
                   size: str | None = None, tie: tuple[str, ...] = (), bits: int | None = None) -> DataFrame:
    """Adds ``curve`` (place on the curve), ``shard`` (0 to n_shards - 1),
    ``slot`` (gapless from 0 in each shard) and ``law`` to every row.

    ``rows``: counts of any two shards are at most one apart. ``bytes``: the
    curve is cut where the running sum of ``size`` passes each share of the
    total, so no shard is off by more than one row's size. ``dims`` may be
    numbers, booleans, strings, binaries, dates or times; each distinct string
    has a code of its own, in order; null is a cell of its own, the lowest. Equal
    places are ordered by the columns ``tie``; rows equal in these as well
    (repeated rows) get neighbouring slots in any order. An empty table gives
    an empty result. Columns already named like an output are replaced; names
    that begin with ``_curve_`` are reserved.

    Quantiles come from one sketch aggregation over all rows (bounded
    buffers), the order from one range exchange on (curve, tie), which cuts a
    hot cell by the tie columns; positions are offsets of one row for each
    partition plus the place in it. The sorted rows are written to the shared
    folder once, so that the places stay when executors are lost.
    """
    if law not in ("rows", "bytes") or (law == "bytes" and size is None):
        raise ValueError("law is 'rows', or 'bytes' with a size column")
    df = df.drop("curve", "shard", "slot", "law")
    bits = bits or min(10, 62 // len(dims))
    names = [f"_curve_code{i}" for i in range(len(dims))]
    df = _coded(df, dims, names)
    codes = [F.col(x) for x in names]
    grid = [k / (1 << bits) for k in range(1 << bits)]
    found = df.agg(*(F.percentile_approx(c, grid, 10 * (1 << bits)).alias(n) for n, c in zip(names, codes)),
                   *(F.count_if(c.isNull()).alias(f"{n}_nulls") for n, c in zip(names, codes))).first()
    cuts = [np.unique(np.array(found[n] or [], float)) for n in names]
    nulls = [int(found[f"{n}_nulls"] > 0) for n in names]

    @F.pandas_udf("long")
    def place(it: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for code in it:
            cells = []
            for i, own in enumerate(cuts):
                values = code.iloc[:, i].to_numpy(float)
                level = np.maximum(np.searchsorted(own, values, side="right") - 1, 0) + nulls[i]   # of nulls: 0
                level[np.isnan(values)] = 0
                cells.append((level << bits) // max(len(own) + nulls[i], 1))
            yield pd.Series(hilbert_index(cells, bits))

    placed = df.withColumn("curve", place(F.struct(*names))).drop(*names)
    order = ["curve", *tie]
    placed = materialise(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_curve_at", F.monotonically_increasing_id()), "curve")
    part, row = F.shiftright("_curve_at", 33), F.col("_curve_at").bitwiseAND(F.lit((1 << 33) - 1))
    amount = F.col(size).cast("decimal(38,0)") if law == "bytes" else F.lit(0).cast("decimal(38,0)")
    counts = placed.groupBy(part.alias("_curve_part")).agg(F.count("*").alias("_curve_n"), F.sum(amount).alias("_curve_b"))
    before = Window.orderBy("_curve_part").rowsBetween(Window.unboundedPreceding, -1)   # a row for each partition
    everything = Window.orderBy("_curve_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select(
        "_curve_part", F.coalesce(F.sum("_curve_n").over(before), F.lit(0)).alias("_curve_n0"), F.sum("_curve_n").over(everything).alias("_curve_all"),
        F.coalesce(F.sum("_curve_b").over(before), F.lit(0)).cast("decimal(38,0)").alias("_curve_b0"),
        F.sum("_curve_b").over(everything).cast("decimal(38,0)").alias("_curve_total"))
    rows = (placed.withColumn("_curve_part", part).join(F.broadcast(starts), "_curve_part")
            .withColumn("_curve_pos", F.col("_curve_n0") + row))
    if law == "rows":
        rows = (rows.withColumn("shard", F.expr(f"(_curve_pos * {n_shards}) div _curve_all").cast("int"))
                .withColumn("slot", F.col("_curve_pos") - F.expr(f"(shard * _curve_all + {n_shards - 1}) div {n_shards}")))
    else:
        own = Window.partitionBy("_curve_part").orderBy("_curve_at").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_curve_sum", F.col("_curve_b0") + F.coalesce(F.sum(amount).over(own), F.lit(0)))
        rows = rows.withColumn("shard", F.least(
            F.expr(f"coalesce(cast(_curve_sum * {n_shards} as decimal(38,0)) div nullif(_curve_total, 0), 0)"), F.lit(n_shards - 1)).cast("int"))
        first = rows.groupBy("shard").agg(F.min("_curve_pos").alias("_curve_first"))          # n_shards rows
        rows = rows.join(F.broadcast(first), "shard").withColumn("slot", F.col("_curve_pos") - F.col("_curve_first"))
    return (rows.withColumn("law", F.lit(law))
            .drop("_curve_part", "_curve_at", "_curve_n0", "_curve_all", "_curve_b0", "_curve_total", "_curve_pos", "_curve_sum", "_curve_first"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in slot order, so that each file spans
    a short run of the curve and its column statistics prune."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def read_shards(spark, path: str, schema: T.StructType, shards: list[int] | None = None) -> DataFrame:
    """The rows of written shards; of ``shards`` only their folders are read."""
    rows = spark.read.schema(schema).parquet(path)
    return rows if shards is None else rows.filter(F.col("shard").isin(*shards))


def q_sharding(spark, sf_dir: str) -> DataFrame:
    raw = text_bytes()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "lang", "source", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    path = scratch(spark, "shards")
    sharded = hilbert_shards(docs, ["lang", "source", "size"], tie=("text_crc32", "doc_id"))
    write_shards(sharded, path)
    out = read_shards(spark, path, sharded.schema)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "curve")
