"""Operator 13: ranked lexical search by a dual tree over items and documents.

Each item (a query text) gets the documents of the highest scores. The score
sums, over the item's terms, the term's weight w times the document's impact
g of the term, in whole numbers, so bounds and scores are exact.

Two hierarchies hold coordinate maxima, one coordinate for each term: over
the items of a block, and over the documents of a block. The product of the
maxima of two nodes bounds the score of every pair below them; if it is below
the weakest kth score of all items of the item node, the whole batch of pairs
is left out, as none of them can be among the best. What is left is scored
exactly, the highest bounds first.

A first round searches one in SEED_BLOCKS of the document blocks; its kth
scores are where the second round, over all other blocks, starts to prune.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, batches, binary_column, hash_words, materialise, packed, ragged, text_bytes, words_of

K = 50
ITEM_BYTES = 4 << 20             # item texts searched together, about
ITEM_ROWS = 2000
BLOCK_BYTES = 8 << 20            # document texts of one block, about
LEAF = 16                        # documents of a leaf
FAN = 4                          # nodes below a node
SEED_BLOCKS = 16
NONE = np.iinfo(np.int64).max    # a null doc_id in arrays: after all others


@dataclass
class Items:
    """Items of a block and their distinct terms, in the order of hashes."""
    item_id: np.ndarray
    null_id: np.ndarray
    first: np.ndarray            # terms of item i: term[first[i]:first[i + 1]]
    term: np.ndarray
    hashes: np.ndarray           # of the terms, ascending
    data: np.ndarray             # the terms' bytes
    offset: np.ndarray

    @classmethod
    def of(cls, r) -> Items:
        ids = [NONE if x is None else x for x in r.item_id]
        as_array = lambda b, kind: np.frombuffer(b, kind).astype(kind[1:])
        return cls(np.array(ids, np.int64), np.array([x is None for x in r.item_id], bool), as_array(r.first, "<i8"),
                   as_array(r.term, "<i8"), as_array(r.hashes, "<u8"), np.frombuffer(r.data, np.uint8), as_array(r.offset, "<i8"))

    def find(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The term of each word, -1 if it is none; bytes are compared."""
        out = np.full(len(start), -1, np.int64)
        if not len(self.hashes):
            return out
        at = np.searchsorted(self.hashes, hashes)
        todo = np.arange(len(start))
        while len(todo):
            # terms of one hash (as good as never more than one) in turn
            todo = todo[at[todo] < len(self.hashes)]
            todo = todo[self.hashes[at[todo]] == hashes[todo]]
            t = at[todo]
            size = end[todo] - start[todo]
            same = size == self.offset[t + 1] - self.offset[t]
            w, t, size = todo[same], t[same], size[same]
            differ = buf[ragged(start[w], size)] != self.data[ragged(self.offset[t], size)]
            equal = np.add.reduceat(differ, np.cumsum(size) - size) == 0 if len(size) else np.zeros(0, bool)
            out[w[equal]] = t[equal]
            todo = todo[out[todo] < 0]
            at[todo] += 1
        return out


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Items and their terms, a row for about ITEM_BYTES of texts."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at, block in enumerate(batch.column("block").to_pylist()):
                ids, texts = batch.column("rows").slice(at, 1).flatten().flatten()
                raw, off = binary_column(texts)
                buf = LOWER[raw]
                start, end, first = words_of(buf, off, ALNUM)
                data, hashes = buf.tobytes(), hash_words(buf, start, end)
                words = [data[a:b] for a, b in zip(start.tolist(), end.tolist())]
                place = {w: i for i, w in enumerate(dict.fromkeys(w for _, w in sorted(zip(hashes.tolist(), words))))}
                of_term = dict(zip(words, hashes.tolist()))
                terms = [sorted({place[w] for w in words[a:b]}) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                flat = np.array([t for x in terms for t in x], "<i8")
                heads = np.cumsum([0, *map(len, terms)]).astype("<i8")
                ends = np.cumsum([0, *map(len, place)]).astype("<i8")
                blob = lambda x: pa.array([x if isinstance(x, bytes) else x.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())), blob(heads), blob(flat),
                     blob(np.array([of_term[w] for w in place], "<u8")), blob(b"".join(place)), blob(ends)],
                    ["block", "item_id", "first", "term", "hashes", "data", "offset"])

    rows = items.select(F.col(item_id).cast("long").alias("id"), text_bytes(text).alias("raw"))
    return materialise(packed(rows, ["id", "raw"], "raw", ITEM_BYTES, ITEM_ROWS, "items").mapInArrow(
        run, "block long, item_id array<long>, first binary, term binary, hashes binary, data binary, offset binary"), "item-blocks")


def document_blocks(df: DataFrame, shared, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents reduced to the terms of the items, a row for some MB of
    texts: n_docs and n_terms (of all documents), then of those that have one
    of the items' terms doc_id, length, and (doc, term, tf) in order."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for table in batches(it, BLOCK_BYTES, "raw"):
            raw, off = binary_column(table["raw"])
            buf = LOWER[raw]
            start, end, first = words_of(buf, off, ALNUM)
            count = np.diff(first)
            term = items.find(buf, start, end, hash_words(buf, start, end))
            own = np.flatnonzero(term >= 0)
            doc = np.repeat(np.arange(len(count)), count)[own]
            key, tf = np.unique(doc * max(len(items.hashes), 1) + term[own], return_counts=True)
            doc, term = np.divmod(key, max(len(items.hashes), 1))
            some, doc = np.unique(doc, return_inverse=True)
            ids = table["id"].combine_chunks().take(pa.array(some))
            blob = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([int((count > 0).sum())], pa.int64()), pa.array([int(count.sum())], pa.int64()),
                 pa.array([ids.to_pylist()], pa.list_(pa.int64())), blob(count[some], "<i8"),
                 blob(doc, "<i4"), blob(term, "<i4"), blob(tf, "<i4")],
                ["n_docs", "n_terms", "doc_id", "length", "doc", "term", "tf"])

    rows = df.select(F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("raw"))
    return materialise(rows.mapInArrow(
        run, "n_docs long, n_terms long, doc_id array<long>, length binary, doc binary, term binary, tf binary")
        .withColumn("block", F.monotonically_increasing_id()), "document-blocks")


def term_weights(blocks: DataFrame, n_items_terms: int, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term of an item block."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_items_terms, np.int64)
        for batch in it:
            for x in batch.column("term"):
                df += np.bincount(np.frombuffer(x.as_py(), "<i4"), minlength=n_items_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["t", "df"])

    df = np.zeros(n_items_terms, np.int64)
    # a row for each term of the item block at most
    found = blocks.select("term").mapInArrow(run, "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).toArrow()
    df[found["t"].to_numpy()] = found["df"].to_numpy()
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def node_maxima(node: np.ndarray, term: np.ndarray, value: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted node x term keys, their largest values, where each begins in the
    sorted input)."""
    key = node * n_terms + term
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(new)
    return key[heads], np.maximum.reduceat(value, heads) if len(heads) else value[:0], heads


class ItemTree:
    """Levels of item nodes, leaves (single items) first; a node's coordinate
    maxima are the weights of all terms below it."""

    def __init__(self, items: Items, weight: np.ndarray):
        n = len(items.first) - 1
        item = np.repeat(np.arange(n), np.diff(items.first))
        # items with the same weightiest term are neighbours
        lead = np.zeros(n, np.int64)
        order = np.lexsort((items.term, weight[items.term], item))
        lead[item[order]] = items.term[order]
        self.order = np.argsort(lead, kind="stable")
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        size = max(len(weight), 1)
        key = np.sort(place[item] * size + items.term)
        self.levels = []
        self.n = [n]
        while True:
            node, term = np.divmod(key, size)
            self.levels.append((np.searchsorted(node, np.arange(self.n[-1] + 1)), term))
            if self.n[-1] <= 1:
                break
            key = np.unique(node // FAN * size + term)
            self.n.append(-(-self.n[-1] // FAN))


class Best:
    """The k best (score, doc) of each item so far; ``weakest`` is the score a
    document needs at least."""

    def __init__(self, n: int, k: int, seed: np.ndarray):
        self.k, self.weakest = k, np.maximum(seed, 1)
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.n = n

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.weakest[item]
        if not good.any():
            return
        item, score, doc = (np.concatenate(x) for x in ((self.item, item[good]), (self.score, score[good]), (self.doc, doc[good])))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]
        last = place == self.k - 1
        self.weakest[item[last]] = np.maximum(self.weakest[item[last]], score[last])


def search_block(tree: ItemTree, weight: np.ndarray, best: Best, doc_id: np.ndarray, length: np.ndarray, doc: np.ndarray,
                 term: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int) -> int:
    """Add the documents of a block; returns how many (item, leaf) pairs were
    scored (for tests)."""
    if not len(doc) or not tree.n[0]:
        return 0
    size = len(weight)
    m = 100 - 50 + 50 * length * n_docs // n_terms
    g = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
    # documents led by the same term are neighbours, so that maxima are tight
    order = np.lexsort((term, weight[term] * g, doc))
    lead = np.zeros(len(doc_id), np.int64)
    top = np.zeros(len(doc_id), np.int64)
    lead[doc[order]], top[doc[order]] = term[order], (weight[term] * g)[order]
    by = np.lexsort((top, lead))
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    doc_id, doc = doc_id[by], place[doc]
    leaf = doc // LEAF
    order = np.lexsort((doc, term, leaf))
    doc, term, g, leaf = doc[order], term[order], g[order], leaf[order]
    key, most, heads = node_maxima(leaf, term, g, size)
    tails = np.append(heads[1:], len(doc))
    levels, n = [(key, most)], [int(leaf[-1]) + 1 if len(leaf) else 0]
    n[0] = -(-len(doc_id) // LEAF)
    while n[-1] > 1:
        node, t = np.divmod(levels[-1][0], size)
        order = np.lexsort((t, node // FAN))
        key, most, _ = node_maxima((node // FAN)[order], t[order], levels[-1][1][order], size)
        levels.append((key, most))
        n.append(-(-n[-1] // FAN))

    def matches(q: np.ndarray, d: np.ndarray, q_level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, term, place in ``keys``) of the terms both nodes of a pair have."""
        first, terms = tree.levels[q_level]
        count = first[q + 1] - first[q]
        pair = np.repeat(np.arange(len(q)), count)
        t = terms[ragged(first[q], count)]
        want = d[pair] * size + t
        at = np.searchsorted(keys, want)
        hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == want)
        return pair[hit], t[hit], at[hit]

    def sums(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Exact sums by ascending group."""
        total = np.concatenate(([0], np.cumsum(value)))
        cut = np.searchsorted(group, np.arange(n + 1))
        return total[cut[1:]] - total[cut[:-1]]

    # from the pair of roots down; the deeper tree goes first
    q_level, d_level = len(tree.n) - 1, len(n) - 1
    q, d = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        weakest = best.weakest[tree.order]
        for _ in range(q_level):
            weakest = np.minimum.reduceat(weakest, np.arange(0, len(weakest), FAN))
        bound = np.zeros(len(q), np.int64)
        step = 1 << 14
        for at in range(0, len(q), step):
            pair, t, x = matches(q[at:at + step], d[at:at + step], q_level, levels[d_level][0])
            bound[at:at + step] = sums(pair, weight[t] * levels[d_level][1][x], len(q[at:at + step]))
        live = bound >= weakest[q]
        q, d, bound = q[live], d[live], bound[live]
        if not len(q) or (q_level == 0 and d_level == 0):
            break
        if q_level >= d_level:
            q_level -= 1
            child = q[:, None] * FAN + np.arange(FAN)
            ok = (child < tree.n[q_level]).ravel()
            q, d = child.ravel()[ok], np.repeat(d, FAN)[ok]
        else:
            d_level -= 1
            child = d[:, None] * FAN + np.arange(FAN)
            ok = (child < n[d_level]).ravel()
            q, d = np.repeat(q, FAN)[ok], child.ravel()[ok]
    # each item's leaves, the highest bound first; scores raise the bar for the rest
    scored = 0
    order = np.lexsort((-bound, q))
    q, d, bound = q[order], d[order], bound[order]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    at, width = 0, 4
    while len(q):
        now = (nth < at + width) & (bound >= best.weakest[tree.order[q]])
        pair, t, x = matches(q[now], d[now], 0, levels[0][0])
        count = tails[x] - heads[x]
        entry = ragged(heads[x], count)
        whom = np.repeat(pair, count)
        hit = q[now][whom] * len(doc_id) + doc[entry]
        order = np.argsort(hit, kind="stable")
        hit, value = hit[order], (np.repeat(weight[t], count) * g[entry])[order]
        if len(hit):
            head = np.flatnonzero(np.append(True, hit[1:] != hit[:-1]))
            item, found = np.divmod(hit[head], len(doc_id))
            best.add(tree.order[item], np.add.reduceat(value, head), doc_id[found])
        scored += int(now.sum())
        rest = nth >= at + width
        q, d, bound, nth = q[rest], d[rest], bound[rest], nth[rest]
        at, width = at + width, width * 4
    return scored


def _search(blocks: DataFrame, shared, k: int) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, n_docs, n_terms, seed = shared.value
        tree, best = ItemTree(items, weight), Best(len(items.item_id), k, seed)
        for batch in it:
            for row in range(batch.num_rows):
                get = lambda c, kind: np.frombuffer(batch.column(c)[row].as_py(), kind).astype(np.int64)
                ids = batch.column("doc_id").slice(row, 1).flatten().fill_null(NONE).to_numpy()
                search_block(tree, weight, best, ids, get("length", "<i8"), get("doc", "<i4"), get("term", "<i4"),
                             get("tf", "<i4"), n_docs, n_terms)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.score), pa.array(best.doc, mask=best.doc == NONE)],
                                         ["item", "score", "doc_id"])

    return blocks.select("doc_id", "length", "doc", "term", "tf").mapInArrow(run, "item long, score long, doc_id long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # no more than k rows of an item leave a task
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id",
                  text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: of each item the ``k`` documents with the
    highest scores above 0, equal scores by ascending doc_id (null last).

    Terms are runs of ASCII letters (lower-cased), digits and all characters
    beyond ASCII. Null and empty texts have no terms: such documents are not
    counted, such items find nothing. Rows that repeat an id are documents or
    items of their own (of equal items each has its ranks). Empty tables give
    no rows, other columns play no part.

    Items are searched in blocks of a bounded size, each a pass over the
    documents, in which they are reduced to the block's terms; document
    frequencies and lengths are counted over all documents.
    """
    spark = docs.sparkSession
    blocks_of_items = item_blocks(items, item_id, text)
    out = None
    for i in [r.block for r in blocks_of_items.select("block").collect()]:
        own = Items.of(blocks_of_items.filter(F.col("block") == i).first())
        blocks = document_blocks(docs, spark.sparkContext.broadcast(own), doc_id, text)
        size = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("t")).first()
        n_docs, n_terms = size.n or 0, size.t or 0
        weight = term_weights(blocks, len(own.hashes), n_docs)
        state = lambda seed: spark.sparkContext.broadcast((own, weight, n_docs, n_terms, seed))
        seeds = F.pmod(F.xxhash64("block"), F.lit(SEED_BLOCKS)) == 0
        first = materialise(_ranked(_search(blocks.filter(seeds), state(np.zeros(len(own.item_id), np.int64)), k), k), "ranked")
        # kth scores: one row for each item of the block
        weakest = np.zeros(len(own.item_id), np.int64)
        for r in first.filter(F.col("rank") == k).collect():
            weakest[r.item] = r.score
        second = _search(blocks.filter(~seeds), state(weakest), k)
        ids = pa.table({"item": np.arange(len(own.item_id)), "item_id": pa.array(own.item_id, mask=own.null_id)})
        found = _ranked(first.select("item", "score", "doc_id").unionByName(second), k)
        found = found.join(F.broadcast(spark.createDataFrame(ids)), "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def q_ranked_search(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ranked_search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def _terms_sql(col: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"regexp_extract_all(translate({col}, '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


SQL_RANKED_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms_sql('text')} AS ts FROM documents),
s AS (SELECT count(*) AS N, CAST(sum(len(ts)) AS BIGINT) AS L FROM d WHERE len(ts) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, s GROUP BY t, N),
i AS (SELECT DISTINCT item, item_id, t FROM (SELECT row_number() OVER () AS item, item_id, unnest({_terms_sql('text')}) AS t FROM benchmark)),
f AS (SELECT item, item_id, d.doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(ts) * N) // L)))) AS BIGINT) AS score
  FROM i JOIN w USING (t) JOIN p USING (t) JOIN d USING (r), s GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM f WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {K}"""
