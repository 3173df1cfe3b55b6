"""Operator 8: near-duplicate documents by DartMinHash signatures.

A document is a weighted set: its five-word shingles, weighted by how often
they occur. Over each element lies a plane of weight by rank into which its
hash throws darts at a constant rate (a Poisson process, the same in every
document); a dart hits a document if its weight lies below the document's
weight of the element. Each dart also carries a coordinate, and the
signature keeps, for each coordinate, the earliest dart that hits. Two
documents agree in a coordinate with the probability of their weighted
Jaccard similarity. The planes are cut into weight regions [2^v - 1,
2^(v+1) - 1) whose darts are drawn in order of rank, so a document costs its
shingles plus about k ln k darts.

Signatures are banded; documents that share a band are compared with the
band's leaders by their exact weighted similarity, and similar ones form
classes (connected components). Where several classes meet in a band, their
documents are joined on their rarest shingles, which misses no similar pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (NOT_SPACE, batches, binary_column, free_shuffles, hash_windows, hash_words, join_with_hot, materialise,
                     materialise_rounds, mix, numbered, text_bytes, words_of)

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4              # a pair at 0.8 shares no band with probability 3e-5
K = BANDS * ROWS
LEADERS = 3                      # of a bucket, that all its texts are compared with
MEMO = 200_000                   # texts a task remembers having sent (saves work only)
SALT_ROWS = 500                  # pairs with one leader that are compared together, about
SLOTS = 1 << 22                  # counters of element frequencies: an order to search by, no result depends on it
PART = 1 << 16                   # counters that travel in one row
SIDE = 2000                      # texts of an element that meet as many others in one task, about
FEW, FEW_ROWS = 12, 20_000       # partitions of a table of numbers at least, rows of one about
PAIR_ROWS = 10                   # such rows that a pair with its shingles counts as
ROUNDS = 3                       # parts in which buckets, and texts with their shingles, are shuffled one after another

_U = np.uint64


def darts(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int = K) -> np.ndarray:
    """DartMinHash signatures (n_docs × k dart ids) of weighted sets.

    ``doc``, ``element`` (64-bit hashes) and ``weight`` (> 0) list the
    elements; a document without elements gets zeros.
    """
    total = np.bincount(doc, weight, n_docs)
    out = np.zeros(n_docs * k, np.uint64)
    todo = total > 0
    limit = np.full(n_docs, k * (np.log(k) + 2))
    limit[todo] /= total[todo]
    while todo.any():
        best = np.full(n_docs * k, np.inf)
        chosen = np.flatnonzero(todo[doc])
        region = 0
        while len(chosen):
            # elements whose weight reaches into this region
            low, size = float((1 << region) - 1), float(1 << region)
            d, x = doc[chosen], weight[chosen]
            seed = mix(element[chosen] + _U(region * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            rank, bound, n = np.zeros(len(chosen)), limit[d], 0
            while len(d):
                n += 1
                own = mix(seed + _U(n * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1))
                rank = rank - np.log1p((own >> _U(11)) * -(2.0 ** -53)) / size
                near = rank < bound
                d, x, seed, rank, bound, own = d[near], x[near], seed[near], rank[near], bound[near], own[near]
                dart = mix(own ^ _U(0xA0761D6478BD642F))
                hit = low + (dart >> _U(11)) * 2.0 ** -53 * size < x
                name = mix(dart[hit])
                place = d[hit] * k + (name % _U(k)).astype(np.int64)
                np.minimum.at(best, place, rank[hit])
                won = rank[hit] == best[place]
                out[place[won]] = name[won]
            region += 1
            chosen = chosen[weight[chosen] > (1 << region) - 1]
        # coordinates that no dart has hit yet: throw on to a higher rank
        todo &= np.isinf(best.reshape(n_docs, k)).any(axis=1)
        limit[todo] *= 2
    return out.reshape(n_docs, k)


def shingles(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, hash and count, in order;
    and the number of words of each text. A text of fewer words, but not
    none, has one shingle of all its words."""
    starts, ends, first = words_of(buf, offsets, NOT_SPACE)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    words = hash_words(buf, starts, ends)
    place = np.arange(len(doc)) - first[:-1][doc]
    whole = np.flatnonzero(count[doc] - place >= SHINGLE)
    hashes = hash_windows(words, SHINGLE)[whole]
    owner = doc[whole]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        own = np.array([hash_windows(words[first[i]:first[i + 1]], int(count[i]))[0] for i in short], np.uint64)
        hashes, owner = np.concatenate((hashes, own)), np.concatenate((owner, short))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    return owner[heads[:-1]], hashes[heads[:-1]], np.diff(heads), count


def pack(elements: np.ndarray) -> bytes:
    """A sorted array of distinct uint32, as compressed differences."""
    steps = np.diff(elements, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.cumsum(np.ascontiguousarray(data.reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard; a shingle's c-th occurrence is an element of its own."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def _sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent: set[bytes] = set()
    for table in batches(it, 4 << 20, "raw"):
        buf, offsets = binary_column(table["raw"])
        data = buf.tobytes()
        owner, hashes, times, n_words = shingles(buf, offsets)
        signature = darts(owner, hashes, times.astype(float), len(offsets) - 1)
        rows = signature.reshape(-1, BANDS, ROWS)
        band = np.zeros(rows.shape[:2], np.uint64)
        for i in range(ROWS):
            band = mix(band * _U(0x9E3779B97F4A7C15) + rows[:, :, i])
        band = mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
        first = np.searchsorted(owner, np.arange(len(offsets)))
        # the c-th occurrence of a shingle as an element: 32 bits, compared in pairs of documents only
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        repeated = (mix(np.repeat(hashes, times) + nth.astype(np.uint64)) >> _U(32)).astype(np.uint32)
        ends = np.concatenate(([0], np.cumsum(times)))
        keys, packed, bands = np.zeros((len(offsets) - 1, 2), np.int64), [], []
        for i in range(len(offsets) - 1):
            key = hashlib.blake2b(b" ".join(data[offsets[i]:offsets[i + 1]].split()), digest_size=16).digest()
            keys[i] = np.frombuffer(key, np.int64)
            if key in sent or not n_words[i]:
                packed.append(None)
                bands.append(None)
                continue
            if len(sent) >= MEMO:
                sent.clear()
            sent.add(key)
            packed.append(pack(np.unique(repeated[ends[first[i]]:ends[first[i + 1]]])))
            bands.append(band[i])
        yield pa.RecordBatch.from_arrays(
            [table["row"].combine_chunks(), table["id"].combine_chunks(), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.maximum(n_words - SHINGLE + 1, n_words > 0)),
             pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["row", "doc_id", "a", "b", "n_shingles", "shingles", "bands"])


def _compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        held: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint32))
        keep = []
        for x, y in zip(batch.column("shingles"), batch.column("leader_shingles")):
            leader = y.as_py()
            if leader != held[0]:
                held = (leader, unpack(leader))
            keep.append(similarity(unpack(x.as_py()), held[1]) >= SIMILARITY)
        yield batch.drop_columns(["shingles", "leader_shingles"]).filter(pa.array(keep, pa.bool_()))


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (text a, b; leader la, lb; written) those similar enough,
    with all their columns of numbers.
    Pairs of a hot leader are dealt to several tasks, each with a copy of its
    shingles; the deal is made before any shingles are joined to a pair."""
    n = pairs.count()
    salts = materialise(_few(pairs.groupBy("la", "lb").agg(F.count("*").alias("times"))
                             .withColumn("n", F.ceil(F.col("times") / SALT_ROWS)), n), "leaders")
    leaders = (salts.drop("times").join(texts.select(F.col("a").alias("la"), F.col("b").alias("lb"), F.col("shingles").alias("leader_shingles")),
                                        ["la", "lb"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n") - 1))))
    dealt = join_with_hot(pairs, salts, ["la", "lb"], "times", n=n).withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.col("n")))
    members = dealt.drop("n", "times").join(texts.select("a", "b", "shingles"), ["a", "b"])
    return _few(members.join(leaders.drop("n"), ["la", "lb", "salt"]).select(
        *pairs.columns, "shingles", "leader_shingles"), PAIR_ROWS * n).mapInArrow(_compare, ", ".join(f"{c} long" for c in pairs.columns))


def _few(df: DataFrame, n: int) -> DataFrame:
    """``df``, of at most ``n`` rows of a few numbers, in as many partitions
    as these need: each is a task and a file in all steps that follow."""
    return df.coalesce(max(FEW, -(-n // FEW_ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b, la, lb; written): each node with
    the smallest node of its component (ca, cb).

    Each round takes the smallest label among a node and its neighbours and
    then the label's own label; both shrink the distance to the smallest node,
    so the number of rounds follows the logarithm of the diameter in practice.
    Labels are written to the shared folder after each round."""
    n = 2 * edges.count()
    node, peer = F.struct("a", "b"), F.struct(F.col("la").alias("a"), F.col("lb").alias("b"))
    both = materialise(_few(edges.select(node.alias("v"), peer.alias("w"))
                            .unionByName(edges.select(peer.alias("v"), node.alias("w"))).distinct(), n), "edges")
    labels = materialise(_few(both.groupBy("v").agg(F.min("w").alias("least")).select("v", F.least("v", "least").alias("c")), n), "labels")
    while True:
        seen = both.join(labels.select(F.col("v").alias("w"), "c"), "w").groupBy("v").agg(F.min("c").alias("near"))
        step = labels.join(seen, "v").select("v", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("further"))
        step = materialise(_few(step.join(jump, "c").select("v", "old", F.least("c", "further").alias("c")), n), "labels")
        labels = step.drop("old")
        if step.filter("c != old").isEmpty():
            return labels.select("v.a", "v.b", F.col("c.a").alias("ca"), F.col("c.b").alias("cb"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (text a, b; class ca, cb) after links between texts of classes
    ca, cb and lca, lcb (both written). Any number of links between two classes is one edge
    of classes, so the components cost no more when all texts of a large
    class are similar to all of another."""
    edges = links.select(F.col("ca").alias("a"), F.col("cb").alias("b"), F.col("lca").alias("la"), F.col("lcb").alias("lb")).distinct()
    n_texts = labels.count()
    new = components(materialise(_few(edges, links.count()), "class-edges")).toDF("ca", "cb", "na", "nb")
    new = materialise(_few(labels.groupBy("ca", "cb").agg(F.count("*").alias("n")).join(new, ["ca", "cb"]), n_texts), "merged")
    return materialise(_few(join_with_hot(labels, new, ["ca", "cb"], "n", n=n_texts).select(
        "a", "b", F.coalesce("na", "ca").alias("ca"), F.coalesce("nb", "cb").alias("cb")), n_texts), "labels")


def _round(key: str, i: int) -> Column:
    """Whether a row is of round ``i``, by a column of hashes."""
    return F.pmod(key, F.lit(ROUNDS)) == i


def _star_pairs(bands: DataFrame, n_rows: int) -> DataFrame:
    """(text, leader): each text of a bucket with the bucket's leaders, its
    first texts in LEADERS different orders. Texts that are not similar to one
    leader often are to another, which leaves fewer mixed buckets."""
    order = [F.struct("a", "b"), *(F.struct(F.xxhash64("a", "b", F.lit(i)).alias("h"), "a", "b") for i in range(1, LEADERS))]
    stars = bands.groupBy("key").agg(*(F.min(x).alias(f"x{i}") for i, x in enumerate(order)), F.max(order[0]).alias("last"),
                                     F.count("*").alias("n")).filter("x0 != last")
    leaders = F.array_distinct(F.array(*(F.struct(F.col(f"x{i}.a").alias("la"), F.col(f"x{i}.b").alias("lb")) for i in range(LEADERS))))
    # read several times below
    stars = materialise(stars.select("key", "n", leaders.alias("leaders")), "stars")
    free_shuffles(bands.sparkSession)
    found = join_with_hot(bands, stars, ["key"], "n", n=n_rows).filter("leaders is not null")
    return found.select("a", "b", F.inline("leaders")).filter("la != a or lb != b").distinct()


def _frequencies(texts: DataFrame) -> np.ndarray:
    """How many texts have elements of each of SLOTS hash slots, as eighths
    of a power of two in one byte (0: at most one text). All texts must only
    order their elements alike, so steps do no harm."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.uint32)
        for batch in it:
            for x in batch.column("shingles"):
                np.add.at(total, unpack(x.as_py()) % SLOTS, 1)
        rows = [(p, zstandard.ZstdCompressor(1).compress(own.tobytes())) for p, own in enumerate(total.reshape(-1, PART)) if own.any()]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())],
                                         ["part", "data"])

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in it:
            for p, d in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                own = np.frombuffer(zstandard.ZstdDecompressor().decompress(d), np.uint32)
                total[p] = total[p] + own if p in total else own.astype(np.uint64)
        step = lambda x: np.minimum(8 * np.log2(np.maximum(x, 1)), 255).astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([step(x) for x in total.values()], pa.binary())],
                                         ["part", "data"])

    out = np.zeros((SLOTS // PART, PART), np.uint8)
    # SLOTS bytes, whatever the input
    for r in (texts.select("shingles").mapInArrow(count, "part int, data binary")
              .repartition(SLOTS // PART, "part").mapInArrow(add, "part int, data binary").collect()):
        out[r.part] = np.frombuffer(r.data, np.uint8)
    return out.ravel()


def _prefixes(texts: DataFrame) -> DataFrame:
    """The elements by which texts (a, b, shingles; class ca, cb) may meet
    similar ones: element, its place in the text, the text's size n.

    Elements are ordered by frequency, rare ones first. The first common
    element of two similar texts of x and y elements has at least
    4/9 (x + y) elements from it on in both, so it is in the first fifth (and
    one) of the larger text and the first ninth (and one, ``small``) of the
    smaller one. Texts that share only frequent elements, too few to be
    similar, have none there and do not meet."""
    shared = texts.sparkSession.sparkContext.broadcast(_frequencies(texts))

    def prefixes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = shared.value
        for batch in it:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                row, element, place, size = [], [], [], []
                for i, x in enumerate(part.column("shingles")):
                    own = unpack(x.as_py())
                    times = frequency[own % SLOTS]
                    n = len(own)
                    first = np.lexsort((own, times))[:n - -(-4 * n // 5) + 1]
                    # an element that no other text has pairs nothing
                    keep = np.flatnonzero(times[first] > 0)
                    row.append(np.full(len(keep), i))
                    element.append(own[first[keep]].view(np.int32))
                    place.append(keep)
                    size.append(np.full(len(keep), n))
                own = part.select(["a", "b", "ca", "cb"]).take(pa.array(np.concatenate(row)))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.concatenate(element)), pa.array(np.concatenate(place), pa.int32()),
                     pa.array(np.concatenate(size), pa.int32())], ["a", "b", "ca", "cb", "element", "place", "n"])

    return materialise(texts.select("a", "b", "ca", "cb", "shingles").mapInArrow(
        prefixes, "a long, b long, ca long, cb long, element int, place int, n int")
        .withColumn("small", F.expr("9L * (n - place) >= 8L * n")), "prefixes")


# the pairs that may be similar and are of different classes, once each
_MAY_LINK = ("(ca != lca or cb != lcb) and struct(ln, la, lb) < struct(n, a, b)"
             " and 9L * least(n - place, ln - lplace) >= 4L * (n + ln)")
_PAIR = ["a", "b", "la", "lb", "ca", "cb", "lca", "lcb"]


def _mixed_elements(rows: DataFrame) -> DataFrame:
    """Elements of rows (written) in which several classes meet, with their
    smallest text."""
    label = F.struct("ca", "cb")
    first = F.struct(F.col("n").alias("ln"), F.col("a").alias("la"), F.col("b").alias("lb"), F.col("ca").alias("lca"),
                     F.col("cb").alias("lcb"), F.col("place").alias("lplace"))
    groups = rows.groupBy("element").agg(F.count("*").alias("n_large"), F.sum(F.col("small").cast("long")).alias("n_small"),
                                         F.min(F.when(F.col("small"), first)).alias("first"), F.min(label).alias("x"), F.max(label).alias("y"))
    return materialise(_few(groups.filter("n_small > 0 and x != y").select(
        "element", "n_large", F.ceil(F.col("n_large") / SIDE).alias("k_large"), F.ceil(F.col("n_small") / SIDE).alias("k_small"), "first"),
        rows.count()), "elements")


def _first_pairs(rows: DataFrame) -> DataFrame:
    """Of the pairs of ``_meeting_pairs`` those with an element's smallest
    text, at most one for each row. Texts of a large group of similar ones
    become a class by these, so that they need not all meet each other."""
    groups = _mixed_elements(rows).select("element", "n_large", "first")
    n = rows.count()
    return _few(join_with_hot(rows, groups, ["element"], "n_large", n=n).filter("n_large is not null").select(
        "*", "first.*").filter(_MAY_LINK).select(*_PAIR).distinct(), n)


def _meeting_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of texts of different classes by their prefixes, among which are
    all that are similar enough. An element's texts meet in blocks of SIDE x SIDE."""
    groups = _mixed_elements(rows).drop("first")
    rows = join_with_hot(rows, groups, ["element"], "n_large").filter("n_large is not null")
    deal = lambda k: F.pmod(F.xxhash64("a", "b"), F.col(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.col(k) - 1))
    large = rows.withColumn("p", deal("k_large")).withColumn("q", every("k_small")).drop("small", "n_large", "k_large", "k_small")
    small = rows.filter("small").withColumn("q", deal("k_small")).withColumn("p", every("k_large")).select(
        "element", "p", "q", F.col("a").alias("la"), F.col("b").alias("lb"), F.col("ca").alias("lca"), F.col("cb").alias("lcb"),
        F.col("place").alias("lplace"), F.col("n").alias("ln"))
    return large.join(small, ["element", "p", "q"]).filter(_MAY_LINK).select(*_PAIR).distinct()


def _prefix_pairs(texts: DataFrame) -> DataFrame:
    """``_meeting_pairs`` of texts (a, b, shingles; class ca, cb)."""
    return _meeting_pairs(_prefixes(texts))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row for each row of ``df``: doc_id, class_id, class_size, kept, n_shingles
    (and ``row``, if ``df`` has a column of row numbers of that name).

    Two texts are linked if the weighted Jaccard similarity of their five-word
    shingle counts is at least 0.8 (words are separated by ASCII white space
    and compared byte for byte; a text of one to four words is one shingle).
    Classes are the components of linked texts; texts with equal words are in
    one class, so are all texts without words (null and empty ones).
    ``class_id`` is the class's smallest id (null only if all its ids are
    null), and exactly one row of a class, one with this id, is ``kept``.
    Repeated rows are copies. An empty table gives an empty result; other
    columns play no part.

    Copies are collapsed first. Each text of a band's bucket is compared with
    a few leaders of the bucket. As it may be similar to others but not to
    them, all texts of buckets in which several classes meet are joined on
    their rarest shingles: first with the smallest text that has the shingle,
    then, where several classes are left, with each other (``_meeting_pairs``),
    which finds every similar pair of different classes. All pairs are checked
    on the exact shingle counts.
    """
    source = df.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
                       F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("raw"))
    docs = materialise(source.mapInArrow(
        _sign, "row long, doc_id long, a long, b long, n_shingles long, shingles binary, bands array<long>"), "signatures")
    sent = docs.filter("bands is not null")
    n_rows = sent.count() * BANDS
    bands = sent.select("a", "b", F.explode("bands").alias("key"))
    pairs = materialise_rounds((_star_pairs(bands.filter(_round("key", i)), n_rows) for i in range(ROUNDS)), "pairs")
    pairs = materialise(pairs.distinct(), "pairs")
    nodes = pairs.select("a", "b").union(pairs.select("la", "lb")).distinct()
    texts = materialise_rounds((sent.filter(_round("a", i)).select("a", "b", "shingles", "bands").join(nodes, ["a", "b"], "left_semi")
                                .dropDuplicates(["a", "b"]) for i in range(ROUNDS)), "candidates")
    n_texts = texts.count()
    labels = components(materialise(_similar(pairs, texts), "links"))
    free_shuffles(df.sparkSession)
    labelled = materialise(_few(texts.select("a", "b", "bands").join(labels, ["a", "b"], "left").select(
        "a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"), "bands"), PAIR_ROWS * n_texts), "labelled")
    labels = materialise(_few(labelled.drop("bands"), n_texts), "labels")
    known = labelled.select("a", "b", "ca", "cb", F.explode("bands").alias("key"))
    sizes = known.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("ca", "cb")).alias("x"),
                                     F.max(F.struct("ca", "cb")).alias("y")).filter("x != y").select("key", "n")
    met = join_with_hot(known, materialise(_few(sizes, n_texts * BANDS), "mixed-buckets"), ["key"], "n", n=n_texts * BANDS).filter("n is not null")
    mixed = materialise(texts.select("a", "b", "shingles").join(met.select("a", "b", "ca", "cb").distinct(), ["a", "b"]), "mixed")
    free_shuffles(df.sparkSession)
    rows = _prefixes(mixed)
    merged = False
    for some in (_first_pairs, _meeting_pairs):
        if merged:
            rows = materialise(_few(rows.drop("ca", "cb").join(labels, ["a", "b"]), rows.count()), "prefixes")
        more = materialise(_similar(materialise(some(rows), "pairs"), texts), "links")
        merged = not more.isEmpty()
        if merged:
            labels = _merged(labels, more)
        free_shuffles(df.sparkSession)

    # copies of a text, then texts of a class
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    n_docs = docs.count()
    groups = docs.groupBy("a", "b").agg(F.min(first).alias("first"), F.count("*").alias("n"))
    groups = materialise(_few(groups.join(labels, ["a", "b"], "left").select(
        "a", "b", "n", "first", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")), n_docs), "groups")
    classes = groups.groupBy("ca", "cb").agg(F.min("first").alias("head"), F.sum("n").alias("class_size"),
                                             F.count("*").alias("n_texts"))
    groups = join_with_hot(groups, materialise(_few(classes, n_docs), "classes"), ["ca", "cb"], "n_texts")
    groups = materialise(_few(groups.select("a", "b", "n", "head", "class_size"), n_docs), "members")
    rows = docs.select("doc_id", "row", "a", "b", "n_shingles")
    return join_with_hot(rows, groups, ["a", "b"], "n", n=n_docs).select(
        "doc_id", F.col("head.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("head.row")).alias("kept"), "n_shingles",
        *([F.col("row").alias(row)] if row else []))


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one document of each class of ``near_duplicates``, all
    columns: one with the smallest id, null ids after all others.

    Rows are decided by number, so of a class with null or repeated ids one
    row stays too. Texts without words (null and empty ones among them) are
    one class. An empty table stays empty; other columns play no part."""
    rows, number = numbered(df, "near-rows")
    gone = near_duplicates(rows, doc_id, text, number).filter("not kept").select(number)
    return rows.join(gone, number, "left_anti").drop(number)


def q_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
