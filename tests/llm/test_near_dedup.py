import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.llm import near_dedup as op

SF = "/root/testdata/sf0.001"


def bag(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return Counter(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else Counter()


def brute(rows):
    """Class of each row by comparing all pairs of different texts."""
    keys = [" ".join(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows]
    bags = {k: bag(k) for k in keys}
    texts = list(bags)
    up = {k: k for k in texts}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    where = {}
    for k in texts:
        for s in bags[k]:
            where.setdefault(s, []).append(k)
    seen = set()
    for members in where.values():
        for i, a in enumerate(members):
            for b in members[:i]:
                if (b, a) not in seen:
                    seen.add((b, a))
                    x, y = bags[a], bags[b]
                    both = sum((x & y).values())
                    if both >= 0.8 * (sum(x.values()) + sum(y.values()) - both):
                        up[top(a)] = top(b)
    ids = {}
    for (i, _), k in zip(rows, keys):
        ids.setdefault(top(k), []).append(i)
    least = lambda c: min((x for x in c if x is not None), default=None)
    return sorted(((i, least(ids[top(k)]), len(ids[top(k)])) for (i, _), k in zip(rows, keys)), key=str)


def check(df, rows):
    got = df.collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert all(r.doc_id == r.class_id for r in kept)
    return kept


def test_signatures_agree_like_weighted_jaccard():
    rnd = np.random.default_rng(1)
    element = rnd.integers(0, 2 ** 63, 300, dtype=np.uint64)
    for scale in (1.0, 7.3):
        x, y = rnd.random(300) * scale, rnd.random(300) * scale
        y[:200] = x[:200]
        y[250:] = 0
        k = 4000
        sig = op.darts(np.repeat([0, 1], [300, 250]), np.concatenate((element, element[:250])), np.concatenate((x, y[:250])), 2, k)
        true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        assert (sig != 0).all() and abs((sig[0] == sig[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / k)


def test_pack_round_trip():
    for a in ([], [0], [0, 1, 2 ** 32 - 1], sorted(random.sample(range(2 ** 32), 999))):
        assert op.unpack(op.pack(np.array(a, np.uint32))).tolist() == a


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    kept = check(op.q_near_dedup(spark, SF), rows)
    assert len(kept) == len({c for _, c, _ in brute(rows)}) < len(rows)


def test_star_and_chain_families(spark):
    rnd = random.Random(2)
    rows, n = [], 0
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(120)]
        at = list(base)
        for _ in range(25):
            w = list(base if family % 2 else at)     # copies of one text, or copies of copies
            for _ in range(2):
                w[rnd.randrange(120)] = f"x{rnd.random()}"
            at = w
            rows.append((n := n + 1, " ".join(w)))
        rows.append((n := n + 1, " ".join(base)))
    rnd.shuffle(rows)
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows], "doc_id long, text string").repartition(4)
    check(op.near_duplicates(df), rows)


def test_pairs_hidden_in_a_boilerplate_bucket(spark):
    """Documents with 86-87% of one template's shingles, mutually below 0.8,
    and few pairs above it that meet in buckets of several hundred texts."""
    rnd = random.Random(5)
    template = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(900):
        rows.append((i, " ".join([*template, *(f"u{i}_{k}" for k in range(30 + i % 3))])))
    for i in range(0, 60, 2):
        # shares the template and part of the own words with document i
        own = rows[i][1].split()
        rows.append((1000 + i, " ".join(own[:222] + [f"v{i}_{k}" for k in range(8)])))
    rnd.shuffle(rows)
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows], "doc_id long, text string").repartition(4)
    expected = brute(rows)
    assert sum(size == 2 for _, _, size in expected) == 60 and max(size for _, _, size in expected) == 2
    check(op.near_duplicates(df), rows)


def test_prefix_pairs_do_not_meet_on_boilerplate(spark):
    """Dissimilar texts of one template make no pairs, the similar ones all."""
    rng = np.random.default_rng(6)
    common = rng.integers(0, 2 ** 32, 860, dtype=np.uint64).astype(np.uint32)
    bags = [np.unique(np.concatenate((common, rng.integers(0, 2 ** 32, 140, dtype=np.uint64).astype(np.uint32)))) for _ in range(400)]
    bags += [np.unique(np.concatenate((x[:-40], rng.integers(0, 2 ** 32, 40, dtype=np.uint64).astype(np.uint32)))) for x in bags[:20]]
    rows = [(i, 0, i, 0, op.pack(x)) for i, x in enumerate(bags)]
    df = spark.createDataFrame(rows, "a long, b long, ca long, cb long, shingles binary").repartition(4)
    got = {tuple(sorted((r.a, r.la))) for r in op._prefix_pairs(df).collect()}
    similar = {(i, j) for j in range(len(bags)) for i in range(j) if op.similarity(bags[i], bags[j]) >= op.SIMILARITY}
    assert len(similar) == 20 and similar <= got and len(got) < 1000


def test_links_grow_with_the_rows_of_a_large_group(spark, monkeypatch):
    """All texts of two classes linked crosswise are one edge of classes, and
    texts that are all similar become one class by a pair a row at most."""
    seen, components = [], op.components
    monkeypatch.setattr(op, "components", lambda edges: seen.append(edges.count()) or components(edges))
    ids = range(80)
    labels = spark.createDataFrame([(i, 0, i % 2, 0) for i in ids], "a long, b long, ca long, cb long")
    links = spark.createDataFrame([(i, 0, j, 0, 0, 0, 1, 0) for i in ids if i % 2 == 0 for j in ids if j % 2],
                                  "a long, b long, la long, lb long, ca long, cb long, lca long, lcb long")
    assert {tuple(r) for r in op._merged(labels, links).collect()} == {(i, 0, 0, 0) for i in ids} and seen == [1]
    rng = np.random.default_rng(8)
    draw = lambda n: rng.integers(0, 2 ** 32, n, dtype=np.uint64).astype(np.uint32)
    base = draw(1000)
    bags = [np.unique(np.concatenate((base[40:], draw(40)))) for _ in ids]
    texts = spark.createDataFrame([(i, 0, i, 0, op.pack(x)) for i, x in enumerate(bags)],
                                  "a long, b long, ca long, cb long, shingles binary").repartition(4)
    rows = op._prefixes(texts)
    first = op._first_pairs(rows)
    assert 79 <= first.count() <= rows.count()
    labels = texts.select("a", "b", "ca", "cb")
    links = op._similar(first, texts)
    assert op._merged(labels, links).select("ca").distinct().count() == 1 and links.count() < 80 * 79 // 4


def test_edge_cases(spark):
    words = [f"w{i}" for i in range(80)]
    near = " ".join([*words[:40], "edit", *words[40:]])
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "one  two"), (6, "one two three"), (None, " ".join(words)),
            (7, near), (7, near), (8, "line again and so on " * 4000), (9, "line again and so on " * 4001), (None, "alone"), (10, "ö ü\n ß ä x")]
    rows += [(100 + i, " ".join(words)) for i in range(300)]
    df = spark.createDataFrame([Row(doc_id=i, text=t, row="r", key=1, bands=0) for i, t in rows],
                               "doc_id long, text string, row string, key int, bands int").repartition(3)
    kept = check(op.near_duplicates(df), rows)
    assert len(kept) == len({(r.doc_id, r.class_size) for r in kept})
    assert op.near_duplicates(df.limit(0)).count() == 0
    # rows are decided one by one: of a class with null and repeated ids one row stays
    left = op.drop_near_duplicates(df.withColumn("_row", F.lit("mine")))
    assert left.columns == [*df.columns, "_row"] and {r._row for r in left.collect()} == {"mine"}
    assert sorted(((r.doc_id or 0) for r in left.collect())) == [0, 1, 4, 6, 7, 8, 10]


def test_buckets_are_summed_up_once_and_small_tables_stay_small(spark, monkeypatch):
    written, materialise = {}, op.materialise

    def count(df, name):
        out = materialise(df, name)
        written.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(op, "materialise", count)
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        words = [f"w{i}" for i in range(60)]
        texts = [words[:30] + [f"x{i}", f"y{i}"] for i in range(40)] + [[f"z{i}{w}" for w in words[:20]] for i in range(40)] * 2
        df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
        got = {r.doc_id: r.class_id for r in op.near_duplicates(df).collect()}
        bands = spark.createDataFrame([(i, i, i % 7) for i in range(50)], "a long, b long, key long")
        plan = op._star_pairs(bands, 50)._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert all(got[i] == 0 for i in range(40)) and all(got[i] == got[i + 40] == i for i in range(40, 80))
    # the leaders are read from the folder, not found anew on each side of the join with hot buckets
    assert "min(" not in plan
    assert max(n for k in ("edges", "labels", "leaders", "links", "groups", "classes", "members") for n in written[k]) <= op.FEW


def test_rounds_keep_all_classes(spark, monkeypatch):
    """Buckets and texts come in ROUNDS parts, each written before the next; classes do not depend on how many."""
    base = [" ".join(f"w{d % 9}x{k}" for k in range(60)) for d in range(40)]
    rows = [(d, t if d < 9 or d % 2 else t + " end") for d, t in enumerate(base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    parts, rounds = [], op.materialise_rounds

    def count(some, tag):
        some = list(some)
        parts.append((tag, len(some)))
        return rounds(some, tag)

    monkeypatch.setattr(op, "materialise_rounds", count)
    several = sorted(tuple(r) for r in op.near_duplicates(df).collect())
    assert parts == [("pairs", op.ROUNDS), ("candidates", op.ROUNDS)] and op.ROUNDS > 1
    monkeypatch.setattr(op, "ROUNDS", 1)
    assert sorted(tuple(r) for r in op.near_duplicates(df).collect()) == several
    assert [r[1] for r in several] == [d % 9 for d in range(40)]
