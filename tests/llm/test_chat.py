import hashlib
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.llm import chat as op

SF = "/root/testdata/sf0.01"
SCHEMA = "message_id long, parent_id long, role string, text string, score double, key string, leaf string"


def tree(spark, rows):
    return spark.createDataFrame([(*r, "k", "l") for r in rows], SCHEMA).repartition(3)


def brute_paths(rows):
    """{leaf: path from the root} by walking up; circles have none."""
    by = {r[0]: r for r in rows}
    parents = {r[1] for r in rows}
    out = {}
    for r in rows:
        if r[0] in parents:
            continue
        path, at, seen = [], r[0], set()
        while at in by and at not in seen:
            seen.add(at)
            path.append(at)
            at = by[at][1]
        if at not in seen:
            out[r[0]] = path[::-1]
    return out


def test_paths_and_ranks_like_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, *range(max(0, i - 40), i)]) if i else None, rnd.choice(["user", "assistant"]), f"t{i}",
             rnd.choice([None, 0.5, 1.0, 2.0])) for i in range(300)]
    rows += [(400, 401, "user", "circle", 9.0), (401, 400, "user", "circle", 9.0), (402, 400, "user", "into it", 9.0),
             (500, 999, "user", "its parent is missing", 1.0), (501, 500, "assistant", "reply", None)]
    rows += [(600 + i, 599 + i if i else None, "user", f"c{i}", 0.0) for i in range(70)]
    by = {r[0]: r for r in rows}
    paths = brute_paths(rows)
    assert not {400, 401, 402} & set(paths) and paths[501] == [500, 501] and len(paths[669]) == 70
    every = op.conversations(tree(spark, rows), best=None).collect()
    assert {int(r.leaf_id): op_path(r) for r in every} == {k: [by[i][3] for i in p] for k, p in paths.items()}
    assert {int(r.leaf_id): (int(r.root_id), r.n_turns) for r in every} == {k: (p[0], len(p)) for k, p in paths.items()}
    score = {k: sum(by[i][4] or 0 for i in p) / len(p) for k, p in paths.items()}
    trees = {}
    for k, p in paths.items():
        trees.setdefault(p[0], []).append(k)
    want = {}
    for leaves in trees.values():
        ordered = sorted(leaves, key=lambda k: (-round(score[k], 9), f"={k}"))
        want |= {k: i + 1 for i, k in enumerate(ordered[:2])}
    got = {int(r.leaf_id): r.rank for r in op.conversations(tree(spark, rows), best=2).collect()}
    assert got == want


def op_path(r):
    """Texts of a row, cut out of ``formatted`` by hand."""
    out = []
    for i, t in enumerate(r.turns):
        end = r.turns[i + 1].start if i + 1 < len(r.turns) else len(r.formatted)
        piece = r.formatted[t.start:end]
        for a, b in op.Template().roles.values():
            if piece.startswith(a):
                assert piece.endswith(b)
                out.append(piece[len(a):-len(b)])
    return out


def test_escape_round_trip(spark):
    rnd = random.Random(7)
    bits = [*op.Template().marks, "\\", "\\\\", "[", "]", "<", ">", "<s", "INST]", "[\\INST]", "/", "é漢\U0001F600", "\n", " ", "", "a" * 50]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 12))) for _ in range(600)] + [None, "\\" * 5, "<" * 9 + "s>" * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    done = df.withColumn("e", op.escape(F.col("t"), op.Template())).withColumn("back", op.unescape(F.col("e"))).collect()
    for r in done:
        assert r.back == (r.t or "")
        assert not any(m in r.e for m in op.Template().marks)


def test_turns_and_loss_read_back(spark):
    rnd = random.Random(11)
    bits = [*op.Template().marks, "\\", "word ", "\U0001F600", "\n", ""]
    roles = ["user", "assistant", "system", "tool", "[ROLE]x\\", None, ""]
    rows, said = [], {}
    for c in range(40):
        said[c] = [(rnd.choice(roles), rnd.choice([None, "".join(rnd.choices(bits, k=rnd.randint(0, 8)))])) for _ in range(rnd.randint(1, 9))]
        rows += [Row(conv_id=c, turn=i, role=r, text=t, formatted="x", place=1) for i, (r, t) in enumerate(said[c])]
    rows.append(Row(conv_id=None, turn=None, role="assistant", text="no id", formatted="x", place=1))
    said[-1] = [("assistant", "no id")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, place int")
    done = op.conversations(op.chains(df)).withColumn("read", op.read_turns("formatted")).withColumn("loss", op.read_loss("formatted", "turns"))
    got = {int(r.root_id.split(":")[0] or -1): r for r in done.collect()}
    assert set(got) == set(said)
    for c, turns in said.items():
        r = got[c]
        assert [(x.role, x.text) for x in r.read] == [(a or "", b or "") for a, b in turns]
        assert r.loss == [(b or "") if a == "assistant" else "" for a, b in turns]
        # the mask's places, cut out by hand
        cut = [r.formatted[t.loss_start:t.loss_end] for t in r.turns]
        assert ["".join(x.split("\\")) for x in cut] == ["".join((b or "").split("\\")) if a == "assistant" else "" for a, b in turns]


def test_repeated_null_and_empty(spark):
    rows = [(1, None, "user", "q", 0.0), (1, None, "user", "q", 0.0), (2, 1, "assistant", "b", 1.0), (2, 1, "assistant", "a", 1.0),
            (None, 1, "assistant", "no id", 5.0), (None, None, "user", "alone", 0.0), (3, 3, "user", "own parent", 0.0)]
    got = op.conversations(tree(spark, rows), best=None)
    texts = sorted(op_path(r) for r in got.collect())
    first = min("ab", key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert texts == [["alone"], ["q", first], ["q", "no id"]]
    empty = spark.createDataFrame([], SCHEMA)
    assert op.conversations(empty).collect() == [] and op.conversations(empty.drop("score"), best=None).collect() == []


def test_ambiguous_marks_are_refused():
    for roles in ({"user": ("<a>", "<a>>")}, {"user": ("xy", "yz")}, {"user": ("a\\b", "cc")}, {"user": ("<", "cc")}):
        with pytest.raises(ValueError):
            op.Template(roles=roles)


def test_no_python_in_the_plan(spark):
    plan = op.q_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_very_long_text(spark):
    long = "[INST]\\ text " * 100_000
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    r = op.conversations(op.chains(df)).select(op.read_turns("formatted").alias("t")).first()
    assert [x.text for x in r.t] == [long, long]
