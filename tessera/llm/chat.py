"""Operator 12: reply trees formatted as conversations.

Messages point to the message they answer. Iterative self-joins that double
their reach give each message its root, its depth and the score of its path;
the branches of a tree are ranked by score, and the chosen leaves are spread
out to their whole root-to-leaf paths by the same doubled links. Only ids
travel in these joins; texts are joined once, to the chosen paths.

Each path becomes one text in a template whose control strings mark the
turns. Control strings inside roles and texts are escaped: every backslash is
doubled and a backslash put behind the first character of each control
string. So no control string is left in them and ``read_turns`` gets every
role and text back.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise


@dataclass(frozen=True)
class Template:
    """Marks around the text of a role's turns; ``other`` has the marks of all
    other roles: before the role, between role and text, and behind the text.
    ``learn`` are the roles whose texts are under the loss mask.

    No mark may hold a backslash, hold another mark, or end as another begins
    (checked), so that marks are found without doubt."""
    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/TEXT]")
    learn: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        marks = self.marks
        for a in marks:
            for b in marks:
                if len(a) < 2 or "\\" in a or (a != b and a in b) or any(a.endswith(b[:i]) for i in range(1, min(len(a), len(b)))):
                    raise ValueError(f"ambiguous marks {a!r}, {b!r}")

    @property
    def marks(self) -> list[str]:
        return [*(m for pair in self.roles.values() for m in pair), *self.other]

    @property
    def closing(self) -> list[str]:
        return [*(b for _, b in self.roles.values()), self.other[2]]


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()<>*+-=!?^$|/" else c for c in s)


def escape(text: Column, template: Template) -> Column:
    """Null counts as empty."""
    ends = "|".join(f"(?<={_quoted(m[0])}){_quoted(m[1:])}" for m in template.marks)
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"(?={ends})", F.lit("\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _marked(template: Template) -> tuple[Column, Column]:
    """What stands before and behind the text of a turn."""
    role = F.coalesce("role", F.lit(""))
    before = F.concat(F.lit(template.other[0]), escape(role, template), F.lit(template.other[1]))
    behind = F.lit(template.other[2])
    for name, (a, b) in template.roles.items():
        before, behind = F.when(role == name, F.lit(a)).otherwise(before), F.when(role == name, F.lit(b)).otherwise(behind)
    return before, behind


def reply_paths(messages: DataFrame, best: int | None = 1) -> tuple[DataFrame, DataFrame]:
    """(chosen leaves: leaf, root, rank, path_score, n_turns; their paths: leaf,
    node, up).

    ``messages`` has key (unique), parent and score. ``up`` counts from the
    leaf, 0, to the root. A message is a root if it has no parent or one that
    is not there. Messages that only lead into a circle are on no path. A
    path's score is the mean of its messages' scores; of each tree the
    ``best`` paths of the highest scores are chosen, ties by key (``None``:
    all, without a rank). Skewed parents are left to adaptive joins, which
    split them, as the looked-up side has each key once.
    """
    nodes = messages.select("key", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("key").alias("parent"), F.lit(True).alias("there"))
    step = nodes.join(known, "parent", "left").select(
        "key", F.when(F.col("there"), F.col("parent")).alias("up"), F.when(F.col("there").isNull(), F.col("key")).alias("root"),
        F.col("score").alias("total"), F.lit(1).cast("long").alias("n"))
    steps = [materialise(step, "reply-steps")]
    bits = steps[0].count().bit_length()
    while len(steps) <= bits and not steps[-1].filter("up is not null").isEmpty():
        now = steps[-1]
        further = now.select(F.col("key").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"),
                             F.col("total").alias("total2"), F.col("n").alias("n2"))
        moved = now.filter("up is not null").join(further, "up").select(
            "key", F.col("up2").alias("up"), F.col("root2").alias("root"), (F.col("total") + F.col("total2")).alias("total"),
            (F.col("n") + F.col("n2")).alias("n"))
        steps.append(materialise(moved.unionByName(now.filter("up is null")), "reply-steps"))
    parents = steps[0].filter("up is not null").select(F.col("up").alias("key")).distinct()
    leaves = (steps[-1].filter("root is not null").join(parents, "key", "left_anti")
              .select(F.col("key").alias("leaf"), "root", (F.col("total") / F.col("n")).alias("path_score"), F.col("n").alias("n_turns")))
    if best is None:
        chosen = leaves.withColumn("rank", F.lit(None).cast("int"))
    else:
        # no more than ``best`` rows of a tree leave a map task
        order = Window.partitionBy("root").orderBy(F.desc("path_score"), "leaf")
        chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    chosen = materialise(chosen, "reply-leaves")
    paths = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up"))
    for k, now in enumerate(steps[:-1]):
        links = now.filter("up is not null").select(F.col("key").alias("node"), F.col("up").alias("next"))
        more = paths.join(links, "node").select("leaf", F.col("next").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        paths = materialise(paths.unionByName(more), "reply-paths")
    return chosen, paths


def conversations(messages: DataFrame, best: int | None = 1, template: Template = Template()) -> DataFrame:
    """One row for each chosen root-to-leaf path: root_id, leaf_id, rank,
    path_score, n_turns, formatted and turns.

    ``messages`` has message_id, parent_id, role, text and, if it likes, score
    (null: 0). ``turns`` lists for each turn, in order, where it starts in
    ``formatted`` and where its text under the loss mask lies (loss_start to
    loss_end, code points from 0; equal if none). A null text or role counts
    as empty. Of rows that repeat a message_id the first by parent, score,
    role and text digest stays; rows without one are messages that nobody
    answers. Other columns play no part; an empty table gives no rows.
    A path is one row, whatever its length, as its text is one.
    """
    if "score" not in messages.columns:
        messages = messages.withColumn("score", F.lit(0.0))
    rows = materialise(messages.select(
        F.col("message_id").cast("string").alias("id"), F.concat(F.lit("="), F.col("parent_id").cast("string")).alias("parent"),
        F.col("score").cast("double").alias("score"), "role", "text").withColumn("row", F.monotonically_increasing_id())
        .withColumn("key", F.coalesce(F.concat(F.lit("="), "id"), F.concat(F.lit("#"), F.col("row").cast("string")))), "messages")
    order = F.struct("parent", "score", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "row")
    single = materialise(rows.groupBy("key").agg(F.min(order).alias("x")).select("key", "x.parent", "x.score", "x.row"), "message-ids")
    chosen, paths = reply_paths(single, best)

    said = rows.join(single.select("row"), "row", "left_semi").select(F.col("key").alias("node"), "role", "text")
    before, behind = _marked(template)
    own = escape(F.col("text"), template)
    parts = paths.join(said, "node").select("leaf", "up", before.alias("a"), own.alias("t"), behind.alias("b"),
                                            F.coalesce("role", F.lit("")).isin(*template.learn).alias("learn"))
    size = lambda c: F.char_length(c).cast("long")
    earlier = Window.partitionBy("leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum(size("a") + size("t") + size("b")).over(earlier), F.lit(0).cast("long")))
    text_at = F.col("start") + size("a")
    turn = F.struct((-F.col("up")).alias("place"), F.concat("a", "t", "b").alias("piece"), "start", text_at.alias("loss_start"),
                    (text_at + F.when(F.col("learn"), size("t")).otherwise(0)).alias("loss_end"))
    whole = parts.groupBy("leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "leaf", F.array_join("turns.piece", "").alias("formatted"),
        F.transform("turns", lambda x: F.struct(x.start.alias("start"), x.loss_start.alias("loss_start"), x.loss_end.alias("loss_end"))).alias("turns"))
    given = lambda c: F.when(F.col(c).startswith("="), F.substr(F.col(c), F.lit(2))).alias(f"{c}_id")
    return whole.join(chosen, "leaf").select(given("root"), given("leaf"), "rank", "path_score", "n_turns", "formatted", "turns")


def read_turns(formatted: str | Column, template: Template = Template()) -> Column:
    """The turns of a formatted text: an array of (piece, role, text), where
    ``piece`` is the turn as it stands there, without its closing mark."""
    text = F.col(formatted) if isinstance(formatted, str) else formatted
    pieces = F.split(text, "|".join(map(_quoted, template.closing)), -1)

    def turn(piece: Column) -> Column:
        a, between, _ = template.other
        other = F.substr(piece, F.lit(len(a) + 1))
        role = unescape(F.substring_index(other, between, 1))
        said = F.substr(other, F.char_length(F.substring_index(other, between, 1)) + len(between) + 1)
        for name, (mark, _) in template.roles.items():
            mine = piece.startswith(mark)
            role = F.when(mine, F.lit(name)).otherwise(role)
            said = F.when(mine, F.substr(piece, F.lit(len(mark) + 1))).otherwise(said)
        return F.struct(piece.alias("piece"), role.alias("role"), unescape(said).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def read_loss(formatted: str, turns: str) -> Column:
    """All text under the loss mask, unescaped, one string for each turn."""
    pieces = F.split(F.col(formatted), "|".join(map(_quoted, Template().closing)), -1)
    return F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(turns)).alias("piece"), F.col(turns).alias("turn")), lambda x: unescape(
        F.substr(x.piece, (x.turn.loss_start - x.turn.start + 1).cast("int"), (x.turn.loss_end - x.turn.loss_start).cast("int"))))


def chains(rows: DataFrame) -> DataFrame:
    """Conversations as reply trees: each turn answers the one before it.

    ``rows`` has conv_id, turn, role and text; turns that tie are ordered by
    role and text, null turns come first, rows without conv_id are one
    conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    name = lambda place: F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), place.cast("string"))
    placed = rows.select("conv_id", "turn", "role", "text").withColumn("place", F.row_number().over(order))
    return placed.select(name(F.col("place")).alias("message_id"), F.when(F.col("place") > 1, name(F.col("place") - 1)).alias("parent_id"),
                         "role", "text")


SAID = "</s>[INST] ok [/INST]"


def q_chat(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(SAID).alias("text"))
    done = conversations(chains(rows.unionByName(extra)))
    read, loss = read_turns("formatted"), F.array_join(read_loss("formatted", "turns"), "")
    said = F.transform(read, lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n")))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select(
        F.nullif(F.substring_index("root_id", ":", 1), F.lit("")).cast("long").alias("conv_id"), F.size(read).cast("long").alias("n_turns"),
        digest(F.array_join(said, "")).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
        digest(loss).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for m in Template().marks:
        out = f"replace({out}, '{m}', '{m[0]}\\{m[1:]}')"
    return out


_MARKED = Template().roles
SQL_CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{SAID}'), (-7, 1, 'assistant', '{SAID}')),
e AS (SELECT *, {_escaped_sql('text')} AS t, {_escaped_sql('role')} AS r FROM c),
f AS (SELECT *, CASE {' '.join(f"WHEN role = '{k}' THEN '{a}' || t || '{b}'" for k, (a, b) in _MARKED.items())}
  ELSE '{Template().other[0]}' || r || '{Template().other[1]}' || t || '{Template().other[2]}' END AS piece FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""
