"""Conversations for training from trees of replies.

Messages name the message they reply to. Iterative self-joins that double the number
of replies they cover give every message its distance from the root and the scores on
the way, in a number of rounds that grows with the logarithm of the depth. The leaves
of a tree are ranked by the mean score of their paths, and each chosen path becomes one
conversation. These rounds only carry ids and scores.

Texts are shuffled once, to their tree, where the path picks them by number. Trees of
more than TREE_ROWS messages are not gathered: their path is joined to the messages,
so that only the chosen path comes together, as its one row of output requires.

The template marks each turn by its role and closes it: ``<s>[INST]question[/INST]
[REPLY]answer</s>`` (without the line break). Control strings inside a text get a
backslash behind their bracket, one more if there already are some, so that reading
back removes what was added and nothing else. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written
from .quality import _bound

TREE_ROWS = 1_000

START, END = "<s>", "</s>"
# Role: the name in its marks. Any other role is written in hexadecimal digits.
TAGS = {"system": "SYS", "user": "INST", "assistant": "REPLY"}
OTHER = "ROLE"
LEARNED = "assistant"
_CONTROL = r"/?(?:s>|SYS\]|INST\]|REPLY\]|ROLE\]|ROLE )"
ESCAPED = rf"([\[<])(\\*)({_CONTROL})"
_OPENS = r"\[(?:SYS|INST|REPLY|ROLE [0-9A-F]*)\]"


# ---- template


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<])\\(\\*{_CONTROL})", "$1$2")


def _by_role(role: Column, known: dict[str, Column], other: Column) -> Column:
    out = other
    for name, value in known.items():
        out = F.when(role == name, value).otherwise(out)
    return out


def _parts(turn: Column) -> Column:
    role, text = turn["role"], turn["text"]
    tags = {name: F.lit(f"[{tag}]") for name, tag in TAGS.items()}
    opened = _by_role(role, tags, F.concat(F.lit(f"[{OTHER} "), F.hex(role.cast("binary")), F.lit("]")))
    ends = {name: F.lit(END if name == LEARNED else f"[/{tag}]") for name, tag in TAGS.items()}
    return F.struct(
        opened.alias("opens"),
        escape(text).alias("body"),
        _by_role(role, ends, F.lit(f"[/{OTHER}]")).alias("ends"),
        (role == LEARNED).alias("learned"),
    )


def _spans(parts: Column) -> Column:
    """Where the texts to learn are, as code points of the formatted text."""
    none = F.expr("array() :: array<struct<start:bigint,end:bigint>>")

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["opens"])
        end = start + F.length(part["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(
            (end + F.length(part["ends"])).alias("at"),
            F.concat(acc["spans"], F.when(part["learned"], F.array(span)).otherwise(none)).alias("spans"),
        )

    begin = F.struct(F.lit(len(START)).cast("bigint").alias("at"), none.alias("spans"))
    return F.aggregate(parts, begin, step, lambda acc: acc["spans"])


def formatted(rows: DataFrame, turns: str = "turns") -> DataFrame:
    """Add ``formatted`` and its ``loss`` mask, the spans of the assistant's texts, to
    rows of ``turns`` (role, text; neither null). No turns give the start mark alone."""
    parts = rows.withColumn("_parts", F.transform(turns, _parts))
    one = lambda p: F.concat(p["opens"], p["body"], p["ends"])
    return parts.withColumns(
        {
            "formatted": F.concat(F.lit(START), F.array_join(F.transform("_parts", one), "")),
            "loss": _spans(F.col("_parts")),
        }
    ).drop("_parts")


def turns_of(text: Column) -> Column:
    """The turns (role, text) of a formatted text."""

    def turn(piece: Column) -> Column:
        head = F.regexp_extract(piece, f"^{_OPENS}", 0)
        tag = F.substring_index(F.substr(head, F.lit(2), F.length(head) - 2), " ", 1)
        role = F.unhex(F.substr(head, F.lit(len(OTHER) + 3), F.length(head) - len(OTHER) - 3)).cast("string")
        ends = F.length(tag) + 3
        for name, known in TAGS.items():
            role = F.when(tag == known, F.lit(name)).otherwise(role)
        ends = F.when(tag == TAGS[LEARNED], F.lit(len(END))).otherwise(ends)
        body = F.substr(piece, F.length(head) + 1, F.length(piece) - F.length(head) - ends)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    pieces = F.split(text, f"(?={_OPENS})")
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def learned_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, in order and as it was written."""
    inside = lambda s: unescape(F.substr(text, s["start"] + 1, s["end"] - s["start"]))
    return F.array_join(F.transform(loss, inside), "")


# ---- trees


def _key(col: Column) -> Column:
    """Text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("?"))


def _messages(messages: DataFrame, tree: str, message: str, parent: str, score: str, role: str, text: str) -> DataFrame:
    c = lambda name: F.col(f"`{name}`")
    shown = [F.coalesce(c(x).cast("string"), F.lit("")) for x in (role, text)]
    unnamed = F.concat(F.lit("?"), F.sha2(F.to_json(F.struct(c(parent).cast("string").alias("p"), *shown)), 256))
    return messages.select(
        _key(c(tree)).alias("key"),
        c(tree).alias("tree"),
        F.coalesce(F.concat(F.lit("="), c(message).cast("string")), unnamed).alias("id"),
        F.concat(F.lit("="), c(parent).cast("string")).alias("up"),
        F.coalesce(c(score).cast("double"), F.lit(0.0)).alias("score"),
        shown[0].alias("role"),
        shown[1].alias("text"),
    )


def _turn_messages(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows by turn as messages that each reply to the one before. Texts in one turn are
    ordered by role and hash; the ids need no text, so a reader of ids does not shuffle any."""
    c = lambda name: F.col(f"`{name}`")
    shown = {x: F.coalesce(c(name).cast("string"), F.lit("")) for x, name in (("role", role), ("text", text))}
    named = rows.select(
        _key(c(conversation)).alias("key"), c(conversation).alias("tree"), c(turn).alias("turn"),
        *[v.alias(k) for k, v in shown.items()], F.xxhash64(shown["text"]).alias("hash"),
    )
    at = F.row_number().over(Window.partitionBy("key").orderBy("turn", "role", "hash"))
    numbered = named.withColumn("at", at)
    return numbered.select(
        "key", "tree", F.concat(F.lit("="), "at").alias("id"),
        F.when(F.col("at") > 1, F.concat(F.lit("="), F.col("at") - 1)).alias("up"),
        F.lit(0.0).alias("score"), "role", "text",
    )


def _climbed(ids: DataFrame, deepest: int) -> tuple[list[DataFrame], DataFrame]:
    """The ways up, table k with the message 2^k replies above (key, id, up), and all
    messages that have a root with ``n`` messages and the scores up to it.

    A round only joins the messages that are still on their way, so its rows become
    fewer as shallow trees are done. Messages that reply in a circle never are.
    """
    there = ids.select("key", F.col("id").alias("up")).withColumn("there", F.lit(True))
    now = written(
        ids.join(there, ["key", "up"], "left").select(
            "key", "id", F.when(F.col("there"), F.col("up")).alias("up"), F.lit(1).alias("n"), F.col("score").alias("total")
        ),
        "replies",
    )
    ways, settled = [], now.where("up IS NULL")
    while True:
        ways.append(now.where("up IS NOT NULL"))
        if 2 ** (len(ways) - 1) > deepest or ways[-1].isEmpty():
            return ways, settled
        ahead = ways[-1].unionByName(settled).select(
            "key", F.col("id").alias("up"), F.col("up").alias("next"), F.col("n").alias("n2"), F.col("total").alias("total2")
        )
        now = written(
            ways[-1].join(ahead, ["key", "up"]).select(
                "key", "id", F.col("next").alias("up"),
                (F.col("n") + F.col("n2")).alias("n"), (F.col("total") + F.col("total2")).alias("total"),
            ),
            "replies",
        )
        settled = settled.unionByName(now.where("up IS NULL"))


def _paths(ids: DataFrame, sizes: DataFrame, top: int | None) -> DataFrame:
    """Messages of the chosen paths: (key, leaf, rank, mean, pos, id), pos from 1."""
    deepest = sizes.agg(F.max("m")).first()[0] or 0
    ways, settled = _climbed(ids, deepest)
    settled = written(settled, "rooted")
    answered = ways[0].select("key", F.col("up").alias("id"))
    ranked = Window.partitionBy("key").orderBy(F.desc("mean"), "id")
    leaves = (
        settled.join(answered, ["key", "id"], "left_anti")
        .select("key", "id", "n", (F.col("total") / F.col("n")).alias("mean"))
        .withColumn("rank", F.row_number().over(ranked))
    )
    leaves = written(leaves if top is None else leaves.where(F.col("rank") <= top + 1), "leaves")
    forked = written(leaves.where("rank > 1").select("key").distinct(), "forked-trees")
    chosen = leaves if top is None else leaves.where(F.col("rank") <= top)
    chosen = chosen.select("key", F.col("id").alias("leaf"), "rank", "mean", F.col("n").alias("pos"))
    # A tree with one leaf is one path, which holds every message that has a root.
    alone = chosen.drop("pos").join(forked, "key", "left_anti")
    found = settled.select("key", "id", F.col("n").alias("pos")).join(alone, "key")
    columns = ["key", "leaf", "rank", "mean", "pos", "id"]
    found = found.select(*columns)
    if forked.isEmpty():
        return found
    rows = written(chosen.join(forked, "key", "left_semi").withColumn("id", F.col("leaf")).select(*columns), "paths")
    for k in reversed(range(len(ways))):  # all offsets, as sums of powers of two
        above = ways[k].select("key", "id", "up")
        further = rows.join(above, ["key", "id"]).select(
            "key", "leaf", "rank", "mean", (F.col("pos") - 2**k).alias("pos"), F.col("up").alias("id")
        )
        rows = written(rows.unionByName(further), "paths")
    return found.unionByName(rows)


def _first_of_each(turns: Column) -> Column:
    """Of sorted turns that share an id, the first."""
    again = lambda a: F.filter(
        a, lambda x, i: (i == 0) | (F.get(a, i - 1)["id"] != x["id"])
    )
    return _bound(turns, again)


def _chosen_turns(messages: DataFrame, top: int | None, tree_rows: int) -> DataFrame:
    ids = written(messages.groupBy("key", "id").agg(F.min(F.struct("up", "score")).alias("r")).select("key", "id", "r.*"), "message-ids")
    sizes = written(ids.groupBy("key").agg(F.count("*").alias("m")), "tree-sizes")
    paths = written(_paths(ids, sizes, top), "chosen-paths")
    small, large = sizes.where(F.col("m") <= tree_rows).select("key"), sizes.where(F.col("m") > tree_rows).select("key")
    path = ["key", "leaf", "rank", "mean"]

    number = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    numbered = ids.join(small, "key", "left_semi").select("key", "id", number.alias("number"))
    orders = (
        paths.join(numbered, ["key", "id"])
        .groupBy(*path)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "number"))).alias("order"))
    )
    gathered = (
        messages.join(small, "key", "left_semi")
        .groupBy("key", "tree")
        .agg(F.sort_array(F.collect_list(F.struct("id", "role", "text"))).alias("said"))
        .withColumn("said", _first_of_each(F.col("said")))
    )
    picked = F.transform("order", lambda o: F.element_at(F.col("said"), o["number"]).dropFields("id"))
    out = gathered.join(written(orders, "path-orders"), "key").select("tree", "leaf", "rank", "mean", picked.alias("turns"))
    if large.isEmpty():
        return out
    of_large = paths.join(large, "key", "left_semi")
    said = messages.join(large, "key", "left_semi").groupBy("key", "tree", "id").agg(F.min(F.struct("role", "text")).alias("turn"))
    joined = said.join(of_large, ["key", "id"]).groupBy("tree", *path)
    by_place = F.sort_array(F.collect_list(F.struct("pos", "turn")))
    gathered = joined.agg(F.transform(by_place, lambda t: t["turn"]).alias("turns"))
    return out.unionByName(gathered.select(*out.columns))


def reply_paths(
    messages: DataFrame,
    tree: str = "tree",
    message: str = "message_id",
    parent: str = "parent_id",
    score: str = "score",
    role: str = "role",
    text: str = "text",
    top: int | None = 1,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """The ``top`` best paths of each tree (all without a number), formatted: ``tree``,
    ``leaf`` (id as text), ``rank`` (1 is best), ``mean`` score, ``turns``, ``formatted``
    and ``loss``.

    Paths rank by the mean score of their messages, ties by the leaf's id as text; no
    score counts as zero. A message whose parent is absent or not in its tree is a root.
    Messages that reply in a circle, or below one, have no root and are on no path. Of
    rows that repeat a message id within a tree, the smallest parent and score and the
    smallest role and text count. Messages without an id are told apart by their
    content and cannot be replied to. A null tree is a tree, null roles and texts are
    empty. Without messages there are no rows. Other columns are ignored.
    """
    known = _messages(messages, tree, message, parent, score, role, text)
    chosen = _chosen_turns(known, top, tree_rows)
    named = F.when(F.col("leaf").startswith("="), F.substr("leaf", F.lit(2)))
    return formatted(chosen.withColumn("leaf", named))


def conversations(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """Rows by turn as one formatted conversation each: ``conv_id``, ``turns``,
    ``formatted`` and ``loss``. Each row replies to the one before, null turns first;
    rows of one turn follow each other by role, then text hash, and repeated rows stay.
    Nulls and other columns as in ``reply_paths``."""
    known = _turn_messages(rows, conversation, turn, role, text)
    chosen = _chosen_turns(known, 1, tree_rows).select(F.col("tree").alias("conv_id"), "turns")
    return formatted(chosen)
