"""Chat formatting: reply trees to conversations, with a loss mask.

Paths come from iterated self-joins that double their reach each round, so a tree of depth
d takes log2(d) joins. A node's path score is the sum of scores from the root; the best
leaves of each conversation are formatted, one text per path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.common import null_safe
from reelmart.session import cut_lineage

# Fixed values of the template. Escaping leaves no "<", "[" or "]" in a text, hence no control string.
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("]", "~3"))
TURN_START, ROLE_END, TURN_END = "<s>[", "]\n", "</s>"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reply_paths(messages: DataFrame, per_conversation: int = 1) -> DataFrame:
    """``conv_id, leaf, node, back``: the nodes of the chosen root-to-leaf paths.

    ``messages`` has ``conv_id, node, parent, score``; node is unique in a conversation.
    ``back`` is the distance from the leaf. A parent that is not there makes a root, nodes
    on a reply cycle have no root and are left out, NULL scores count 0, equal scores go
    to the smaller leaf.
    """
    nodes = messages.select("conv_id", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = nodes.select("conv_id", F.col("node").alias("parent"), F.lit(True).alias("known"))
    first = null_safe(nodes, known, ["conv_id", "parent"], "left").withColumn("up", F.when(F.col("known"), F.col("parent")))
    level = cut_lineage(first.select("conv_id", "node", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"), "score"), "replies")
    levels: list[DataFrame] = []
    rooted = [level.filter("up IS NULL").drop("up")]
    open_before = None
    while (still_open := level.filter("up IS NOT NULL").count()) and still_open != open_before:
        # A parent is either done itself (a root so far) or still open; only open nodes are carried on.
        reaching = level.filter("up IS NOT NULL")
        levels.append(reaching.select("conv_id", "node", "up"))
        done = rooted[0] if len(rooted) == 1 else rooted[0].unionByName(rooted[1])
        sides = reaching.unionByName(done.withColumn("up", F.lit(None).cast(dict(level.dtypes)["up"])), allowMissingColumns=True)
        further = sides.select("conv_id", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("score").alias("score2"))
        joined = null_safe(reaching, further, ["conv_id", "up"])
        level = cut_lineage(
            joined.select("conv_id", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("score") + F.col("score2")).alias("score")),
            "replies",
        )
        rooted = [done, level.filter("up IS NULL").drop("up")]
        open_before = still_open
    ends = rooted[0] if len(rooted) == 1 else rooted[0].unionByName(rooted[1])
    parents = messages.select("conv_id", F.col("parent").alias("node")).distinct().withColumn("is_parent", F.lit(True))
    leaves = null_safe(ends, parents, ["conv_id", "node"], "left").filter("is_parent IS NULL")
    best = Window.partitionBy("conv_id").orderBy(F.desc("score"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= per_conversation)
    here = chosen.select("conv_id", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("back"), F.col("depth").alias("left"))
    paths = cut_lineage(here, "paths") if levels else here
    for k in reversed(range(len(levels))):
        # A node with at least 2^k ancestors brings in its 2^k-th; each distance has one binary form, so nothing comes twice.
        met = null_safe(paths.filter(F.col("left") >= (1 << k)), levels[k], ["conv_id", "node"])
        up = met.select("conv_id", "leaf", "rank", F.col("up").alias("node"), (F.col("back") + (1 << k)).alias("back"), (F.col("left") - (1 << k)).alias("left"))
        paths = cut_lineage(paths.unionByName(up), "paths") if k else paths.unionByName(up)
    return paths.drop("left")


def formatted_conversations(messages: DataFrame, per_conversation: int = 1, learn_from: str = "assistant") -> DataFrame:
    """``conv_id, leaf, rank, n_turns, formatted, loss_spans``: one text per chosen path.

    ``messages`` has ``conv_id, node, parent, role, text, score``. NULL text and NULL role
    are empty. ``loss_spans`` are the (start, length) in code points of the bodies of
    ``learn_from`` turns. A conversation is one output row, so its turns meet in one task.
    """
    paths = reply_paths(messages, per_conversation)
    body = messages.select(
        "conv_id",
        "node",
        F.coalesce("role", F.lit("")).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"),
    )
    turns = null_safe(paths, body, ["conv_id", "node"])
    turns = turns.withColumn("head", F.concat(F.lit(TURN_START), escaped(F.col("role")), F.lit(ROLE_END)))
    turns = turns.withColumn("turn_text", F.concat("head", "body", F.lit(TURN_END)))
    in_order = Window.partitionBy("conv_id", "leaf").orderBy(F.desc("back"))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn_text")).over(before), F.lit(0)) + F.length("head")
    turns = turns.withColumn("start", start.cast("long"))
    one = F.struct((-F.col("back")).alias("at"), "role", "turn_text", "start", F.length("body").cast("long").alias("length"))
    whole = turns.groupBy("conv_id", "leaf", "rank").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    learnt = F.filter("turns", lambda t: t["role"] == F.lit(learn_from))
    return whole.select(
        "conv_id",
        "leaf",
        "rank",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["turn_text"]), "").alias("formatted"),
        F.transform(learnt, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
    )


def linear_replies(conversations: DataFrame) -> DataFrame:
    """Turns as a reply tree without branches: each row answers the one before it.

    Rows are ordered by turn, role and text (NULLs first), so repeated turns all stay.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("conv_id", "node", parent.alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_text``, both parsed from the formatted text alone."""
    pieces = F.split("formatted", TURN_END, -1)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    head = lambda p: F.substring_index(p, ROLE_END, 1)
    role = lambda p: unescaped(F.substr(head(p), F.lit(len(TURN_START) + 1)))
    text = lambda p: unescaped(F.substr(p, F.length(head(p)) + F.lit(len(ROLE_END) + 1)))
    turns = F.transform(pieces, lambda p: F.struct(role(p).alias("role"), text(p).alias("text")))
    cut = lambda s: F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(cut(s))), "")
    return formatted.withColumns({"turns": turns, "loss_text": loss})


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """The digest columns of each conversation, read back from its formatted text."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
