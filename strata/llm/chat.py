"""Chat formatting of reply trees (DataFrame functions only).

Messages name their parent. Root-to-leaf paths come from iterative self-joins
that double their reach: a table of jumps holds each message's ancestor 2^k
steps up, and every round joins the open ends of the paths with it, so a path
of length L takes log2(L) rounds. The branches of a conversation are ranked
by score, the mean score of a path's messages, and each chosen path becomes
one formatted conversation:

    <turn ROLE>\nTEXT</turn>\n   for every turn

Inside roles and texts ``\\``, ``<``, ``>`` and ``#`` become ``\\b``, ``\\l``,
``\\g`` and ``\\h``, so neither the marks nor any ``###`` header of other
templates can occur there, and reading back restores every text exactly. The
loss mask lists the spans of assistant texts in the formatted string.

Edge cases: null texts and roles are empty; a message whose parent is unknown
or null starts a path; messages on a cycle of parents have no root and are
left out; rows that repeat a turn follow each other in the order of role and
text; of messages that repeat a node the first by parent (null first), role,
text and score stays, and messages without a node are left out; a conversation
without messages does not exist; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import running, staged

END = "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("#", "\\h"))


def escape(col):
    for raw, mark in ESCAPES:
        col = F.replace(col, F.lit(raw), F.lit(mark))
    return col


def unescape(col):
    for raw, mark in reversed(ESCAPES):
        col = F.replace(col, F.lit(mark), F.lit(raw))
    return col


def chain(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows in turn order as a tree with one branch: (conv, node, parent, role, text)."""
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                                F.coalesce(text_col, F.lit("")).alias("text"))
    node = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")).cast("long")
    return rows.withColumn("node", node).select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text")


def paths(messages: DataFrame) -> DataFrame:
    """``messages`` (conv, node, parent) -> (conv, leaf, node, up): every root-to-leaf path, ``up`` steps above its leaf.

    Of rows that repeat a node the one with the smallest parent counts (null first);
    null conversations are one, and messages without a node are left out.
    """
    tree = messages.where(F.col("node").isNotNull()).groupBy("conv", "node").agg(F.min(F.struct("parent")).alias("p"))
    tree = staged(tree.select("conv", "node", "p.parent"), "chat-tree")
    known = tree.select(F.col("conv").alias("c"), F.col("node").alias("n"))
    tree = tree.join(known, tree["conv"].eqNullSafe(known["c"]) & (tree["parent"] == known["n"]), "left")
    tree = staged(tree.select("conv", "node", F.when(F.col("n").isNotNull(), F.col("parent")).alias("parent")), "chat-links")
    inner = tree.where("parent is not null").select(F.col("conv").alias("c"), F.col("parent").alias("n")).distinct()
    leaves = tree.join(inner, tree["conv"].eqNullSafe(inner["c"]) & (tree["node"] == inner["n"]), "left_anti")
    steps = leaves.select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    jumps, reach = tree.where("parent is not null").select("conv", "node", F.col("parent").alias("to")), 1
    longest = tree.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    done, jumps = staged(steps, "chat-paths"), staged(jumps, "chat-jumps")
    while not jumps.isEmpty():
        if reach > longest:  # ancestors without end: these paths run into a cycle
            rooted = _ends(done, tree.where("parent is null"))
            return done.join(rooted, done["conv"].eqNullSafe(rooted["c"]) & (done["leaf"] == rooted["l"]), "left_semi")
        further = _follow(done, jumps).select("conv", "leaf", F.col("to").alias("node"), (F.col("up") + reach).alias("up"))
        done = staged(done.unionAll(further), "chat-paths")
        other = jumps.select(F.col("conv").alias("c"), F.col("node").alias("n"), F.col("to").alias("next"))
        longer = jumps.join(other, jumps["conv"].eqNullSafe(other["c"]) & (jumps["to"] == other["n"]))
        jumps, reach = staged(longer.select("conv", "node", F.col("next").alias("to")), "chat-jumps"), reach * 2
    return done


def _ends(steps: DataFrame, roots: DataFrame) -> DataFrame:
    r = roots.select(F.col("conv").alias("rc"), F.col("node").alias("rn"))
    found = steps.join(r, steps["conv"].eqNullSafe(r["rc"]) & (steps["node"] == r["rn"]))
    return found.select(F.col("conv").alias("c"), F.col("leaf").alias("l")).distinct()


def _follow(steps: DataFrame, jumps: DataFrame) -> DataFrame:
    j = jumps.select(F.col("conv").alias("c"), F.col("node").alias("n"), "to")
    return steps.join(j, steps["conv"].eqNullSafe(j["c"]) & (steps["node"] == j["n"]))


def first_of_node(messages: DataFrame) -> DataFrame:
    """``messages`` (staged) with one row per conversation and node. Texts move only for nodes that repeat."""
    again = messages.groupBy("conv", "node").count().where("count > 1").select(F.col("conv").alias("c"), F.col("node").alias("n"))
    again = staged(again, "chat-repeats")
    same = messages["conv"].eqNullSafe(again["c"]) & (messages["node"] == again["n"])
    order = Window.partitionBy("conv", "node").orderBy("parent", "role", "text", "score")
    first = messages.join(again, same, "left_semi").withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")
    return messages.join(again, same, "left_anti").unionByName(first)


def format_trees(messages: DataFrame, best: int | None = None, learn_role: str = "assistant") -> DataFrame:
    """``messages`` (conv, node, parent, role, text, optionally score double) ->
    (conv, leaf, rank, score, n_turns, formatted, loss_spans): one row per chosen path.

    ``best`` paths of a conversation are formatted, by descending mean score
    and then the smaller leaf; None formats all. ``loss_spans`` are (start,
    length) in code points of the formatted string, start from 0.
    """
    if "score" not in messages.columns:
        messages = messages.withColumn("score", F.lit(0.0))
    body = first_of_node(staged(messages.where(F.col("node").isNotNull()).select("conv", "node", "parent", "score", F.coalesce("role", F.lit("")).alias("role"),
                                  F.coalesce("text", F.lit("")).alias("text")), "chat-messages"))
    steps = paths(body)
    m = body.select(F.col("conv").alias("c"), F.col("node").alias("n"), F.coalesce("score", F.lit(0.0)).alias("score"), "role", "text")
    if best is not None:  # branches are ranked without their texts
        scores = m.select("c", "n", "score")
        scored = steps.join(scores, steps["conv"].eqNullSafe(scores["c"]) & (steps["node"] == scores["n"]))
        means = scored.groupBy("conv", "leaf").agg(F.avg("score").alias("mean"))
        order = Window.partitionBy("conv").orderBy(F.desc("mean"), "leaf")
        chosen = staged(means.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best), "chat-ranks")
        r = chosen.select(F.col("conv").alias("c"), F.col("leaf").alias("l"), "rank")
        steps = steps.join(r, steps["conv"].eqNullSafe(r["c"]) & (steps["leaf"] == r["l"])).drop("c", "l")
    else:
        steps = steps.withColumn("rank", F.lit(None).cast("int"))
    joined = steps.join(m, steps["conv"].eqNullSafe(m["c"]) & (steps["node"] == m["n"])).drop("c", "n")
    head = F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">\n"))
    said = escape(F.col("text"))
    piece = F.struct((-F.col("up")).alias("at"), F.concat(head, said, F.lit(END)).alias("turn"), F.length(head).alias("skip"),
                     F.length(said).alias("said"), (F.col("role") == learn_role).alias("learn"))
    turns = joined.groupBy("conv", "leaf").agg(F.first("rank").alias("rank"), F.avg("score").alias("score"), F.sort_array(F.collect_list(piece)).alias("t"))
    if best is None:
        turns = turns.withColumn("rank", F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("score"), "leaf")))
    turns = turns.withColumn("ends", running(F.transform("t", lambda x: F.length(x["turn"]).cast("long"))))
    spans = F.zip_with("t", "ends", lambda x, end: F.when(x["learn"], F.struct(
        (end - F.length(x["turn"]) + x["skip"]).alias("start"), x["said"].cast("long").alias("length"))))
    return turns.select("conv", "leaf", "rank", "score", F.size("t").cast("long").alias("n_turns"),
                        F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"), F.filter(spans, lambda x: x.isNotNull()).alias("loss_spans"))


def read_turns(formatted):
    """Formatted conversation -> array of (role, text)."""
    turns = F.filter(F.split(formatted, "</turn>\n", -1), lambda x: x != "")
    return F.transform(turns, lambda x: F.struct(
        unescape(F.regexp_extract(x, r"\A<turn ([^>]*)>\n", 1)).alias("role"),
        unescape(F.regexp_replace(x, r"\A<turn [^>]*>\n", "")).alias("text")))


def learned_texts(formatted, spans):
    """The texts under the loss mask, restored, in order."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
