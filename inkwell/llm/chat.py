"""Chat formatting of reply trees. DataFrame functions only.

Messages form trees (tree, node, parent). Root-to-leaf paths are enumerated by iterative
self-joins that double the reach of each node's pointer, so a tree of depth d takes log2(d) joins; branches
are ranked by the sum of their scores; and each chosen path becomes one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. A control string inside a text
gets one backslash after its first character (one more, if it has some already), and unescaping takes
one away; in a role, backslash and newline are escaped. The loss mask lists the byte ranges of
the assistant texts in the formatted conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import drop, store

# fixed values: control strings of common chat templates; a text never shows them bare
CONTROL = (("<", r"(/?s>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)"), ("\\[", r"(/?INST\])"))
START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """One more backslash after the first character of every control string."""
    for first, rest in CONTROL:
        text = F.regexp_replace(text, f"{first}(\\\\*){rest}", f"{first}\\\\$1$2")
    return text


def unescape(text: Column) -> Column:
    """One backslash less."""
    for first, rest in CONTROL:
        text = F.regexp_replace(text, f"{first}\\\\(\\\\*){rest}", f"{first}$1$2")
    return text


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """Splits at backslash pairs first, so that a pair before an n stays a backslash and an n."""
    return F.array_join(F.transform(F.split(unescape(role), r"\\\\", -1),
                                    lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Chosen root-to-leaf paths: tree, path (1 is best), depth, and each node's columns on the path.

    ``messages``: tree, node, parent (null at a root), score, role, text. Of rows that repeat a (tree, node) the smallest
    (parent, score, role, text) stays, nulls first; a row without node is left out; a null tree is a tree of its own. A node
    whose parent is missing is a root; a cycle has no leaf and gives no path; a null score is 0. Ties
    of the summed score go to the smaller leaf. Other columns are ignored; no rows give no paths. Every leaf's depth and sum are found by pointer
    doubling; the same pointers, from the longest reach down, lead from chosen leaves to their ancestors.
    """
    said = F.struct("parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), "role", "text")
    m = (messages.where("node IS NOT NULL").groupBy("tree", "node").agg(F.min(said).alias("said"))
         .select("tree", "node", "said.*"))
    ids = m.select(F.col("tree").alias("t2"), F.col("node").alias("n2"))
    link = m.select("tree", "node", "parent", "score").join(
        ids, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("parent") == F.col("n2")), "left")
    reach = store(link.select("tree", "node", F.col("n2").alias("up"), F.lit(1).alias("depth"),
                              F.col("score").alias("sum")), "reach")
    steps = [reach]
    limit = reach.count().bit_length() + 1
    while len(steps) <= limit and not reach.where("up IS NOT NULL").isEmpty():
        above = reach.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), F.col("up").alias("up2"),
                             F.col("depth").alias("d2"), F.col("sum").alias("s2"))
        going = reach.where("up IS NOT NULL")  # nodes that have reached their root stay as they are
        further = (going.join(above, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("up") == F.col("n2")))
                   .select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"),
                           (F.col("sum") + F.col("s2")).alias("sum")))
        reach = store(reach.where("up IS NULL").unionByName(further), "reach")
        steps.append(reach)
    parents = m.where("parent IS NOT NULL").select(F.col("tree").alias("t2"), F.col("parent").alias("p2")).distinct()
    leaves = (reach.where("up IS NULL")
              .join(parents, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("p2")), "left_anti"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("sum"), "node"))
    on_path = store(leaves.withColumn("path", rank).where(F.col("path") <= branches)
                    .select("tree", "path", "node", "depth"), "paths")
    for step in reversed(steps):
        hop = step.where("up IS NOT NULL").select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "up",
                                                  F.col("depth").alias("hop"))
        higher = (on_path.join(hop, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")))
                  .select("tree", "path", F.col("up").alias("node"), (F.col("depth") - F.col("hop")).alias("depth")))
        on_path = store(on_path.unionByName(higher).distinct(), "paths")
    drop(*steps)
    return (on_path.join(m.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "role", "text"),
                         F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")))
            .select("tree", "path", "depth", "node", "role", "text"))


def format_paths(paths: DataFrame) -> DataFrame:
    """One conversation per (tree, path): formatted string and loss mask (byte ranges start, size).

    Null role or text is formatted as empty; an empty text is a turn like any other; texts are taken whole, however long.
    Rows that repeat a (tree, path, depth) stand in the order of their nodes. Other columns are ignored; no rows give none.
    A conversation is one output row, so its turns meet in one group; that is the size of the result itself.
    """
    head = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turns = paths.select("tree", "path", "depth", "node", F.coalesce("role", F.lit("")).alias("role"),
                         head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"))
    size = F.octet_length("head") + F.octet_length("body") + len(END)
    before = Window.partitionBy("tree", "path").orderBy("depth", "node").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)))
    span = F.when(F.col("role") == LOSS_ROLE, F.struct(
        (F.col("at") + F.octet_length("head")).alias("start"), F.octet_length("body").cast("long").alias("size")))
    rows = placed.select("tree", "path", F.struct(
        F.col("at"), F.concat("head", "body", F.lit(END)).alias("s"), span.alias("span")).alias("turn"))
    grouped = rows.groupBy("tree", "path").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return grouped.select("tree", "path", F.array_join("turns.s", "").alias("formatted"),
                          F.filter("turns.span", lambda x: x.isNotNull()).alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    parts = F.slice(F.split(formatted, r"\Q<|im_end|>\E\n", -1), 1, 1 << 30)
    return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.struct(
        unescape_role(F.substring_index(F.substring(p, F.lit(len(START) + 1), F.length(p)), "\n", 1)).alias("role"),
        unescape(F.regexp_replace(p, r"\A[^\n]*\n", "")).alias("text")))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, concatenated."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.decode(
        F.substring(formatted.cast("binary"), (s["start"] + 1).cast("int"), s["size"].cast("int")), "UTF-8"))), "")


def chain(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations (conv_id, turn, role, text): each turn answers the one before it.

    Null turns come first; rows of one turn are ordered by role, then text, nulls first, and repeated rows are turns of
    their own; rows without conv_id form one conversation; other columns are ignored; no rows give none.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    row = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order))
    return row.select(F.col("conv_id").alias("tree"), F.col("node").cast("long").alias("node"),
                      F.when(F.col("node") > 1, F.col("node") - 1).cast("long").alias("parent"),
                      F.lit(0.0).alias("score"), "role", "text")


def digest(conversations: DataFrame) -> DataFrame:
    """Columns read back from formatted conversations: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.

    A conversation without assistant turn has the empty string's hash and no characters under its mask; a null tree is a null
    conv_id; null roles and texts, which are formatted as empty, read back as empty; no rows give none.
    """
    back = conversations.select("tree", "path", "formatted", "loss_mask",
                                read_turns(F.col("formatted")).alias("turns"),
                                read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
