"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Its key is a SHA-256 digest that every conversation finds for itself, in
chunks of ``CHUNK`` turns: running digests inside a chunk, and the same again over the digests of the full
chunks before it, so that a conversation of any length is never one group.

Totals go up the trie by contraction, in rounds of joins:

* *rake*: every node without children leaves and adds its totals to its parent;
* *compress*: of the nodes with one child, an independent set (those whose priority beats their neighbours' in the
  chain) is spliced out: the child moves up to the grandparent, which takes over what the node holds by itself.

A node keeps the exclusive or of its children's ids, which *is* the child once one is left: each join of a round
is on ids that are unique on both sides. Rounds grow with the logarithm of the trie, also where it is one long chain, and
their tables shrink geometrically. Then the rounds are undone in reverse: a spliced node's total is what
it held plus the total of its child, which is known by then.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import drop, numbered, row_id, small_batches, store

CHUNK = 64      # turns whose running digests are one array
SHARED = 100    # conversations whose ids lie in one such range share the first one's head
HEADS = 6       # heads have fewer turns than this
RUN = 4096      # conversation ids joined to one string before they are hashed
ROOT = ""       # key of the root


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), n (turns of the conversation), x (digest of role and text), chars (code points of the text).

    A null turn comes first; equal turns are ordered by their digest; a null role or text is empty; rows without a
    conv_id belong to no conversation and are left out; other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    x = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = store(row_id(conversations.where("conv_id IS NOT NULL"), F.col("conv_id").alias("tree"), "turn", x.alias("x"),
                        F.length(text).cast("long").alias("chars")), "turns")
    return numbered(rows, ["turn", "x", "__rid"]).select(F.col("tree").alias("conv_id"), "pos", "n", "x", "chars")


def share_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with their range's head: rows (conv_id, pos, x, chars, len) and members (conv_id, len).

    Conversation c takes the first h turns of c - c % SHARED (all, if it has fewer; none, if there is none) and its own
    turns after its first h; h = crc32(c) % HEADS. The remainder is that of SQL (negative for a negative id).
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = turns.where("pos = 0").select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"))
    first = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    members = store(convs.join(first, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("head"),
        (F.least("h", F.coalesce("base_n", F.lit(0))) + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "members")
    head = turns.where((F.col("conv_id") % SHARED == 0) & (F.col("pos") < HEADS)).select(
        F.col("conv_id").alias("base"), "pos", "x", "chars")
    heads = members.join(head, "base").where("pos < head").select("conv_id", "pos", "x", "chars", "len")
    tails = (turns.where(F.col("pos") >= h).join(members, "conv_id")
             .select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "x", "chars", "len"))
    return heads.unionByName(tails), members.select("conv_id", "len")


def prefixes(rows: DataFrame, longest: int) -> DataFrame:
    """``rows`` (conv_id, pos, x and others) with ``key``, the digest of the sequence up to it, and ``parent``, that of the
    sequence before it (ROOT for the first). ``longest``: the most rows of a conversation."""
    others = [c for c in rows.columns if c != "conv_id"]
    running = F.aggregate("items", F.array().cast("array<string>"), lambda acc, s: F.concat(acc, F.array(
        F.sha2(F.concat(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit("")), s["x"]), 256))))
    chunks = (rows.groupBy("conv_id", F.floor(F.col("pos") / CHUNK).alias("q"))
              .agg(F.sort_array(F.collect_list(F.struct(*others))).alias("items")).withColumn("runs", running))
    if longest >= CHUNK:
        chunks = store(chunks, "chunks")
        full = chunks.where(F.size("runs") == CHUNK).select(
            "conv_id", F.col("q").alias("pos"), F.get("runs", CHUNK - 1).alias("x"))
        done = store(prefixes(full, longest // CHUNK).select("conv_id", "pos", "key"), "full")
        chunks = (chunks.join(done.select("conv_id", (F.col("pos") + 1).alias("q"), F.col("key").alias("before")),
                              ["conv_id", "q"], "left")
                  .join(done.select("conv_id", F.col("pos").alias("q"), F.col("key").alias("after")), ["conv_id", "q"], "left"))
    else:
        chunks = chunks.withColumn("before", F.lit(None).cast("string")).withColumn("after", F.lit(None).cast("string"))
    before = F.coalesce("before", F.lit(ROOT))
    each = chunks.select("conv_id", before.alias("before"), "after", "runs", F.posexplode("items").alias("j", "item"))
    upto = lambda j: F.sha2(F.concat("before", F.get("runs", j)), 256)
    return each.select(
        "conv_id", "item.*", F.when(F.col("j") == CHUNK - 1, F.col("after")).otherwise(upto(F.col("j"))).alias("key"),
        F.when(F.col("j") == 0, F.col("before")).otherwise(upto(F.col("j") - 1)).alias("parent"))


def nodes_of(rows: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node: id, key, parent (id), depth, conv_id, parent_conv_id, n_convs, n_children, weight, kids, kid."""
    found = rows.groupBy("key").agg(
        F.min("parent").alias("above"), (F.min("pos") + 1).alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.min("chars").alias("chars"))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("above"), F.lit(0).cast("long").alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    flat = store(found.unionByName(root).select(
        F.monotonically_increasing_id().alias("id"), "*", ((F.col("n_convs") - 1) * F.col("chars")).alias("weight")), "trie")
    # a parent of many children is a hot key of this join alone: both sides are stored tables, which AQE splits
    linked = store(flat.drop("chars").join(flat.select(F.col("key").alias("above"), F.col("id").alias("parent"),
                                                       F.col("conv_id").alias("parent_conv_id")), "above", "left").drop("above"), "linked")
    kids = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
        F.count("*").alias("kids"), F.bit_xor("id").alias("kid"))
    return (linked.join(kids, "id", "left").withColumn("kids", F.coalesce("kids", F.lit(0).cast("long")))
            .withColumn("kid", F.coalesce("kid", F.lit(0).cast("long"))).withColumn("n_children", F.col("kids")))


def priority(node: Column, turn: int) -> Column:
    """Of two neighbours in a chain the greater one may go; ids break ties of the hash."""
    return F.struct(F.xxhash64(node, F.lit(turn)), node)


def contract(nodes: DataFrame) -> tuple[list, DataFrame]:
    """Contract (id, parent, leaves, tokens, kids, kid) to its root. Returns for each round its active nodes and those it
    spliced, and the root's row."""
    active, rounds = store(nodes, "active"), []
    while active.count() > 1:
        turn = len(rounds)
        one = active.where("kids = 1 AND parent IS NOT NULL")
        pairs = one.join(active.select(F.col("id").alias("kid"), F.col("kids").alias("grand")), "kid")
        wins = priority(F.col("id"), turn) > priority(F.col("kid"), turn)
        loses = pairs.where((F.col("grand") == 1) & wins).select(F.col("kid").alias("id"))
        gone = store(pairs.where((F.col("grand") > 1) | (F.col("grand") == 1) & wins).join(loses, "id", "left_anti")
                     .select("id", "parent", "kid", "leaves", "tokens"), "spliced")
        zero = F.lit(0).cast("long")
        change = lambda df, node, leaves, tokens, less, kid, to, out: df.select(
            node.alias("id"), leaves.alias("more_leaves"), tokens.alias("more_tokens"), less.alias("less"), kid.alias("flip"),
            to.cast("long").alias("to"), F.lit(out).alias("gone"))
        col, none = F.col, F.lit(None)
        changes = (
            change(active.where("kids = 0"), col("parent"), col("leaves"), col("tokens"), F.lit(1).cast("long"), col("id"), none, False)
            .unionByName(change(gone, col("parent"), col("leaves"), col("tokens"), zero, col("id").bitwiseXOR(col("kid")), none, False))
            .unionByName(change(gone, col("kid"), zero, zero, zero, zero, col("parent"), False))
            .unionByName(change(gone, col("id"), zero, zero, zero, zero, none, True)))
        change_of = changes.groupBy("id").agg(
            F.sum("more_leaves").alias("more_leaves"), F.sum("more_tokens").alias("more_tokens"), F.sum("less").alias("less"),
            F.bit_xor("flip").alias("flip"), F.max("to").alias("to"), F.max("gone").alias("gone"))
        left = active.where("kids > 0").join(change_of, "id", "left").where("NOT coalesce(gone, false)")
        or0 = lambda c: F.coalesce(c, zero)
        rounds.append((active, gone))
        active = store(left.select(
            "id", F.coalesce("to", "parent").alias("parent"), (col("leaves") + or0("more_leaves")).alias("leaves"),
            (col("tokens") + or0("more_tokens")).alias("tokens"), (col("kids") - or0("less")).alias("kids"),
            col("kid").bitwiseXOR(or0("flip")).alias("kid")), "active")
    return rounds, active


def totals(nodes: DataFrame) -> DataFrame:
    """id, leaves and tokens summed over the subtree of every node."""
    rounds, root = contract(nodes)
    known = root.select("id", "leaves", "tokens")
    for active, gone in reversed(rounds):
        child = known.select(F.col("id").alias("kid"), F.col("leaves").alias("l"), F.col("tokens").alias("t"))
        back = gone.join(child, "kid").select("id", (F.col("leaves") + F.col("l")).alias("leaves"),
                                              (F.col("tokens") + F.col("t")).alias("tokens"))
        above = store(known.unionByName(active.where("kids = 0").select("id", "leaves", "tokens")).unionByName(back), "totals")
        drop(known, active, gone)
        known = above
    return known


def ends_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256 of rows (key, conv_id): the ids in order, joined by commas.

    Runs of ids become strings in parallel. A digest reads its bytes in order, so a node's strings pass through one task,
    as a stream that holds one batch.
    """
    small_batches(ends.sparkSession)
    placed = numbered(ends.select(F.col("key").alias("tree"), "conv_id"), ["conv_id"])
    parts = placed.groupBy("tree", F.floor(F.col("pos") / RUN).alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches):
        now, sha = None, None
        for batch in batches:
            keys, out = [], []
            for key, ids in zip(batch["tree"], batch["ids"]):
                if key == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        keys.append(now)
                        out.append(sha.hexdigest())
                    now, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            yield pd.DataFrame({"key": keys, "ends_sha256": out}, dtype=object)
        if now is not None:
            yield pd.DataFrame({"key": [now], "ends_sha256": [sha.hexdigest()]})

    return parts.repartition("tree").sortWithinPartitions("tree", "run").mapInPandas(digest, "key string, ends_sha256 string")


def trie(rows: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node: key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows``: conv_id, pos, x, chars, len of every turn; ``members``: conv_id, len, also of conversations
    without turns, which end at the root. Equal conversations share all nodes; without members there is no node.
    """
    longest = members.agg(F.max("len")).first()[0] or 0
    rows = store(prefixes(rows, longest), "prefixes")
    nodes = store(nodes_of(rows, members), "nodes")
    ends = rows.where("pos + 1 = len").select("key", "conv_id").unionByName(
        members.where("len = 0").select(F.lit(ROOT).alias("key"), "conv_id"))
    sums = totals(nodes.select("id", "parent", F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                               F.col("weight").alias("tokens"), "kids", "kid"))
    return (nodes.join(sums, "id").join(ends_digests(ends), "key", "left")
            .select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("tokens").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def shared_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt by ``share_heads``. Odd rows: see ``ordered``; a conversation may have any
    number of turns, a text any length."""
    turns = store(ordered(conversations), "ordered")
    rows, members = share_heads(turns)
    return trie(rows, members)
