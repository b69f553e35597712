"""Merkle manifest of a dataset, with octopus multiproofs.

Leaves are grouped into one tree per key (a source) and ordered in it; every run of ``ARITY`` consecutive
nodes becomes their digest until one is left, and the roots of the trees are the leaves of one more tree.

A *leaf partition* is a block of ``ARITY ** HEIGHT`` consecutive leaves of one tree, however large the tree: no step
ever holds more than a block. Its proofs come as one octopus multiproof: all nodes below the block's root
derive from its own leaves, so the minimal union of the coordinates its leaves miss is the siblings on the
one path above it. The block asks for each of them once (an equi-join with the node table), derives the
shared interiors itself, and expands every leaf's own proof locally.

The nodes near a root are missing in every block of a large tree: the node table holds copies of them, in
proportion to the blocks that ask, and a block asks one copy, so that no key of the join is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import numbered, row_id, store

ARITY = 3
HEIGHT = 4            # levels inside a block: 81 leaves
BLOCK = ARITY ** HEIGHT
ASKERS = 729          # blocks that ask one copy of a node
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
POWERS = [ARITY ** k for k in range(40)]


def power(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p).cast("long") for p in POWERS]), k.cast("int") + 1)


def height(n) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in POWERS]), lambda p: p < F.col(n)))


def leaf_digest(columns) -> Column:
    """sha256 of the columns' values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    def part(c):
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def gather(nodes: DataFrame, place: str, payload: list[str]) -> DataFrame:
    """One row per block: tree, n, block, items (its nodes by place), at most ``BLOCK`` of them."""
    block = F.floor(F.col(place) / BLOCK).cast("long")
    return nodes.groupBy("tree", "n", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(place).alias("pos"), "h", *payload))).alias("items"))


def _runs(below: str) -> Column:
    """The digests of the runs of a level."""
    firsts = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / ARITY).cast("int"))
    return F.transform(firsts, lambda i: F.sha2(F.concat_ws("", F.slice(below, i * ARITY + 1, F.lit(ARITY))), 256))


def derive(blocks: DataFrame, base: int) -> DataFrame:
    """Adds ``up`` (levels that the block spans) and ``levels``: the digests of its interior nodes, level by level
    from its own nodes at level ``base`` of the tree."""
    out = blocks.withColumn("up", F.least(F.lit(HEIGHT), height("n") - base)).withColumn(
        "l0", F.transform("items", lambda x: x["h"]))
    for k in range(1, HEIGHT + 1):
        out = out.withColumn(f"l{k}", F.when(F.col("up") >= k, _runs(f"l{k - 1}")))
    names = [f"l{k}" for k in range(HEIGHT + 1)]
    return out.withColumn("levels", F.array(*names)).drop(*names)


def build(blocks: DataFrame, most: int) -> DataFrame:
    """The node table from ``HEIGHT`` up: tree, n, level, idx, h, of the trees' blocks of leaves.

    ``most`` is the largest number of leaves; each round climbs ``HEIGHT`` levels, so there are few.
    """
    top = sum(p < most for p in POWERS)
    nodes = store(derive(blocks, 0).select(
        "tree", "n", F.col("up").alias("level"), F.col("block").alias("idx"),
        F.get(F.get("levels", F.col("up")), 0).alias("h")), "nodes")
    last = nodes
    for base in range(HEIGHT, top, HEIGHT):
        above = derive(gather(last.where((F.col("level") == base) & (height("n") > base)), "idx", []), base)
        up = above.select("tree", "n", "block", F.posexplode(F.slice("levels", 1, F.col("up") + 1)).alias("k", "hs"))
        last = store(up.where("k > 0").select("tree", "n", (F.col("k") + base).alias("level"), "block", "k", F.posexplode("hs").alias("j", "h"))
                     .select("tree", "n", "level", (F.col("block") * power(HEIGHT - F.col("k")) + F.col("j")).alias("idx"), "h"),
                     "nodes")
        nodes = nodes.unionByName(last)
    return nodes


def copies(level) -> Column:
    """How many copies of a node of this level the node table holds for those who ask."""
    return F.greatest(F.lit(1).cast("long"), F.floor(power(F.greatest(level - HEIGHT, F.lit(0))) / ASKERS).cast("long"))


def missing(block="block", n="n") -> Column:
    """The coordinates that a block's leaves miss, as structs (level, idx): the other nodes of each run on the path
    above it. All else in its proofs derives from its own leaves."""
    def at(level):
        i = F.floor(F.col(block) / power(level - HEIGHT)).cast("long")
        size = F.ceil(F.col(n) / power(level)).cast("long")
        run = F.transform(F.sequence(F.lit(0), F.lit(ARITY - 1)), lambda j: F.struct(
            level.alias("level"), (i - i % ARITY + j).alias("idx")))
        return F.filter(run, lambda c: (c["idx"] != i) & (c["idx"] < size))

    return F.when(height(n) > HEIGHT, F.flatten(F.transform(F.sequence(F.lit(HEIGHT), height(n) - 1), at)))


def fetch(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """tree, block and ``above``: the run's digests left and right of the path, for each level above the block."""
    asked = (blocks.select("tree", "n", "block", F.explode(missing()).alias("c"))
             .select("tree", "n", "block", F.col("c.level").alias("level"), F.col("c.idx").alias("idx"))
             .withColumn("copy", F.col("block") % copies(F.col("level"))))
    held = nodes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies(F.col("level")) - 1))).drop("n")
    got = asked.join(held, ["tree", "level", "idx", "copy"]).groupBy("tree", "n", "block").agg(
        F.sort_array(F.collect_list(F.struct("level", "idx", "h"))).alias("got"))

    def step(level):
        i = F.floor(F.col("block") / power(level - HEIGHT)).cast("long")
        side = lambda keep: F.concat_ws("", F.transform(F.filter(
            "got", lambda x: (x["level"] == level) & keep(x["idx"])), lambda x: x["h"]))
        return F.struct(side(lambda x: x < i).alias("left"), side(lambda x: x > i).alias("right"))

    return got.select("tree", "block", F.transform(F.sequence(F.lit(HEIGHT), height("n") - 1), step).alias("above"))


def expand(blocks: DataFrame, above: DataFrame, tops: DataFrame | None = None) -> DataFrame:
    """One row per leaf: its item, its tree's columns of ``tops`` and ``path``, its own proof.

    ``path``: a struct (left, right) per level, the digests of its run before and behind it, from the leaf to the root.
    """
    out = derive(blocks, 0).join(above, ["tree", "block"], "left")
    none = F.array().cast("array<struct<left:string,right:string>>")
    parts = [F.coalesce("above", none)]
    if tops is not None:  # a large tree has many blocks, which ask one copy each
        many = tops.withColumn("copy", F.explode(F.sequence(
            F.lit(0).cast("long"), F.floor((F.col("n") - 1) / (BLOCK * ASKERS)).cast("long")))).drop("n")
        out = out.withColumn("copy", F.floor(F.col("block") / ASKERS).cast("long")).join(many, ["tree", "copy"]).drop("copy")
        parts.append(F.col("top"))
    names = [c for c in out.columns if c not in ("items", "levels", "up", "above", "block", "n")]
    leaves = out.select("*", F.explode("items").alias("item"))
    inner = (F.col("item.pos") - F.col("block") * BLOCK).cast("int")

    def step(level):
        p = F.floor(inner / power(level)).cast("int")
        hs = F.get(F.col("levels"), level)
        return F.struct(F.concat_ws("", F.slice(hs, p - p % ARITY + 1, p % ARITY)).alias("left"),
                        F.concat_ws("", F.slice(hs, p + 2, ARITY - 1 - p % ARITY)).alias("right"))

    local = F.when(F.col("up") > 0, F.transform(F.sequence(F.lit(0), F.col("up") - 1), step)).otherwise(none)
    return leaves.select(*[c for c in names if c != "top"], "item.*", F.concat(local, *parts).alias("path"))


def fold(h, path="path") -> Column:
    """The root that a leaf's digest and its proof give."""
    return F.aggregate(path, F.col(h) if isinstance(h, str) else h,
                       lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(path="path") -> Column:
    """sha256 of the proof's digests, level by level and left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def _most(leaves: DataFrame) -> int:
    return leaves.agg(F.max("n")).first()[0] or 0


def prove(leaves: DataFrame, payload: list[str]):
    """The roots (tree, n, h) of numbered leaves, and a function that expands their proofs below given tops."""
    blocks = store(gather(leaves, "pos", payload), "blocks")
    nodes = build(blocks, _most(leaves))
    roots = nodes.where(F.col("level") == height("n")).select("tree", "n", "h")
    return roots, lambda tops=None: expand(blocks, fetch(blocks.drop("items"), nodes), tops)


def manifest(docs: DataFrame, fields=FIELDS, tree: str = "source", order: str = "doc_id", extra=None) -> DataFrame:
    """One row per row of ``docs``: order column, leaf, subroot, root, path (its proof) and the columns of ``extra``.

    ``fields`` make the leaf, ``tree`` names the column of the trees and ``order`` that of the order in a tree;
    ``extra`` maps names to further columns over ``docs`` that ride along. Nulls come first, both as tree and in
    the order; rows that tie there are ordered by their leaf, and equal rows, each a leaf of its own, by their place
    in the input. Texts are hashed whole, a null by ``-`` and an empty one by ``0:``; other columns are ignored; an
    empty table gives no rows.
    """
    extra = extra or {}
    key = F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    rows = row_id(docs, key.alias("tree"), F.col(order).alias("_order"), leaf_digest([F.col(f) for f in fields]).alias("h"),
                  *[c.alias(n) for n, c in extra.items()])
    rows = store(rows, "leaves")
    leaves = numbered(rows, ["_order", "h", "__rid"]).drop("__rid")
    subroots, proofs = prove(leaves, ["_order", *extra])
    upper = numbered(subroots.select(F.lit("").alias("tree"), "h", F.col("tree").alias("of"), F.col("n").alias("docs")), ["of"])
    root, upper_proofs = prove(upper, ["of", "docs"])
    tops = (upper_proofs().join(F.broadcast(root.select("tree", F.col("h").alias("root"))), "tree")  # one row
            .select(F.col("of").alias("tree"), F.col("docs").alias("n"), F.col("h").alias("subroot"), "root",
                    F.col("path").alias("top")))
    return proofs(tops).select(F.col("_order").alias(order), F.col("h").alias("leaf"), "subroot", "root", "path", *extra)


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of ``documents``.

    Rows whose crc32(doc_id) is even are tampered with after the manifest: their text loses its newlines, and their
    proof is folded from what they are then. A null text stays null; a row without a doc_id is left alone.
    """
    text = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(hit, leaf_digest([text if f == "text" else F.col(f) for f in FIELDS]))
    rows = manifest(docs, extra={"found": found})
    return (rows.withColumn("folded_root", fold(F.coalesce("found", "leaf")))
            .select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
