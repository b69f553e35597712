"""Exact dedup by deterministic block naming. DataFrame functions only.

Every text (whitespace runs replaced by one space, UTF-8) is cut into blocks of a fixed
number of bytes. The distinct blocks are sorted and numbered; then adjacent
names are paired, the distinct pairs are sorted and numbered, and so on until
each document has one name. Two documents get the same (level, name) exactly
when their texts are equal: a number stands for one block or one pair of
numbers, never for two.

The blocks are sorted by (64-bit hash, content). A hash that the distinct blocks
show to belong to one content stands for that content, so names are found by an
equi-join on eight bytes; only blocks whose hash has two contents are joined by
content. The text itself is shuffled once, after map-side distinct, so that copies
of a hot document collapse before the shuffle. No group is collected: names are
joined, and group facts are min and count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import let
from inkwell.llm.common import drop, keep_rows, row_id, store, text_or_empty, whole_rows

BLOCK_BYTES = 4096
NO_PARTNER = -(1 << 63)  # partner of an odd last name


def normalised(column="text"):
    """Null as empty; each run of [\\x20\\x09-\\x0D] as one space (lone spaces are left alone)."""
    return F.regexp_replace(text_or_empty(column), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def blocks(text, block_bytes: int):
    """Array of the UTF-8 bytes of ``text`` in blocks; one empty block for an empty text."""
    return let(text.cast("binary"), lambda b: F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.length(b) - 1, F.lit(0)) / block_bytes).cast("int")),
        lambda i: F.substring(b, i * block_bytes + 1, F.lit(block_bytes))))


def _numbered(distinct: DataFrame, *key) -> DataFrame:
    """Sort the distinct keys over range partitions and number them in that order."""
    ranked = distinct.repartitionByRange(*key).sortWithinPartitions(*key)
    return store(ranked.withColumn("name", F.monotonically_increasing_id()), "names")


def document_names(rows: DataFrame, block_bytes: int = BLOCK_BYTES, key_bits: int = 64) -> DataFrame:
    """One collision-free identity (level, name) for each row of (doc_id, text, __rid).

    ``key_bits`` shortens the sort key's hash; tests use it to force two contents on one hash.
    """
    cut = (rows.withColumn("norm", normalised("text"))
           .select("__rid", "doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                   blocks(F.col("norm"), block_bytes).alias("bs")))
    key = F.xxhash64("block") if key_bits == 64 else F.pmod(F.xxhash64("block"), F.lit(1 << key_bits))

    keys = store(
        cut.select("__rid", "doc_id", "text_sha256", F.size("bs").alias("n"), F.posexplode(F.transform(
            "bs", lambda b: F.xxhash64(b) if key_bits == 64 else F.pmod(F.xxhash64(b), F.lit(1 << key_bits))))
            .alias("pos", "h")), "blocks")

    contents = cut.select(F.explode("bs").alias("block")).select(key.alias("h"), "block")
    variants = store(contents.distinct().groupBy("h").agg(F.count("*").alias("contents")), "variants")
    names = _numbered(variants.where("contents = 1").select("h"), "h")
    level0 = keys.join(names, "h").select("__rid", "doc_id", "text_sha256", "n", "pos", "name")
    twofold = variants.where("contents > 1").select("h")
    if not twofold.isEmpty():  # blocks that share a hash: named by content, below zero
        exact = _numbered(contents.join(twofold, "h", "left_semi").distinct(), "h", "block")
        full = cut.select("__rid", "doc_id", "text_sha256", F.size("bs").alias("n"),
                          F.posexplode("bs").alias("pos", "block")).withColumn("h", key)
        level0 = level0.unionByName(
            full.join(exact, ["h", "block"])
            .select("__rid", "doc_id", "text_sha256", "n", "pos", (-1 - F.col("name")).alias("name")))
    level0 = store(level0, "level0")

    done = level0.where("n = 1").select("__rid", "doc_id", "text_sha256", F.lit(0).alias("level"), "name")
    current = level0.where("n > 1").select("__rid", "n", "pos", "name")
    longest = level0.agg(F.max("n")).first()[0] or 0
    named = []
    level = 0
    while longest > 1:
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = (current.groupBy("__rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("half"))
                 .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NO_PARTNER)).alias("b")))
        pair_names = _numbered(pairs.select("a", "b").distinct(), "a", "b")
        merged = store(pairs.join(pair_names, ["a", "b"])
                       .select("__rid", F.ceil(F.col("n") / 2).cast("int").alias("n"),
                               F.col("half").alias("pos"), "name"), "level")
        drop(pair_names)
        named.append(merged.where("n = 1").select("__rid", F.lit(level).alias("level"), "name"))
        current = merged.where("n > 1")
        longest = (longest + 1) // 2
    if named:
        ends = named[0]
        for t in named[1:]:
            ends = ends.unionByName(t)
        first = level0.where("n > 1 AND pos = 0").select("__rid", "doc_id", "text_sha256")
        done = done.unionByName(first.join(ends, "__rid").select(*done.columns))
    drop(keys, variants, names)
    return done


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, key_bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and __rid).

    Of equal texts the row with the smallest doc_id stays (null ids last; of repeated rows one).
    Null text counts as empty, empty texts are equal to each other; other columns of
    the input are ignored here; an empty table gives an empty result. keep_id is null only if all
    ids of the group are null.
    """
    return dedup_rows(row_id(docs, "doc_id", "text"), block_bytes, key_bits)


def dedup_rows(docs: DataFrame, block_bytes: int = BLOCK_BYTES, key_bits: int = 64) -> DataFrame:
    """``exact_dedup`` for rows (doc_id, text) that carry ``__rid``."""
    rows = document_names(docs, block_bytes, key_bits)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("__rid"))
    # stored, so that the join deals both sides out by exchanges of their own and AQE may split a hot name's rows
    groups = store(rows.groupBy("level", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size")), "groups")
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("__rid") == F.col("first.__rid")).alias("kept"), "text_sha256", "__rid")


def drop_exact_copies(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` (all its columns) without later copies: one row of each group of equal texts stays.

    That row has the smallest doc_id (null ids last; of repeated rows one stays). Null and empty texts are equal, so one of
    them stays; further columns of any name are kept; an empty table gives an empty result.
    """
    rows = whole_rows(docs)
    return keep_rows(rows, dedup_rows(rows, **kw).where("kept"))
