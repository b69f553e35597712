"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints that differ in
at most three bits have a segment that differs in at most one; masking
("deleting") each bit of each segment in turn gives 64 variants per
fingerprint, and such a pair shares a variant. Distinct fingerprints are indexed by variant,
grouped by equality, verified by their full distance, and linked inside their bucket by a
spanning forest (never by all pairs). A bucket beyond ``BUCKET`` fingerprints is
streamed on, not gathered: its members are indexed again by the variants of the
other segment's 16-bit halves, which bounds a bucket by the 18 bits left free, and
are linked by looking up every neighbour within three bits.

Links between distinct fingerprints give components by large-star / small-star
rounds, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import drop, keep_rows, row_id, small_batches, store, text_or_empty, whole_rows

SHINGLE = 3
MAX_BITS = 3
BUCKET = 1024  # fingerprints compared at once in memory; larger buckets are indexed further
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LINK_SCHEMA = "hot boolean, key long, a long, b long"


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of the whole text; 0 when it has no words."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        h = xxhash.xxh64_intdigest
        hashes = [h(line[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    n, ones = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Adds ``fp`` (signed long) to rows with a ``text`` column, which is dropped."""
    small_batches(rows.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return rows.withColumn("fp", fp(text_or_empty("text"))).drop("text")


def _variants():
    """64 one-wildcard variants: (variant number j) << 32 | segment with bit j % 32 cleared."""
    return F.expr("""transform(sequence(0, 63), j -> shiftleft(cast(j AS bigint), 32)
        | (shiftrightunsigned(fp, if(j < 32, 0, 32)) & 4294967295 & ~shiftleft(1L, j % 32)))""")


def _second_variants():
    """For hot buckets: variants of the 16-bit halves of the segment that the key does not hold."""
    return F.expr("""transform(sequence(0, 31), j -> shiftleft(cast(j AS bigint), 16)
        | (shiftrightunsigned(fp, if(shiftright(key, 32) < 32, 32, 0) + if(j < 16, 0, 16))
           & 65535 & ~shiftleft(1L, j % 16)))""")


def _forest(fps: np.ndarray, neighbours) -> np.ndarray:
    """Index of the first member of each member's component; ``neighbours(labels)`` gives the
    smallest label next to each member."""
    labels = np.arange(len(fps))
    while True:
        new = np.minimum(labels, neighbours(labels))
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def link_bucket(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of fingerprints at most ``max_bits`` apart; compares in memory."""
    if len(fps) == 2:
        near = (int(fps[0]) ^ int(fps[1])).bit_count() <= max_bits
        return (fps[1:], fps[:1]) if near else (fps[:0], fps[:0])
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
    labels = _forest(fps, lambda lab: np.where(near, lab[None, :], len(fps)).min(1))
    moved = labels != np.arange(len(fps))
    return fps[moved], fps[labels[moved]]


def link_by_lookup(fps: np.ndarray, free_bits: list[int], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for a large bucket of sorted fingerprints that differ in ``free_bits`` only:
    each neighbour is looked up, so the cost follows the bucket's size, not its square."""
    masks = [sum(1 << b for b in c) for k in range(1, max_bits + 1) for c in combinations(free_bits, k)]

    def neighbours(lab):
        best = lab.copy()
        for m in masks:
            other = fps ^ np.uint64(m)
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = fps[at] == other
            best[hit] = np.minimum(best[hit], lab[at[hit]])
        return best

    labels = _forest(fps, neighbours)
    moved = labels != np.arange(len(fps))
    return fps[moved], fps[labels[moved]]


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """Blocks of whole runs of equal keys from sorted batches, and pieces of long runs.

    Yields (arrays, whole): arrays of complete runs, or a piece of one run
    that is still growing beyond BUCKET (whole is False; its end comes as such a piece too).
    """
    carry, growing = None, False
    for batch in batches:
        arrays = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        if carry is not None:
            arrays = [np.concatenate(x) for x in zip(carry, arrays)]
        if not len(arrays[0]):
            continue
        same = np.ones(len(arrays[0]), bool)
        for x in arrays[:-1]:
            same &= x == x[-1]
        last = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if last:  # the last run starts here; what is before it is complete
            if growing:
                first = np.ones(len(same), bool)
                for x in arrays[:-1]:
                    first &= x == x[0]
                end = int(np.argmin(first))
                yield [x[:end] for x in arrays], False
                arrays, last, growing = [x[end:] for x in arrays], last - end, False
            if last:
                yield [x[:last] for x in arrays], True
        carry = [x[last:] for x in arrays]
        if growing or len(carry[0]) > BUCKET:
            yield carry, False
            # one member stays as a marker of the open run; it may be deferred twice, which is harmless
            carry, growing = [x[-1:] for x in carry], True
    if carry is not None and len(carry[0]):
        yield carry, not growing


def _groups(arrays):
    change = np.zeros(len(arrays[0]), bool)
    change[0] = True
    for x in arrays[:-1]:
        change[1:] |= x[1:] != x[:-1]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(change))
    many = ends - starts > 1
    return zip(starts[many].tolist(), ends[many].tolist())


def _batch(hot, key, a, b):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), hot)), pa.array(key), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
        names=["hot", "key", "a", "b"])


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` at most ``max_bits`` (up to 3) apart."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments prove at most three differing bits")

    def first_round(batches):
        for arrays, whole in _runs(batches, ["key", "fp"]):
            keys, fps = arrays[0], arrays[1].view(np.uint64)
            if not whole:
                yield _batch(True, keys, fps, fps)
                continue
            out_a, out_b = [], []
            for i, j in _groups(arrays):
                if j - i > BUCKET:
                    yield _batch(True, keys[i:j], fps[i:j], fps[i:j])
                    continue
                a, b = link_bucket(fps[i:j], max_bits)
                if len(a):
                    out_a.append(a)
                    out_b.append(b)
            if out_a:
                pairs = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)]), axis=1)
                yield _batch(False, np.zeros(pairs.shape[1], np.int64), pairs[0].copy(), pairs[1].copy())

    def second_round(batches):
        pending = []

        def flush():
            k1, k2 = (pending[0][c][0] for c in (0, 1))
            fps = np.unique(np.concatenate([p[2] for p in pending]).view(np.uint64))
            pending.clear()
            if len(fps) < 2:
                return None
            if len(fps) <= BUCKET:
                a, b = link_bucket(fps, max_bits)
            else:
                j, half = int(k1) >> 32, int(k2) >> 16
                other = 32 if j < 32 else 0  # the segment that the first key does not hold
                free = [j, other + half] + [other + (16 if half < 16 else 0) + x for x in range(16)]
                a, b = link_by_lookup(fps, sorted(set(free)), max_bits)
            return _batch(False, np.zeros(len(a), np.int64), a, b) if len(a) else None

        for batch in batches:
            arrays = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "sub", "fp")]
            if not len(arrays[0]):
                continue
            change = np.flatnonzero((np.diff(arrays[0]) != 0) | (np.diff(arrays[1]) != 0)) + 1
            for i, j in zip([0, *change.tolist()], [*change.tolist(), len(arrays[0])]):
                part = [x[i:j] for x in arrays]
                if pending and (pending[0][0][0] != part[0][0] or pending[0][1][0] != part[1][0]):
                    if (out := flush()) is not None:
                        yield out
                pending.append(part)  # one bucket: at most 2^18 fingerprints by construction
        if pending and (out := flush()) is not None:
            yield out

    index = distinct.select("fp", F.explode(_variants()).alias("key"))
    found = store(index.repartition("key").sortWithinPartitions("key", "fp").select("key", "fp")
                  .mapInArrow(first_round, LINK_SCHEMA), "links")
    near = found.where("NOT hot").select("a", "b")
    hot = found.where("hot").select("key", F.col("a").alias("fp")).distinct()
    more = (hot.select("key", F.explode(_second_variants()).alias("sub"), "fp")
            .repartition("key", "sub").sortWithinPartitions("key", "sub", "fp")
            .mapInArrow(second_round, LINK_SCHEMA).select("a", "b"))
    return near.unionByName(more).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node.

    Alternating large-star and small-star rounds; every round is stored, and the rounds
    end when the set of links does not change.
    """
    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), "edges")
    state = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    before = state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = store(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = state(new)
        drop(now)
        now = new
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, first (and __rid).

    component_id is the smallest doc_id that links reach (null only where all its ids are
    null); ``first`` marks one row per component, that of the smallest id. Null and
    empty texts have fingerprint zero and link like any other; repeated rows share a fingerprint; an
    empty table gives an empty result; other columns of the input are ignored here.
    """
    return near_rows(row_id(docs, "doc_id", "text"), shingle, max_bits)


def near_rows(rows: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``near_dedup`` for rows (doc_id, text) that carry ``__rid``."""
    fps = store(fingerprints(rows.select("__rid", "doc_id", "text"), shingle), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("__rid"))
    distinct = store(fps.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    best = member.groupBy("root").agg(F.min("first").alias("best"))
    of = member.join(best, "root").select("fp", "best")
    return fps.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"), (F.col("__rid") == F.col("best.__rid")).alias("first"), "__rid")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` (all its columns) with one row of each component, that of the smallest doc_id.

    Null ids come last, and of repeated rows one stays. Null, empty and blank texts all have fingerprint zero, so one of
    them stays; further columns of any name are kept; an empty table gives an empty result.
    """
    rows = whole_rows(docs)
    return keep_rows(rows, near_rows(rows, shingle, max_bits).where("first"))
