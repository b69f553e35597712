"""Suffix-array dedup: removes every byte covered by a string of ``window`` bytes that starts elsewhere too.

Only suffixes that can decide a match are sorted. Every window of ``window`` bytes has one anchor, the position in it
whose leading token (TOKEN bytes) has the smallest hash, leftmost first; equal windows have their
anchors at the same place. So two windows are equal exactly if, at their anchors, they agree in the same
number of bytes to the left and to the right. The steps:

1. Anchors of all texts (one or two for each ``window`` bytes) and the counts of their leading tokens' hashes.
2. Anchored suffixes whose token occurs again, with their left context, cut to what their windows reach.
3. Sampled splitters range-partition the suffixes by leading token, so equal windows share a bucket: no match
   crosses a boundary between buckets. A bucket is read in runs of whole tokens, bounded in memory.
4. Each run sorts the suffixes by multikey quicksort (words of 8 bytes as its characters) and compares neighbours;
   likewise the reversed left contexts. The common-prefix lengths give, for every length, the block of
   equal suffixes; windows are equal when right block and left block are.
5. A token that occurs more than HOT times (a passage in a large share of the documents) is not sorted in one task: its
   windows are counted by two 64-bit hashes of their bytes, which map-side sums collapse before the shuffle.
6. The covered spans go back to their documents, are merged and cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import drop, row_id, small_batches, store, text_or_empty
from inkwell.llm.words import BASE, _power_tables, mix

WINDOW = 400
TOKEN = 40         # bytes of a suffix's leading token
BLOCK = 1 << 18    # window starts handled at once
RUN = 20_000       # suffixes sorted at once
HOT = 50_000       # suffixes of one token sorted in one task; more are counted by hash


def _argmin_left(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost minimum of each run of ``width`` values, by block prefix and suffix minima."""
    n = len(values)
    pad = -n % width
    # the value's high bits, then its place: minima are leftmost among equal high bits
    place = np.arange(n + pad, dtype=np.uint64)
    bits = np.uint64(max(1, int(n + pad).bit_length()))
    high = np.concatenate([values >> bits << bits, np.full(pad, ~np.uint64(0) >> bits << bits)])
    key = (high | place).reshape(-1, width)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    last = n - width + 1
    best = np.minimum(behind[:last], ahead[width - 1:width - 1 + last])
    return (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def anchors(data: bytes, window: int = WINDOW, token: int = TOKEN, block: int = BLOCK):
    """(position, hash of its leading token, smallest and largest left reach) of each anchor of a text.

    The reach says which windows an anchor decides: those that start ``low`` to ``high`` bytes before it.
    """
    n = len(data) - window + 1  # number of windows
    out = []
    width = window - token + 1
    for first in range(0, max(n, 0), block):
        count = min(block, n - first)
        part = np.frombuffer(data, np.uint8, count + window - 1, first).astype(np.uint64) + np.uint64(1)
        up, down = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        m = len(part) - token + 1
        hashes = mix((sums[token:] - sums[:m]) * down[:m])
        at = _argmin_left(_coarse(hashes), width)
        change = np.flatnonzero(np.diff(at, prepend=-1))
        ends = np.append(change[1:], count) - 1
        where = at[change]
        out.append((where + first, hashes[where].view(np.int64), where - ends, where - change))
    if not out:
        return [np.empty(0, np.int64)] * 4
    return [np.concatenate(x) for x in zip(*out)]


def _coarse(hashes: np.ndarray) -> np.ndarray:
    """The bits that decide between tokens: the same for every block size, so that equal windows agree."""
    return hashes >> np.uint64(32) << np.uint64(32)


ANCHOR_TYPE = pa.struct([("n_bytes", pa.int64()), ("sha256", pa.string()), ("pos", pa.list_(pa.int64())),
                         ("h", pa.list_(pa.int64())), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32()))])
ANCHORS = ("struct<n_bytes:long,sha256:string,pos:array<long>,h:array<long>,low:array<int>,high:array<int>>")
SUFFIXES = "pos long, h long, low int, high int, left binary, right binary"


def sorted_blocks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort equal-length byte rows; returns (order, common prefix of each row with the one before it).

    Multikey quicksort with characters of eight bytes: rows that still tie are sorted by their next word.
    """
    n, length = rows.shape
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -length % 8)))).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    bounds = np.flatnonzero(np.diff(words[order, 0], prepend=~words[order[0], 0]))
    group = np.zeros(n, np.int64)
    group[bounds] = 1
    group = np.cumsum(group)
    for w in range(1, words.shape[1]):
        tied = np.flatnonzero(np.bincount(group, minlength=group[-1] + 1)[group] > 1)
        if not len(tied):
            break
        sub = order[tied]
        inner = np.lexsort((words[sub, w], group[tied]))
        order[tied] = sub[inner]
        value = words[order[tied], w]
        new = np.zeros(n, bool)
        new[1:] = np.diff(group) != 0
        new[tied[1:]] |= (np.diff(value) != 0) & (np.diff(tied) == 1)
        group = np.cumsum(new) + 1
    differs = rows[order[1:]] != rows[order[:-1]]
    prefix = np.where(differs.any(1), differs.argmax(1), length) if n > 1 else np.empty(0, np.int64)
    return order, np.concatenate([[0], prefix]).astype(np.int64)


def repeated_windows(left, right, low, high, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest left reach of each suffix's windows that occur again (largest < smallest: none).

    ``left`` holds reversed left contexts. A window with left reach a is repeated exactly if another suffix with
    reach a lies in the same block of right contexts (common prefix >= window - a) and of left ones (>= a).
    """
    n = len(low)
    tallest = int(high.max())
    matrix_l, matrix_r = _matrix(left, max(tallest, 1)), _matrix(right, window - int(low.min()))
    order_l, prefix_l = sorted_blocks(matrix_l)
    order_r, prefix_r = sorted_blocks(matrix_r)
    smallest, largest = np.full(n, window + 1, np.int64), np.full(n, -1, np.int64)
    block_l, block_r = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(int(low.min()), tallest + 1):
        block_l[order_l] = np.cumsum(prefix_l < a) if a else 0
        block_r[order_r] = np.cumsum(prefix_r < window - a)
        members = np.flatnonzero((low <= a) & (a <= high))
        if len(members) < 2:
            continue
        key = block_r[members] * (n + 1) + block_l[members]
        by = np.argsort(key, kind="stable")
        same = np.diff(key[by]) == 0
        twice = np.zeros(len(key), bool)
        twice[by[1:]] |= same
        twice[by[:-1]] |= same
        hit = members[twice]
        smallest[hit] = np.minimum(smallest[hit], a)
        largest[hit] = a
    return smallest, largest


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(r.ljust(width, b"\0")[:width] for r in rows), np.uint8).reshape(len(rows), width)


def _spans(key, pos, smallest, largest, window):
    """Covered bytes: the union of an anchor's repeated windows, which all contain the anchor."""
    hit = np.flatnonzero(largest >= smallest)
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array(hit)), pa.array(pos[hit] - largest[hit]), pa.array(pos[hit] - smallest[hit] + window)],
        names=["__rid", "s", "e"])


def _sort_bucket(window: int, token: int, run: int):
    def handle(batches):
        carry = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            carry = table if carry is None else pa.concat_tables([carry, table])
            if carry.num_rows < run:
                continue
            # whole tokens only: keep the last one open
            leads = carry.column("lead")
            last = leads[carry.num_rows - 1].as_py()
            at = carry.num_rows
            step = 1
            while at > 0 and leads[max(0, at - step)].as_py() == last:
                at = max(0, at - step)
                step *= 2
            while at < carry.num_rows and at >= 0 and leads[at].as_py() != last:
                at += 1
            while at > 0 and leads[at - 1].as_py() == last:
                at -= 1
            if at:
                yield from solve(carry.slice(0, at))
                carry = carry.slice(at)
        if carry is not None and carry.num_rows:
            yield from solve(carry)

    def solve(table):
        table = table.combine_chunks()
        pos = table.column("pos").to_numpy()
        smallest, largest = repeated_windows(
            table.column("left").to_pylist(), table.column("right").to_pylist(),
            table.column("low").to_numpy().astype(np.int64), table.column("high").to_numpy().astype(np.int64), window)
        out = _spans(table.column("__rid").combine_chunks(), pos, smallest, largest, window)
        if out.num_rows:
            yield out

    return handle


def covered_spans(rows: DataFrame, window: int, token: int, hot: int, run: int) -> tuple[DataFrame, DataFrame]:
    """(facts, texts): n_bytes and sha256 of every row; and per row with candidates its bytes and covered spans."""
    spark = rows.sparkSession
    small_batches(spark, 500)

    @F.pandas_udf(ANCHORS)
    def find(texts: pd.Series) -> pd.DataFrame:
        out = []
        for data in texts:
            pos, h, low, high = anchors(data, window, token)
            out.append((len(data), hashlib.sha256(data).hexdigest(), pos, h, low.astype(np.int32), high.astype(np.int32)))
        return pd.DataFrame(out, columns=["n_bytes", "sha256", "pos", "h", "low", "high"])

    texts = rows.select("__rid", "doc_id", text_or_empty("text").cast("binary").alias("data"))
    facts = store(texts.select("__rid", "doc_id", find("data").alias("a")).select("__rid", "doc_id", "a.*"), "anchors")
    each = facts.select("__rid", F.explode(F.arrays_zip("pos", "h", "low", "high")).alias("a")).select("__rid", "a.*")
    # stored, so that the join below deals both sides out anew and a frequent token's rows can be split
    again = store(each.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "tokens")
    wanted = (each.join(again, "h").groupBy("__rid")  # at most the anchors of one text
              .agg(F.collect_list(F.struct("pos", "h", "low", "high", "n")).alias("wanted")))
    found = store(texts.select("__rid", "data").join(wanted, "__rid"), "candidates")

    def context(a):
        # left context nearest byte first, so that a longer reach is a longer prefix
        start = F.greatest(a["pos"] - a["high"], F.lit(0)).cast("int")
        return F.struct(
            a["pos"].alias("pos"), a["low"].alias("low"), a["high"].alias("high"), a["n"].alias("n"),
            F.substring("data", start + 1, a["high"].cast("int")).alias("before"),
            F.substring("data", (a["pos"] + 1).cast("int"), F.lit(window) - a["low"]).alias("right"))

    suffixes = (found.select("__rid", F.explode(F.transform("wanted", context)).alias("x")).select("__rid", "x.*")
                .withColumn("lead", F.substring("right", 1, token)))
    few = suffixes.where(F.col("n") <= hot).drop("n")
    ordered = few.repartitionByRange("lead").sortWithinPartitions("lead").select(
        "__rid", "pos", "low", "high", "before", "right", "lead")

    def flip(batches):
        for b in batches:
            left = pa.array([x[::-1] for x in b.column("before").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(c) if c != "left" else left for c in
                                              ("__rid", "pos", "low", "high", "left", "right", "lead")],
                                             names=["__rid", "pos", "low", "high", "left", "right", "lead"])

    inner = _sort_bucket(window, token, run)
    schema = "__rid struct<f:long,r:long>, s long, e long"
    spans = ordered.mapInArrow(lambda batches: inner(flip(batches)), schema)

    many = suffixes.where(F.col("n") > hot)
    a = F.explode(F.sequence("low", "high")).alias("a")
    windows = many.select("__rid", "pos", "before", "right", "high", a).select(
        "__rid", "pos", "a", F.concat(F.substring("before", F.col("high") - F.col("a") + 1, F.col("a")),
                                      F.substring("right", F.lit(1), F.lit(window) - F.col("a"))).alias("w"))
    keyed = windows.select("__rid", "pos", "a", F.xxhash64("w").alias("k1"),
                           F.xxhash64(F.lit(1), "w").alias("k2"))
    if again.where(F.col("n") > hot).isEmpty():
        return facts, _with_spans(found, spans)
    # stored like the tokens above, for the same reason
    repeated = store(keyed.groupBy("k1", "k2").agg(F.count("*").alias("c")).where("c > 1").drop("c"), "windows")
    hot_spans = (keyed.join(repeated, ["k1", "k2"]).groupBy("__rid", "pos")
                 .agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
                 .select("__rid", (F.col("pos") - F.col("hi")).alias("s"), (F.col("pos") - F.col("lo") + window).alias("e")))
    return facts, _with_spans(found, spans.unionByName(hot_spans))


def _with_spans(found: DataFrame, spans: DataFrame) -> DataFrame:
    """The texts with candidates, each with its covered spans."""
    per_row = spans.groupBy("__rid").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    return found.select("__rid", "data").join(per_row, "__rid")


CUT = "struct<n_removed:long,n_spans:long,kept:binary>"


def cut_spans(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left) for covered spans, which may overlap or touch."""
    kept, at, removed, runs = [], 0, 0, 0
    end = -1
    for s, e in sorted(spans):
        if s > end:
            runs += 1
            kept.append(data[at:s])
            at = end = s
        if e > end:
            removed += e - max(end, s)
            at = end = e
    kept.append(data[at:])
    return removed, runs, b"".join(kept)


def remove_repeats(docs: DataFrame, window: int = WINDOW, token: int = TOKEN, hot: int = HOT,
                   run: int = RUN, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left).

    Strings are judged on the whole input, same document included; matches never cross
    documents. Null counts as empty; a text shorter than ``window`` keeps all; repeated
    rows are documents of their own, so each covers the other; other columns are ignored; an empty table gives
    an empty result.
    """
    if not 0 < token < window:
        raise ValueError("a token must be shorter than the window")
    rows = row_id(docs, "doc_id", "text")
    facts, found = covered_spans(rows, window, token, hot, run)

    @F.pandas_udf("struct<n_removed:long,n_spans:long,kept_sha256:string,kept:binary>")
    def cut(data: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for d, s in zip(data, spans):
            removed, runs, kept = cut_spans(d, [(x["s"], x["e"]) for x in s])
            out.append((removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "kept"])

    done = found.select("__rid", cut("data", "spans").alias("c")).select("__rid", "c.*")
    out = facts.select("__rid", "doc_id", "n_bytes", "sha256").join(done, "__rid", "left")
    cols = ["doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
            F.coalesce("kept_sha256", "sha256").alias("kept_sha256")]
    if with_text:
        source = rows.select(F.col("__rid").alias("r2"), text_or_empty("text").cast("binary").alias("whole"))
        out = out.join(source, F.col("__rid") == F.col("r2"))
        cols.append(F.coalesce("kept", "whole").alias("kept"))
    return out.select(*cols)
