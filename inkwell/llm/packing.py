"""Best-fit packing of token pieces by exact-complement hashing.

The pieces' lengths form a histogram of at most ``size`` entries, however many documents there are,
so the plan is made from the histogram and not from the pieces. Longest lengths first, the gap that a
length leaves is looked up among the available single lengths, pair sums and triple sums; a combination that
fills it exactly is used as often as its counts last. What is left goes best-fit
decreasing into the open sequences. The plan is a table of slots (length, first rank, count, first
sequence, offset) whose size follows the histogram. Pieces of one length are
ranked in salted groups with carried counts, and each looks up its slot by (length, rank).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm import bpe
from inkwell.llm.common import small_batches, store, text_or_empty

SIZE = 2048
END_OF_DOCUMENT = (0).to_bytes(4, "little")


def cut(chunks: Iterator[bytes], size: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32 of ids) of each piece of a document given as id byte strings."""
    ids = b"".join(chunks) + END_OF_DOCUMENT
    n = len(ids) // 4
    first = n % size if n > size else n
    bounds = [0, first] if first else [0]
    bounds += range(bounds[-1] + size, n + 1, size)
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(bounds, bounds[1:])]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each text's ids and a closing id 0, cut to ``size``."""
    small_batches(docs.sparkSession, 500)

    @F.pandas_udf("array<struct<start:long,length:long,ids_crc32:long>>")
    def cut_text(texts: pd.Series) -> pd.Series:
        enc = bpe.encoder(tokenizer)
        return pd.Series([[dict(zip(("start", "length", "ids_crc32"), p)) for p in cut(enc.encode(t), size)]
                          for t in texts])

    return (docs.select("doc_id", F.posexplode(cut_text(text_or_empty("text"))).alias("piece", "p"))
            .select("doc_id", "piece", "p.*"))


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int]]:
    """Slots (length, first rank, first sequence, offset) for a histogram of lengths; each slot
    holds until the next first rank of its length. Ranks of one length count from 0."""
    have = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    used = np.zeros(size + 1, np.int64)
    slots: list[tuple[int, int, int, int]] = []
    sequences = 0

    def place(parts, times, first, offset=0):
        for p in parts:
            slots.append((p, int(used[p]), first, offset))
            used[p] += times
            have[p] -= times
            offset += p

    def complements(length):
        """Combinations of one, two or three available lengths that fill the gap exactly."""
        gap = size - length
        if gap == 0:
            yield ()
            return
        yield (gap,)
        a = np.arange((gap + 1) // 2, gap)
        for x in a[(have[a] > 0) & (have[gap - a] > 0)].tolist():
            yield x, gap - x
        for x in range(gap - 2, (gap + 2) // 3 - 1, -1):
            if have[x] > 0:
                rest = gap - x
                y = np.arange((rest + 1) // 2, min(x, rest - 1) + 1)
                for z in y[(have[y] > 0) & (have[rest - y] > 0)].tolist():
                    yield x, z, rest - z

    for length in range(size, 0, -1):
        if have[length] <= 0:
            continue
        for fill in complements(length):
            parts = (length, *fill)
            times = min(int(have[p]) // parts.count(p) for p in set(parts))
            if times > 0:
                # a part that occurs k times in a combination takes k ranks ranges
                place(parts, times, sequences)
                sequences += times
                if have[length] <= 0:
                    break

    gaps: list[tuple[int, int, int]] = []  # open sequences: (gap, first sequence, how many)
    for length in range(size, 0, -1):
        while have[length] > 0:
            at = bisect_left(gaps, (length, -1, -1))
            if at < len(gaps):
                gap, first, many = gaps.pop(at)
            else:
                each = size // length
                gap, first, many = size, sequences, max(1, int(have[length]) // each)
                sequences += many
            each = min(gap // length, -(-int(have[length]) // many))
            if each * many > have[length]:
                each -= 1
            if each:  # every one of them takes ``each``
                place((length,) * each, many, first, size - gap)
                if gap - each * length:
                    insort(gaps, (gap - each * length, first, many))
            else:  # fewer pieces than sequences: only as many take one
                take = int(have[length])
                place((length,), take, first, size - gap)
                if gap - length:
                    insort(gaps, (gap - length, first, take))
                insort(gaps, (gap, first + take, many - take))
    return slots


def ranked(parts: DataFrame, salt: int) -> DataFrame:
    """Adds ``rank`` (from 0) among the pieces of one length; a common length is ranked in ``salt`` parts."""
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salt)))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
             .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    return (salted.withColumn("rank", F.row_number().over(order) - 1).join(bases, ["length", "salt"])
            .withColumn("rank", F.col("rank") + F.col("base")).drop("salt", "base"))


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of the input is packed, repeated rows and null ids too; a null or empty text is its closing
    id alone; a text longer than ``size`` is cut, all its pieces but the first being full;
    other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = store(pieces(docs, tokenizer, size), "pieces")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = np.array(sorted(plan(counts, size)) or [(0, 0, 0, 0)], dtype=np.int64)
    shift = np.int64(1 << 48)
    keys = slots[:, 0] * shift + slots[:, 1]
    ranks, firsts, offsets = (np.ascontiguousarray(slots[:, i]) for i in (1, 2, 3))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        key = length.to_numpy(np.int64) * shift + rank.to_numpy(np.int64)
        at = np.searchsorted(keys, key, "right") - 1
        return pd.DataFrame({"sequence_id": firsts[at] + rank.to_numpy(np.int64) - ranks[at], "offset": offsets[at]})

    salt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (ranked(parts, salt).withColumn("s", slot("length", "rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "s.sequence_id", "s.offset"))
