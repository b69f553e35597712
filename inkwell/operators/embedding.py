"""Embedding-match score (greedy cosine matching of token vectors, BERTScore-style).

Re-aimed from a neural encoder to a vector table: a token's vector is
``embeddings[vec_id]`` with ``vec_id = int(md5(token)[:15], 16) mod count(embeddings)``.
Per pair: precision = mean over prediction tokens of the best cosine against the
reference tokens, recall the converse, F1 from both; 0 when a side is empty.
A token whose ``vec_id`` is missing from the table has a zero vector and so matches nothing.

Plan: vectors by dictionary. A pair's tokens become vector numbers of eight bytes inside its row. Pairs are dealt to
groups by their hash; the distinct numbers of each group are joined to the vector table, so a
vector goes to a group once, however many of its tokens refer to it. There it arrives before the pairs, sorted by
number: one block that the pairs refer to by index. The best matches of a pair come from NumPy products of
blocks of rows with a running maximum; no token is a row of its own beside its vector, no pair rows are emitted and no
full similarity matrix is held. A partition's groups follow one another and a worker holds one group's vectors: there is a
group a partition while the vector table fits in HELD_MB, else as many as keep a group's vectors within it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from inkwell.functions.text import lower_ws_tokens
from inkwell.session import materialize, ship_package

HASH_DIGITS = 15  # hex digits of the token's hash that pick its vector
BLOCK = 1024      # prediction tokens compared at once
PAIRS = 600       # pairs of a partition, at least (fewer only if there are no more)
HELD_MB = 192     # of a group's vectors, expected at most
LENGTHS = 4096    # vectors measured at once
SCORES = ("precision", "recall", "f1")


def vec_id(token, n_vectors):
    return F.pmod(F.conv(F.substring(F.md5(token), 1, HASH_DIGITS), 16, 10).cast("long"), n_vectors)


class Dictionary:
    """A group's distinct vectors: their numbers in order, and a block of rows."""

    def __init__(self):
        self.numbers, self.rows = [], []
        self.block = None

    def add(self, numbers: np.ndarray, vectors: pa.ListArray) -> None:
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
        self.numbers.append(numbers)
        self.rows.append(flat.reshape(len(numbers), -1))

    def close(self) -> None:
        """One block of what was added; each piece is let go as it is copied, and lengths are taken piece by piece."""
        if not self.rows:
            return
        pieces, self.rows = self.rows[::-1], []
        self.numbers = np.concatenate(self.numbers)
        self.block = np.empty((len(self.numbers), pieces[0].shape[1]), np.float32)
        self.length, at = np.empty(len(self.numbers)), 0
        while pieces:
            piece = pieces.pop()
            self.block[at:at + len(piece)] = piece
            at += len(piece)
        del piece
        pa.default_memory_pool().release_unused()  # Arrow keeps what it freed, which is as much again
        for i in range(0, at, LENGTHS):
            squares = self.block[i:i + LENGTHS].astype(np.float64) ** 2
            self.length[i:i + LENGTHS] = np.maximum(np.sqrt(squares.sum(axis=1)), 1e-300)

    def unit(self, numbers: np.ndarray) -> np.ndarray:
        """Unit vectors of these numbers; zeros for one that has none."""
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        out = self.block[at].astype(np.float64) / self.length[at][:, None]
        out[self.numbers[at] != numbers] = 0.0
        return out


def match(pred: np.ndarray, ref: np.ndarray, words: Dictionary) -> tuple[float, float, float]:
    """precision, recall, f1 of two token sequences, given as vector numbers."""
    if len(pred) == 0 or len(ref) == 0 or words.block is None:
        return 0.0, 0.0, 0.0
    (pn, pw), (rn, rw) = (np.unique(x, return_counts=True) for x in (pred, ref))
    p, r = words.unit(pn), words.unit(rn)
    best_p, best_r = np.empty(len(p)), np.full(len(r), -np.inf)
    for i in range(0, len(p), BLOCK):
        sim = p[i:i + BLOCK] @ r.T
        best_p[i:i + BLOCK] = sim.max(axis=1)
        best_r = np.maximum(best_r, sim.max(axis=0))
    prec, rec = float((best_p * pw).sum() / pw.sum()), float((best_r * rw).sum() / rw.sum())
    return prec, rec, 2 * prec * rec / (prec + rec) if prec + rec > 0 else 0.0


def _score(keys: list[str]):
    """Reads each group's vectors, then its pairs; the next group starts with an empty dictionary."""
    def scored(pairs, words):
        sides = []
        for name in ("pred", "ref"):
            column = pairs[name]
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().fill_null(0).to_numpy())
            sides.append(np.split(flat, ends[:-1]))
        scores = np.array([match(p, r, words) for p, r in zip(*sides)])
        return pa.RecordBatch.from_arrays([*[pairs[k] for k in keys], *[pa.array(scores[:, i]) for i in range(3)]],
                                          names=[*keys, *SCORES])

    def run(batches):
        words, group, closed = None, None, False
        for batch in batches:
            part = batch["part"].to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)] if len(part) else []
            for start, end in zip(starts, starts[1:]):
                if part[start] != group:
                    words, group, closed = Dictionary(), part[start], False
                rows = batch.slice(start, end - start)
                vectors = rows.filter(pa.compute.is_valid(rows["v"]))
                if len(vectors):
                    words.add(vectors["vid"].to_numpy(zero_copy_only=False), vectors["v"])
                pairs = rows.filter(pa.compute.is_null(rows["v"]))
                if len(pairs):
                    if not closed:
                        words.close()
                        closed = True
                    yield scored(pairs, words)

    return run


def groups_needed(asked: int, n_vectors: int, dim: int) -> int:
    """Groups so that the vectors of one stay within HELD_MB.

    ``asked``: the pairs' distinct numbers, summed over the pairs. Numbers are hashes, so ``w`` of them are at most
    n(1 - exp(-w/n)) different ones of n in expectation (a word that pairs share counts once, so fewer).
    """
    held = max(1.0, HELD_MB * 2 ** 20 / (4 * max(dim, 1)))
    if n_vectors <= held:
        return 1
    return math.ceil(asked / (-n_vectors * math.log1p(-held / n_vectors)))


def embedding_match(pairs: DataFrame, embeddings: DataFrame, keys=("model_name", "sample_id")) -> DataFrame:
    """Per-pair (precision, recall, f1) of greedy token-vector matching."""
    keys = list(keys)
    spark = pairs.sparkSession
    ship_package(spark)
    n_vectors = embeddings.agg(F.count(F.lit(1))).scalar()  # a subquery of the one plan
    toks = pairs.select(*keys, lower_ws_tokens("prediction").alias("p"), lower_ws_tokens("reference").alias("r"),
                        n_vectors.alias("n"))
    code = lambda c: F.transform(c, lambda t: vec_id(t, F.col("n")))
    # stored: read once for the dictionary and once for the scores
    coded = materialize(toks.select(*keys, code("p").alias("pred"), code("r").alias("ref")), "coded")
    both_sides = F.array_union(*[F.coalesce(c, F.array().cast("array<bigint>")) for c in ("pred", "ref")])
    n_pairs, n_asked = coded.agg(F.count(F.lit(1)), F.sum(F.size(both_sides))).first()
    n_rows, dim = embeddings.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    # a vector is sent once per group: more of them than the session's partitions gain nothing unless memory asks for
    # it, and partitions of a few pairs each gain nothing
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(most, -(-n_pairs // PAIRS)), groups_needed(n_asked or 0, n_rows, dim or 0))
    parts = min(most, groups)
    coded = coded.withColumn("part", F.pmod(F.xxhash64(*keys, "pred", "ref"), F.lit(groups)).cast("int"))
    asked = coded.select("part", F.explode(both_sides).alias("vid")).distinct()
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vid"), F.col("embedding").cast("array<float>").alias("v")).where(
        "vid IS NOT NULL AND v IS NOT NULL")
    blocks = asked.join(vectors, "vid").select("part", "vid", "v")
    both = blocks.unionByName(coded, allowMissingColumns=True)
    schema = StructType([*[coded.schema[k] for k in keys], *[StructField(s, DoubleType()) for s in SCORES]])
    return (both.repartitionById(parts, F.pmod("part", F.lit(parts))).sortWithinPartitions("part", F.col("vid").asc_nulls_last())
            .mapInArrow(_score(keys), schema))
