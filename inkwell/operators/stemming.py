"""ROUGE and BLEU counts of a pair, inside its row.

One Arrow step reads a pair and returns counts only: clipped overlaps per n-gram order and the LCS
length. Stems are remembered per worker, so a word is stemmed once, and no token or gram is exploded or shuffled.
A batch stays in Arrow's form; ROWS pairs of it at a time become Python strings, so a worker's memory does not follow the batch.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F

from inkwell.functions.porter import rouge_stem

REMEMBERED = 200_000  # stems a worker holds at most
ROWS = 64             # pairs of a batch that are Python objects at once
_stems: dict[str, str] = {}


def stems(tokens) -> list[str]:
    """The tokens' stems, from this worker's memory where it has them."""
    if len(_stems) > REMEMBERED:
        _stems.clear()
    out = []
    for t in tokens:
        s = _stems.get(t)
        if s is None:
            s = rouge_stem(t)
            _stems[t] = s = t if s == t else s  # most words are their own stem: one string, not two
        out.append(s)
    return out


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence of two token sequences.

    Bit-parallel form: one machine word per 64 positions of ``a`` (Python ints),
    O(len(a) * len(b) / 64).
    """
    if a is None or b is None or len(a) == 0 or len(b) == 0:
        return 0
    masks: dict = {}
    for i, tok in enumerate(a):
        masks[tok] = masks.get(tok, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for tok in b:
        u = v & masks.get(tok, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def clipped(a: list, b: list, n: int) -> int:
    """Clipped n-gram matches of two token lists."""
    grams = lambda t: Counter(zip(*(t[i:] for i in range(n))))
    held = grams(b)
    return sum(min(k, held[g]) for g, k in grams(a).items() if g in held)


def clipped_upto(a: list, b: list, orders: int) -> list[int]:
    """Clipped matches of the orders 1, 2, ... A pair without a common n-gram has no longer one, so its higher orders
    are not counted."""
    out = [0] * orders
    for n in range(1, orders + 1):
        out[n - 1] = clipped(a, b, n)
        if not out[n - 1]:
            break
    return out


def objects(column: pa.Array) -> list:
    """A slice of texts, or of token lists, as Python objects (neither is null here)."""
    if not pa.types.is_list(column.type):
        return column.to_numpy(zero_copy_only=False).tolist()
    flat = column.flatten().to_numpy(zero_copy_only=False).tolist()
    ends = [0, *accumulate(column.value_lengths().to_pylist())]
    return [flat[i:j] for i, j in zip(ends, ends[1:])]


def pair_counts(stem: bool, rouge: bool, lcs: bool, bleu_orders: int):
    """Arrow function of a pair that returns counts only: ``rouge`` (clipped matches of orders 1 and 2), ``lcs``, ``bleu``
    (clipped matches of its orders) and the lengths ``hyp_len``, ``ref_len``; 0 or empty where not asked.

    It reads the pair's two texts, for BLEU (tokens of ``str.split``), and, where ROUGE or the LCS are asked, its two
    ROUGE token arrays. Grams live in the row's own counters, so none is ever a row.
    """
    schema = "struct<rouge:array<long>,lcs:long,bleu:array<long>,hyp_len:long,ref_len:long>"

    def count(p, r, pt, rt):
        out = [[0, 0], 0, [], 0, 0]
        if pt is not None:
            pt, rt = (stems(pt), stems(rt)) if stem else (pt, rt)
            out[:2] = clipped_upto(pt, rt, 2) if rouge else [0, 0], lcs_length(pt, rt) if lcs else 0
        if bleu_orders:
            a, b = p.split(), r.split()
            out[2:] = clipped_upto(a, b, bleu_orders), len(a), len(b)
        return out

    names = ["rouge", "lcs", "bleu", "hyp_len", "ref_len"]
    longs = pa.list_(pa.int64())
    kind = pa.struct(list(zip(names, [longs, pa.int64(), longs, pa.int64(), pa.int64()])))

    def counted(count, *columns: pa.Array) -> pa.Array:
        done = [pa.array([], kind)]
        for i in range(0, len(columns[0]), ROWS):
            rows = zip(*(objects(c.slice(i, ROWS)) for c in columns))
            done.append(pa.array([dict(zip(names, count(*x))) for x in rows], kind))
        return pa.concat_arrays(done)

    if not (rouge or lcs):
        @F.arrow_udf(schema)
        def texts_only(pred: pa.Array, ref: pa.Array) -> pa.Array:
            return counted(lambda p, r: count(p, r, None, None), pred, ref)

        return lambda p, r, pt, rt: texts_only(p, r)
    if not bleu_orders:
        @F.arrow_udf(schema)
        def tokens_only(pred: pa.Array, ref: pa.Array) -> pa.Array:
            return counted(lambda pt, rt: count(None, None, pt, rt), pred, ref)

        return lambda p, r, pt, rt: tokens_only(pt, rt)

    @F.arrow_udf(schema)
    def both(pred: pa.Array, ref: pa.Array, pred_tokens: pa.Array, ref_tokens: pa.Array) -> pa.Array:
        return counted(count, pred, ref, pred_tokens, ref_tokens)

    return both
