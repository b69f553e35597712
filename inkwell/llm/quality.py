"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is good or bad. A line's evidence is its own features and those of the lines
before and after it; transition weights tie neighbouring labels. Forward-backward gives each line's
marginal probability of being good; their mean, weighted by the lines' lengths, is the document's
quality, mapped to a probability by a fitted logistic curve.

Labels are known for documents only, so in training every line bears its document's label. The field is fitted on
a bounded sample: at most SAMPLE labelled documents, one row each, and of a longer document a block of SAMPLE_LINES
lines that are not empty, begun where the hash of its doc_id says (a block of over SAMPLE_BYTES bytes is cut to as
many characters as surely fit). Scoring reads all
lines of all documents; the lines of many documents are worked through side by side.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import doc_crc, small_batches, text_or_empty
from inkwell.llm.learn import logistic, sigmoid

SAMPLE = 2000
SAMPLE_LINES = 100
SAMPLE_BYTES = 64_000
OWN = 13  # features of a line
STEPS = 60

_CLASSES = np.zeros((256, 7), np.float64)  # letter, digit, upper, bar, bang, symbol, other mark
for _c in range(256):
    _ch = chr(_c)
    _CLASSES[_c] = [_c >= 128 or _ch.isalpha() and _c < 128, _c < 128 and _ch.isdigit(), 65 <= _c <= 90,
                    _ch == "|", _ch == "!", _ch in "*#$%&@^~_=<>{}\\", _c < 128 and _ch in "+/[]();:\"`?"]


def lines_of(text: str | None) -> list[bytes]:
    """Lines that are not empty; an empty text is one empty line."""
    return [x for x in (text or "").encode("utf-8", "replace").split(b"\n") if x.strip()] or [b""]


def line_features(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features with neighbours, line lengths, first line of each text) of many texts' lines."""
    lines = [x for t in texts for x in t]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    counts = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])
    own = np.zeros((len(lines), OWN))
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    for first in range(0, len(lines), 4096):  # bounded memory: class counts of a few thousand lines at once
        last = min(first + 4096, len(lines))
        hist = _class_counts(data[at[first]:at[last]], at[first:last] - at[first])
        own[first:last, :7] = hist / np.maximum(sizes[first:last], 1)[:, None]
    row = 0
    for t in texts:
        seen = set()
        for line in t:
            words = line.lower().split()
            n = len(words)
            if n:
                own[row, 7] = len(set(words)) / n
                own[row, 8] = sum(map(eq, words, words[1:])) / n
                own[row, 9] = min(len(line) / n, 40) / 10
            own[row, 10] = line in seen
            own[row, 11] = n < 4
            own[row, 12] = np.log1p(n) / 5
            seen.add(line)
            row += 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[starts[:-1]] = 0
    after[starts[1:] - 1] = 0
    ends = np.zeros((len(lines), 2))
    ends[starts[:-1], 0] = 1
    ends[starts[1:] - 1, 1] = 1
    return np.hstack([own, before, after, ends]), sizes, starts


def _class_counts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.empty((len(starts), 7))
    for k in range(7):
        out[:, k] = np.add.reduceat(_CLASSES[:, k][data], starts)
    return out


def forward_backward(emit: np.ndarray, starts: np.ndarray, trans: np.ndarray):
    """Marginal probability of good for each line, and expected transition counts.

    ``emit`` is the log-odds of good; documents are rows starts[i]:starts[i + 1]. The
    documents go side by side, longest first, so that step t is one array operation.
    """
    counts = np.diff(starts)
    order = np.argsort(-counts, kind="stable")
    first, counts = starts[:-1][order], counts[order]
    node = np.stack([np.exp(-np.clip(emit, -60, 60) / 2), np.exp(np.clip(emit, -60, 60) / 2)], 1)
    move = np.exp(trans)
    alpha, beta = np.empty_like(node), np.ones_like(node)
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(1, longest + 1), "right")  # documents with more than t lines
    for t in range(longest):
        at = first[:active[t]] + t
        a = node[at] if t == 0 else (alpha[at - 1] @ move) * node[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[:active[t + 1]] + t
        ahead = node[at + 1] * beta[at + 1]
        both = alpha[at][:, :, None] * move[None] * ahead[:, None, :]
        pairs += (both / both.sum((1, 2), keepdims=True)).sum(0)
        b = ahead @ move.T
        beta[at] = b / b.sum(1, keepdims=True)
    post = alpha * beta
    return post[:, 1] / post.sum(1), pairs


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    curve: tuple[float, float]

    def quality(self, x, sizes, starts) -> np.ndarray:
        """Length-weighted mean marginal of each document."""
        emit = ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        good, _ = forward_backward(emit, starts, self.trans)
        weight = np.maximum(sizes, 1).astype(float)
        return np.add.reduceat(good * weight, starts[:-1]) / np.add.reduceat(weight, starts[:-1])

    def score(self, texts: list) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        m = self.quality(*line_features([lines_of(t) for t in texts]))
        return sigmoid(self.curve[0] * _logit(m) + self.curve[1])


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def train(texts: list, labels: list[int], l2: float = 1.0, steps: int = STEPS) -> Model:
    """Maximum likelihood by Adam on the full sample; labels of one class only give a flat model."""
    x, sizes, starts = line_features([lines_of(t) for t in texts]) if len(texts) else (
        np.zeros((0, 3 * OWN + 2)), np.zeros(0), np.zeros(1, np.int64))
    width = x.shape[1]
    mean = x.mean(0) if len(x) else np.zeros(width)
    scale = np.maximum(x.std(0), 1e-3) if len(x) else np.ones(width)
    model = Model(np.zeros(width + 1), np.zeros((2, 2)), mean, scale, (1.0, 0.0))
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        model.curve = (1.0, 2.0 if labels and labels[0] else 0.0)
        return model
    counts = np.diff(starts)
    of_line = np.repeat(y, counts)
    # a document counts once, however many lines it has
    share = np.repeat(1 / counts, counts)
    xb = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    seen = np.diag([float((counts - 1)[y == 0].sum()), float((counts - 1)[y == 1].sum())])
    flat = np.zeros(width + 5)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    n = len(texts)
    for step in range(1, steps + 1):
        w, trans = flat[:-4], flat[-4:].reshape(2, 2)
        good, pairs = forward_backward(xb @ w, starts, trans)
        g = np.concatenate([xb.T @ ((of_line - good) * share) / n - l2 / n * w,
                            ((seen - pairs) / max(1, len(x)) - l2 / 100 * trans).ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        flat = flat + 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    model.weights, model.trans = flat[:-4], flat[-4:].reshape(2, 2)
    w, b = logistic(_logit(model.quality(x, sizes, starts))[:, None], y)
    model.curve = (float(w[0]), b)
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES, folds: int = 3,
        held: int = 1) -> Model:
    """The field fitted on labelled rows outside the held-out fold: at most ``sample`` documents (those of
    smallest hash of the doc_id), one row of each doc_id, and at most ``sample_lines`` lines in a row of each.
    Rows without doc_id or label teach nothing."""
    known = (labels.select("doc_id", F.col("quality").cast("int").alias("y"))
             .where("doc_id IS NOT NULL AND y IS NOT NULL").where(F.pmod(doc_crc(), F.lit(folds)) != held)
             .groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    lines = F.filter(F.split(text_or_empty("text"), "\n"), lambda x: x.rlike(r"\S"))
    spare = F.greatest(F.size("lines") - sample_lines, F.lit(0))
    first = F.pmod(F.xxhash64("doc_id"), spare + 1).cast("int") + 1
    block = F.array_join(F.slice("lines", first, sample_lines), "\n")
    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``sample`` small rows
            .select("doc_id", "y", lines.alias("lines")).select("doc_id", "y", block.alias("text"))
            .withColumn("text", F.when(F.octet_length("text") > SAMPLE_BYTES, F.substring("text", 1, SAMPLE_BYTES // 4))
                        .otherwise(F.col("text")))
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).orderBy("doc_id").collect())
    return train([r["text"] for r in rows], [r["y"] for r in rows])


def score_documents(docs: DataFrame, model: Model, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted per input row.

    Null and empty texts are one empty line and get a score like any other; repeated rows score alike; a
    row without doc_id is scored too; other columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession, 500)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()), dtype="float64")

    return (docs.select("doc_id", (F.pmod(doc_crc(), F.lit(folds)) == held).alias("held_out"),
                        score(text_or_empty("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
