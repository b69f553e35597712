import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from inkwell.llm import suffix_dedup


def brute(texts, w):
    seen = Counter(t[i:i + w] for t in texts for i in range(len(t) - w + 1))
    out = []
    for t in texts:
        covered = [False] * len(t)
        for i in range(len(t) - w + 1):
            if seen[t[i:i + w]] > 1:
                covered[i:i + w] = [True] * w
        kept = bytes(b for b, x in zip(t, covered) if not x)
        runs = sum(x and not (i and covered[i - 1]) for i, x in enumerate(covered))
        out.append((len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_passages(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rnd.randint(5, 40))) for _ in range(6)]
    texts = []
    for _ in range(100):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            parts.append(rnd.choice(passages) if rnd.random() < 0.4
                         else " ".join(word() for _ in range(rnd.randint(1, 60))))
            if rnd.random() < 0.1:
                parts.append("na " * rnd.randint(10, 80))
        texts.append(" ".join(parts))
    return texts + ["", None, texts[0], "x" * 300, "x" * 300]


@pytest.mark.parametrize("window,token,hot,run", [(60, 16, 10**6, 1000), (60, 8, 3, 1000), (100, 40, 10**6, 50)])
def test_removes_exactly_the_covered_bytes(spark, window, token, hot, run):
    texts = texts_with_passages(window + token)
    df = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, h string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.remove_repeats(df, window, token, hot, run).collect()}
    want = brute([(t or "").encode() for t in texts], window)
    assert [got[i] for i in range(len(texts))] == want


def test_anchors_do_not_depend_on_the_block():
    rnd = random.Random(1)
    data = bytes(rnd.choice(b"ab cd") for _ in range(5000)) + b"na " * 400
    whole = suffix_dedup.anchors(data, 100, 20)
    for block in (64, 333, 4096):
        parts = suffix_dedup.anchors(data, 100, 20, block)
        windows = lambda a: {(int(p), x) for p, _, lo, hi in zip(*a) for x in range(int(lo), int(hi) + 1)}
        assert windows(parts) == windows(whole)
    assert sorted(p - x for p, x in windows(whole)) == list(range(len(data) - 99))


def test_sorted_blocks():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 2, (500, 21)).astype(np.uint8)
    rows[100:140] = rows[0]
    order, prefix = suffix_dedup.sorted_blocks(rows)
    want = sorted(bytes(r) for r in rows)
    assert [bytes(rows[i]) for i in order] == want
    common = [next((k for k in range(21) if a[k] != b[k]), 21) for a, b in zip(want, want[1:])]
    assert prefix.tolist() == [0, *common]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect()]
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], 400))), key=repr)
    got = suffix_dedup.remove_repeats(odd_docs, with_text=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
