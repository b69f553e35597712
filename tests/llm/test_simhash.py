import numpy as np
import xxhash

from brute import Sets, words
from inkwell.llm import simhash


def fingerprint(text, n=3):
    w = words(text)
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def linked(fps, bits=3):
    s = Sets(fps)
    arr = np.array(sorted(fps), np.uint64)
    for f in arr:
        for g in arr[np.bitwise_count(arr ^ f) <= bits]:
            s.join(int(f), int(g))
    return s


def near_fps(seed, many, most):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(many):
        x = 0x123456789ABCDEF0
        for b in rng.integers(0, 64, rng.integers(0, most)):
            x ^= 1 << int(b)
        out.add(x)
    return out


def check_links(spark, fps, bits=3):
    arr = np.array(sorted(fps), np.uint64).view(np.int64)
    edges = simhash.links(spark.createDataFrame([(int(x),) for x in arr], "fp long"), bits).collect()
    s = Sets(fps)
    mask = (1 << 64) - 1
    for e in edges:
        s.join(e.a & mask, e.b & mask)
    t = linked(fps, bits)
    assert {f: s.find(f) for f in fps} == {f: t.find(f) for f in fps}
    return edges


def test_links_lose_nothing(spark):
    rng = np.random.default_rng(1)
    far = {int(x) for x in rng.integers(0, 1 << 63, 300)}
    check_links(spark, near_fps(0, 400, 8) | far | {0, 7, (1 << 64) - 1})
    check_links(spark, near_fps(2, 200, 6), bits=1)


def test_hot_buckets_are_indexed_further(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 32)
    check_links(spark, near_fps(3, 1500, 7))


def test_lookup_links_like_comparison():
    base, fps = 0xABCDEF, set()
    rng = np.random.default_rng(4)
    for _ in range(300):
        x = base
        for b in rng.integers(0, 18, rng.integers(0, 9)):
            x ^= 1 << int(b)
        fps.add(x)
    arr = np.array(sorted(fps), np.uint64)
    a, b = simhash.link_by_lookup(arr, list(range(18)), 3)
    s = Sets(fps)
    for x, y in zip(a.tolist(), b.tolist()):
        s.join(x, y)
    t = linked(fps)
    assert {f: s.find(f) for f in fps} == {f: t.find(f) for f in fps}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 5000), (5000, 3000)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[5000] == got[3000] == 1000


def test_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = simhash.near_dedup(odd_docs).collect()
    fps = [fingerprint(t) for _, t in rows]
    t = linked(set(fps))
    first = {}
    for (i, _), f in zip(rows, fps):
        r = t.find(f)
        first[r] = min((x for x in (first.get(r), i) if x is not None), default=None)
    want = sorted(((i, f"{f:016x}", first[t.find(f)]) for (i, _), f in zip(rows, fps)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    left = simhash.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == len({t.find(f) for f in fps})
    assert simhash.near_dedup(no_docs).count() == 0 and simhash.drop_near_copies(no_docs).count() == 0
