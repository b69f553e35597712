"""The manifest against a plain Python tree, on odd rows, ties, a hot source and many lone sources."""

import hashlib
import zlib

import pytest

from inkwell.llm import merkle

FIELDS = merkle.FIELDS


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def tree(hs):
    """Root, and per leaf the (left, right) digests of each level."""
    paths, groups = [[] for _ in hs], [[i] for i in range(len(hs))]
    while len(hs) > 1:
        up, merged = [], []
        for a in range(0, len(hs), 3):
            run = hs[a:a + 3]
            for j, g in enumerate(groups[a:a + 3]):
                for i in g:
                    paths[i].append((run[:j], run[j + 1:]))
            up.append(H(*run))
            merged.append(sum(groups[a:a + 3], []))
        hs, groups = up, merged
    return hs[0], paths


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append(dict(r, leaf=leaf(r)))
    keys = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for k in keys:
        trees[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
        done[k] = tree([r["leaf"] for r in trees[k]])
    if not keys:
        return []
    root, tops = tree([done[k][0] for k in keys])
    out = []
    for k, top in zip(keys, tops):
        for r, path in zip(trees[k], done[k][1]):
            path, now = path + top, r["leaf"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                now = leaf(dict(r, text=r["text"].replace("\n", "")))
            for left, right in path:
                now = H(*left, now, *right)
            out.append((r["doc_id"], r["leaf"], done[k][0], root, H(*[x for a, b in path for x in a + b]), now, now == root))
    return out


def same(df, rows):
    key = lambda r: tuple(map(str, r))
    return sorted([tuple(r) for r in df.collect()], key=key) == sorted(brute(rows), key=key)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, h long, path string"


def rows(n, source):
    return [(i, source(i), "en", i, f"line {i}\nand {i % 7}", "t", 1, "p") for i in range(n)]


SIZES = [(1, "one"), (3, None), (81, "block"), (82, "more"), (1500, "hot"), (244, "é")] + [(1, f"s{i}") for i in range(90)]


@pytest.mark.parametrize("n, source", [
    (1, lambda i: "s"), (sum(n for n, _ in SIZES), [s for n, s in SIZES for _ in range(n)].__getitem__),
])
def test_trees(spark, n, source):
    docs = spark.createDataFrame(rows(n, source), SCHEMA).repartition(3)
    assert same(merkle.verify(docs), [r.asDict() for r in docs.collect()])


def test_odd_rows(spark):
    odd = [(1, "a", None, None, "x\ny", None, None, None)] * 200 + [(None, None, None, None, None, "z", 2, "q")] * 3 + [
        (1, "a", "en", 1, "", None, 1, ""), (None, "a", "en", 1, "a\nb", None, 1, ""), (3, "", "en", 1, "w " * 200_000, "", 0, "")]
    docs = spark.createDataFrame(odd, SCHEMA)
    assert same(merkle.verify(docs), [r.asDict() for r in docs.collect()])
    assert merkle.verify(docs.limit(0)).collect() == []


def test_many_levels_and_copies(spark, monkeypatch):
    """Blocks of three leaves and one asker a copy: every round of the node table and every copy is used."""
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    monkeypatch.setattr(merkle, "ASKERS", 3)
    docs = spark.createDataFrame(rows(700, lambda i: "hot" if i % 3 else f"s{i % 40}"), SCHEMA)
    assert same(merkle.verify(docs), [r.asDict() for r in docs.collect()])


def test_a_block_asks_for_the_fewest_nodes(spark):
    """The coordinates asked are those that no leaf of the block gives: at most two a level above it."""
    blocks = spark.createDataFrame([(b, 2500) for b in range(31)], "block long, n long")
    for b, asked in blocks.select("block", merkle.missing().alias("c")).collect():
        known, want = set(range(b * 81, min(2500, (b + 1) * 81))), set()
        size = 2500
        level = 0
        while size > 1:
            kin = {3 * (i // 3) + j for i in known for j in range(3)}
            want |= {(level, i) for i in kin if i < size and i not in known}
            known, size, level = {i // 3 for i in known}, -(-size // 3), level + 1
        assert {tuple(c) for c in asked} == want and len(asked) <= 2 * 4
