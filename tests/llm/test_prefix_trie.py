"""The trie against plain Python: odd rows, long chains, many equal conversations, shared heads."""

import hashlib
import math
import random
import zlib

import pytest

from inkwell.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, parent long, n long, kids long"


def brute(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            x = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, x, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:])
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(built[c][:d], []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for s in nodes:
        if s:
            kids[s[:-1]] = kids.get(s[:-1], 0) + 1
    for s, members in nodes.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(members) - 1) * len(s[-1][1]) if s else 0
    return [(m[0], len(s), nodes[s[:-1]][0] if s else None, len(m), kids.get(s, 0), leaves[s], saved[s],
             hashlib.sha256(",".join(str(c) for c in m if built[c] == s).encode()).hexdigest()) for s, m in nodes.items()]


def same(spark, rows):
    got = prefix_trie.shared_trie(spark.createDataFrame(rows, SCHEMA).repartition(3)).drop("key").collect()
    key = lambda r: tuple(map(str, r))
    return sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def turn(c, t, role, text):
    return c, t, role, text, "k", 1, 2, 3


def test_odd_rows(spark):
    rows = [turn(5, None, None, None), turn(5, None, "user", ""), turn(5, 1, "user", "é"), turn(5, 1, "user", "é"),
            turn(5, 1, "assistant", "x"), turn(None, 1, "user", "none"), turn(200, 0, "user", "w " * 100_000),
            turn(207, 0, "user", "a"), turn(207, 0, "user", "a"), turn(-3, 0, "user", "n"), turn(0, 3, "", "z")]
    assert same(spark, rows)
    assert prefix_trie.shared_trie(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("chunk", [64, 3])
def test_trees(spark, monkeypatch, chunk):
    """Random shared openings, a long conversation that branches late, a group of equal conversations; three turns a
    chunk need several levels of chunks."""
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    rng = random.Random(chunk)
    rows = [turn(c, t, "user" if t % 2 == 0 else "assistant", rng.choice("ab") * rng.randint(0, 2))
            for c in range(130) for t in range(rng.randint(0, 6))]
    long = 200 if chunk == 64 else 40
    rows += [turn(c, t, "user", f"same {t}" if t != late else f"other {c}") for c, late in ((300, -1), (301, long - 2), (302, 65))
             for t in range(long)]
    rows += [turn(1000 + c, t, "user", f"hot {t}") for c in range(60) for t in range(3)]
    assert same(spark, rows)


def test_contraction_of_a_chain_takes_few_rounds(spark):
    n = 500
    chain = spark.range(n).selectExpr("id", "CASE WHEN id > 0 THEN id - 1 END AS parent", f"CAST(id = {n - 1} AS LONG) AS leaves",
                                      "id AS tokens", f"CAST(id < {n - 1} AS LONG) AS kids", f"if(id < {n - 1}, id + 1, 0L) AS kid")
    rounds, root = prefix_trie.contract(chain)
    assert len(rounds) <= 24
    got = {r.id: (r.leaves, r.tokens) for r in prefix_trie.totals(chain).collect()}
    assert got == {i: (1, sum(range(i, n))) for i in range(n)}
