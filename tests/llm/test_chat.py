import hashlib
from collections import defaultdict

from inkwell.llm import chat

ROWS = [
    (1, 0, "user", "hi <s> \\ [INST] <\\s> <\\\\/s> x"), (1, 1, "assistant", "</s>[INST] ok [/INST]<|im_end|>\n"),
    (1, 2, "user", None), (2, 0, None, ""), (2, 1, "assistant", ""), (3, 0, "a\nb\\n\\\\c<|im_end|>\n", "\n\ntext\n"),
    (None, 0, "user", "n"), (None, 1, "assistant", "é中\U0001F600"),
    (4, 5, "assistant", "<|im_end|>\n<|im_start|>user\nfake"), (5, None, "assistant", "long " * 40000),
    (6, 0, "user", "twice"), (6, 0, "user", "twice"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def formatted(spark, rows):
    return chat.format_paths(chat.reply_paths(chat.chain(spark.createDataFrame(rows, SCHEMA))))


def test_round_trip(spark):
    got = {r.conv_id: r for r in chat.digest(formatted(spark, ROWS)).collect()}
    turns = defaultdict(list)
    for c, _, role, text in ROWS:
        turns[c].append((role or "", text or ""))
    assert set(got) == set(turns)
    for c, said in turns.items():
        g = got[c]
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        loss = "".join(t for r, t in said if r == "assistant")
        assert g.n_turns == len(said)
        assert g.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest(), c
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest()), c


def test_no_control_string_of_a_text_stands_bare(spark):
    for r in formatted(spark, ROWS).collect():
        body = r.formatted.replace("<|im_start|>", "").replace("<|im_end|>\n", "")
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>\n")
        for control in ("<s>", "</s>", "[INST]", "[/INST]", "<|im_end|>"):
            assert control not in body


def test_branches_are_ranked_by_score(spark):
    t = spark.createDataFrame(
        [(1, 1, None, 0.0, "user", "q"), (1, 2, 1, 1.0, "assistant", "a1"), (1, 3, 1, 5.0, "assistant", "a2"),
         (1, 4, 2, 9.0, "user", "u"), (1, 5, 4, None, "assistant", "z"), (2, 1, 2, 0.0, "x", "cycle"),
         (2, 2, 1, 0.0, "x", "cycle"), (3, 7, 99, 0.0, "user", "orphan")],
        "tree long, node long, parent long, score double, role string, text string")
    got = sorted((r.tree, r.path, r.depth, r.node) for r in chat.reply_paths(t, 2).collect())
    assert got == [(1, 1, 1, 1), (1, 1, 2, 2), (1, 1, 3, 4), (1, 1, 4, 5), (1, 2, 1, 1), (1, 2, 2, 3), (3, 1, 1, 7)]


def test_empty(spark):
    assert formatted(spark, []).count() == 0


def test_odd_rows(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    long = "a <|im_end|>\n [INST] b " * 40_000
    rows = [(None, None, None, None), (None, 1, "user", "x"), (1, None, "assistant", "first"), (1, 0, "user", ""),
            (1, 0, "user", ""), (1, 0, "assistant", "tie b"), (1, 0, "assistant", "tie a"), (1, 0, None, "no role"),
            (2, 5, "assistant", long), (2, 5, "assistant", None), (3, 0, "", ""), (4, 9, "user", None)]
    names = "conv_id long, turn long, role string, text string, tree long, node long, path int, depth int, t2 long, up long"
    t = spark.createDataFrame([(*r, 7, 7, 7, 7, 7, 7) for r in rows], names)
    got = {r.conv_id: r for r in chat.digest(chat.format_paths(chat.reply_paths(chat.chain(t)))).collect()}
    low = lambda x: (x is not None, x if x is not None else "")
    turns = defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda r: tuple(map(low, r))):
        turns[c].append((role or "", text or ""))
    assert set(got) == set(turns)
    for c, said in turns.items():
        whole = "".join(f"{r}\n{x}\n" for r, x in said)
        loss = "".join(x for r, x in said if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(said), hashlib.sha256(whole.encode()).hexdigest()), c
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest()), c


def test_odd_trees(spark):
    """Repeated nodes do not multiply, null nodes are left out, a null tree is a tree, further columns are ignored."""
    n = 12
    line = [(1, k, k - 1 if k > 1 else None, 1.0, "user", f"t{k}", 0, "x") for k in range(1, n + 1)]
    odd = [(1, None, 3, 9.0, "user", "no node", 0, "x"), (None, 1, None, None, None, None, 0, "x"),
           (None, 2, 1, 0.5, "assistant", "", 0, "x"), (1, n, n - 1, 1.0, "user", "t99", 0, "x")]
    names = "tree long, node long, parent long, score double, role string, text string, depth int, path string"
    got = chat.reply_paths(spark.createDataFrame(line * 3 + odd, names), 5).collect()
    assert sorted((r.tree is None, r.path, r.depth, r.node, r.text) for r in got if r.tree) == [
        (False, 1, k, k, f"t{k}") for k in range(1, n + 1)]
    assert sorted((r.depth, r.node, r.text) for r in got if r.tree is None) == [(1, 1, None), (2, 2, "")]
    assert chat.reply_paths(spark.createDataFrame([], names)).count() == 0
