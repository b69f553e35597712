"""Metrics against independent Python models (written from the definitions)."""

import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.operators import metrics as MT
from inkwell.operators.stemming import clipped_upto


def lcs_dp(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=80), st.lists(st.sampled_from("abcde"), max_size=80))
def test_lcs_bit_parallel(a, b):
    assert MT.lcs_length(a, b) == lcs_dp(a, b)


def toks(t):
    return re.findall("[a-z0-9]+", t.lower())


def grams(t, n):
    return [tuple(t[i:i + n]) for i in range(len(t) - n + 1)]


def rouge_n(pred, ref, n):
    p, r = Counter(grams(toks(pred), n)), Counter(grams(toks(ref), n))
    o = sum(min(c, p[g]) for g, c in r.items())
    P, R = o / max(sum(p.values()), 1), o / max(sum(r.values()), 1)
    return 2 * P * R / (P + R) if P + R > 0 else 0.0


def bleu(pairs):
    num, den, hl, rl = [0] * 4, [0] * 4, 0, 0
    for pred, ref in pairs:
        h, r = pred.split(), ref.split()
        hl, rl = hl + len(h), rl + len(r)
        for n in range(1, 5):
            hc, rc = Counter(grams(h, n)), Counter(grams(r, n))
            num[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
            den[n - 1] += max(1, sum(hc.values()))
    if num[0] == 0:
        return 0.0
    bp = 1.0 if hl > rl else (0.0 if hl == 0 else math.exp(1 - rl / hl))
    ps = [(0.1 / d) if x == 0 else x / d for x, d in zip(num, den)]
    return bp * math.exp(sum(0.25 * math.log(p) for p in ps))


WORDS = ["the", "The", "plan", "meeting", "a", "budget", "Budget", "review", "x1", "ok."]


def _texts(rng, k):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, k)))


def test_rouge_bleu_distinct_against_models(spark):
    rng = random.Random(7)
    rows = [("m", str(i), "compose", "p", _texts(rng, 30), _texts(rng, 30)) for i in range(60)]
    rows.append(("m", "empty", "compose", "p", "", ""))
    df = spark.createDataFrame(rows, "model_name string, sample_id string, task_type string, prompt string, "
                                     "prediction string, reference string")
    got = {r["sample_id"]: r for r in MT.pair_scores(df, stem=False).collect()}
    for _, sid, _, _, pred, ref in rows:
        g = got[sid]
        assert abs(g["rouge1"] - rouge_n(pred, ref, 1)) < 1e-12
        assert abs(g["rouge2"] - rouge_n(pred, ref, 2)) < 1e-12
        a, b = toks(pred), toks(ref)
        want_l = 0.0 if not a or not b else (lambda l: 0.0 if l == 0 else 2 * (l / len(a)) * (l / len(b)) / (l / len(a) + l / len(b)))(lcs_dp(a, b))
        assert abs(g["rougeL"] - want_l) < 1e-12
        assert abs(g["bleu"] - bleu([(pred, ref)])) < 1e-9
    ev = {r["metric"]: r["value"] for r in MT.evaluate(df).collect()}
    assert abs(ev["bleu"] - bleu([(p, r) for *_, p, r in rows])) < 1e-9
    all_grams = [g for *_, p, _ in rows for g in grams(p.lower().split(), 2)]
    assert abs(ev["distinct_2"] - len(set(all_grams)) / len(all_grams)) < 1e-12


def test_format_compliance_rules(spark):
    texts = ["Dear team,\n\nbody text long enough here.\n\nBest regards,\nA", "history lesson", "Hi\nthanks",
             "Hello-there friend, long enough body text\nCheers.", "hi5 no\nregards x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from pyspark.sql import functions as F
    got = [(r[0], r[1], r[2]) for r in df.select(MT.has_greeting(F.col("t")), MT.has_body(F.col("t")),
                                                   MT.has_closing(F.col("t"))).collect()]
    g = re.compile(r"^(dear\b|hi\b|hello\b|hey\b|good\s+(?:morning|afternoon|evening)\b|greetings\b|to whom)", re.I | re.M)
    c = re.compile(r"(regards|sincerely|best|thanks|thank you|cheers|warm regards|kind regards|respectfully|"
                   r"take care|all the best|cordially)\s*[,.]?\s*$", re.I | re.M)
    assert got == [(bool(g.search(t)), len(t.strip()) >= 20, bool(c.search(t))) for t in texts]


def test_stemmed_rouge_against_model(spark):
    from inkwell.functions.porter import stem

    def stoks(t):
        return [stem(w) if len(w) > 3 else w for w in toks(t)]

    def rouge_s(pred, ref, n):
        p, r = Counter(grams(stoks(pred), n)), Counter(grams(stoks(ref), n))
        o = sum(min(c, p[g]) for g, c in r.items())
        P, R = o / max(sum(p.values()), 1), o / max(sum(r.values()), 1)
        return 2 * P * R / (P + R) if P + R > 0 else 0.0

    words = ["running", "runs", "connected", "connection", "the", "generalization", "general", "ponies", "a"]
    rng = random.Random(9)
    rows = [("m", str(i), "t", "p", " ".join(rng.choice(words) for _ in range(rng.randint(0, 15))),
             " ".join(rng.choice(words) for _ in range(rng.randint(0, 15)))) for i in range(40)]
    df = spark.createDataFrame(rows, "model_name string, sample_id string, task_type string, prompt string, "
                                     "prediction string, reference string")
    got = {r["sample_id"]: r for r in MT.pair_scores(df, stem=True).collect()}
    for _, sid, _, _, pred, ref in rows:
        assert abs(got[sid]["rouge1"] - rouge_s(pred, ref, 1)) < 1e-12
        assert abs(got[sid]["rouge2"] - rouge_s(pred, ref, 2)) < 1e-12
        a, b = stoks(pred), stoks(ref)
        lcs = lcs_dp(a, b)
        want = 0.0 if not a or not b or lcs == 0 else 2 * (lcs / len(a)) * (lcs / len(b)) / (lcs / len(a) + lcs / len(b))
        assert abs(got[sid]["rougeL"] - want) < 1e-12


def test_results_independent_of_partitioning(spark):
    from inkwell.sources import tables as T
    from small_tables import SF_SMALL
    pairs = T.pairs(spark, SF_SMALL)
    a = {(r["model_name"], r["sample_id"]): (r["rouge1"], r["rouge2"], r["bleu"])
         for r in MT.pair_scores(pairs.repartition(1), with_lcs=False, stem=False).collect()}
    b = {(r["model_name"], r["sample_id"]): (r["rouge1"], r["rouge2"], r["bleu"])
         for r in MT.pair_scores(pairs.repartition(5), with_lcs=False, stem=False).collect()}
    assert a == b and len(a) > 0


def test_stems_as_rouge_tools_give_them():
    from inkwell.functions.porter import rouge_stem

    want = {"days": "day", "day": "day", "says": "say", "say": "say", "ways": "way", "keys": "key", "dying": "die",
            "skies": "sky", "news": "news", "flies": "fli", "dies": "die", "tied": "tie", "enjoy": "enjoy",
            "happily": "happili", "generally": "gener", "geology": "geolog", "proceed": "proceed", "agreed": "agre",
            "plastered": "plaster", "motoring": "motor", "conflated": "conflat", "troubled": "troubl", "sized": "size",
            "hopping": "hop", "falling": "fall", "hissing": "hiss", "failing": "fail", "filing": "file",
            "relational": "relat", "hopefully": "hope", "adjustable": "adjust", "controll": "control"}
    assert {w: rouge_stem(w) for w in want} == want


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_compute_only_what_is_asked(spark):
    """Stemmed ROUGE and the LCS: one Python node, no shuffle, no exploded grams."""
    rows = [("m", str(i), "t", "p", "a b c d", "a b x") for i in range(10)]
    df = spark.createDataFrame(rows, "model_name string, sample_id string, task_type string, prompt string, "
                                     "prediction string, reference string")
    for scores in (MT.pair_scores(df, with_bleu=False), MT.pair_scores(df, stem=False, with_rouge=False, with_bleu=False),
                   MT.shown(df, rouge1=True)):
        plan = _plan(scores)
        assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Generate" not in plan
    plan = _plan(MT.shown(df))
    assert "Python" not in plan and "Exchange" not in plan
    for scores in (MT.pair_scores(df, features=True), MT.pair_scores(df, with_rouge=False, with_lcs=False),
                   MT.pair_scores(df, stem=False, with_lcs=False)):
        plan = _plan(scores)
        assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Generate" not in plan
    assert "ArrowEvalPython" in _plan(MT.bleu_corpus(df)) and "Generate" not in _plan(MT.bleu_corpus(df))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=30), st.lists(st.sampled_from("abc"), max_size=30))
def test_clipped_counts_inside_the_row(a, b):
    want = []
    for n in (1, 2, 3, 4):
        p, r = ([tuple(t[i:i + n]) for i in range(len(t) - n + 1)] for t in (a, b))
        want.append(sum(min(p.count(g), r.count(g)) for g in set(p)))
    assert clipped_upto(a, b, 4) == want


def test_bleu_tokens_are_those_of_split(spark):
    """Odd white space, empty texts and a very long text; every asked subset of counts agrees."""
    from inkwell.functions.text import PY_WS_CHARS
    texts = ["a\x1cb\u00a0c", "", " \n", "x" + PY_WS_CHARS + "y", "İ ß i̇", "w " * 20_000 + "end", "a b c d e"]
    rows = [("m", f"{i}:{j}", p, r) for i, p in enumerate(texts) for j, r in enumerate(texts)]
    df = spark.createDataFrame(rows, "model_name string, sample_id string, prediction string, reference string")
    got = {r.sample_id: r for r in MT.pair_scores(df, with_rouge=False, with_lcs=False).collect()}
    both = {r.sample_id: r for r in MT.pair_scores(df).collect()}
    for _, i, p, r in rows:
        a, b = p.split(), r.split()
        assert (got[i].hyp_len, got[i].ref_len) == (len(a), len(b))
        assert [got[i][f"bleu_num_{n}"] for n in (1, 2, 3, 4)] == clipped_upto(a, b, 4)
        assert got[i].bleu == both[i].bleu


def test_embedding_match_against_model(spark):
    """Vectors by dictionary: against every token with its own vector; missing vectors, empty and null sides."""
    import hashlib

    import numpy as np

    from inkwell.operators.embedding import embedding_match
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=5).astype(np.float32) for i in range(40) if i % 9}
    table = [(i, vectors.get(i, [0.0] * 5) if i % 9 else None) for i in range(40)]
    emb = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in table],
                                "vec_id long, embedding array<float>")
    words = [f"Word{i}" for i in range(60)]
    texts = ["", " ", "word1", *[" ".join(rng.choice(words, size=rng.integers(1, 30))) for _ in range(20)]]
    rows = [("m", str(k), str(rng.choice(texts)), str(rng.choice(texts))) for k in range(80)] + [("m", "n", None, "a")]
    got = {r.sample_id: tuple(r)[2:] for r in embedding_match(spark.createDataFrame(
        rows, "model_name string, sample_id string, prediction string, reference string"), emb).collect()}
    assert len(got) == len(rows)

    def unit(t):
        v = vectors.get(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) % 40)
        return np.zeros(5) if v is None else v.astype(float) / np.linalg.norm(v.astype(float))

    for _, k, p, r in rows:
        p, r = (p or "").lower().split(), (r or "").lower().split()
        want = (0.0, 0.0, 0.0)
        if p and r:
            sim = np.array([[unit(a) @ unit(b) for b in r] for a in p])
            x, y = sim.max(1).mean(), sim.max(0).mean()
            want = (x, y, 2 * x * y / (x + y) if x + y > 0 else 0.0)
        assert np.allclose(got[k], want, atol=1e-9), (k, got[k], want)


def test_vectors_move_once_a_partition(spark):
    """A vector is joined once per partition that needs it, not once per token."""
    from inkwell.operators.embedding import embedding_match
    emb = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(8)], "vec_id long, embedding array<float>")
    df = spark.createDataFrame([("m", str(i), "a b c d " * 50, "a b x " * 50) for i in range(50)],
                               "model_name string, sample_id string, prediction string, reference string")
    plan = _plan(embedding_match(df, emb))
    assert "collect_list" not in plan and "MapInArrow" in plan


def test_vectors_of_a_worker_are_bounded(spark, monkeypatch):
    """A vector table beyond HELD_MB: more groups than partitions, each with few vectors, and the same scores."""
    import numpy as np
    import pyarrow as pa

    from inkwell.operators import embedding as EM
    rng = np.random.default_rng(5)
    n, dim = 3000, 8
    emb = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=dim)]) for i in range(n)],
                                "vec_id long, embedding array<float>")
    text = lambda: " ".join(f"w{i}" for i in rng.integers(0, 9000, size=20))
    df = spark.createDataFrame([("m", str(k), text(), text()) for k in range(300)] + [(None, None, text(), "w1")] * 2,
                               "model_name string, sample_id string, prediction string, reference string").repartition(3)

    def scores():
        return sorted((r.sample_id or "", r.precision, r.recall, r.f1) for r in EM.embedding_match(df, emb).collect())

    whole = scores()
    held = 500
    monkeypatch.setattr(EM, "HELD_MB", held * 4 * dim / 2 ** 20)
    assert EM.groups_needed(300 * 40, n, dim) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert np.allclose([x[1:] for x in scores()], [x[1:] for x in whole], atol=1e-12) and len(whole) == 302
    # so many numbers give about ``held`` different ones in each group
    groups = EM.groups_needed(10 ** 6, n, dim)
    assert len(np.unique(rng.integers(0, n, size=10 ** 6 // groups))) < 1.1 * held

    # what a worker holds is one group's, however many groups a partition has
    sizes = []
    close = EM.Dictionary.close
    monkeypatch.setattr(EM.Dictionary, "close", lambda self: (close(self), sizes.append(len(self.numbers)))[0])
    row = lambda g, vid, v, p: dict(part=g, vid=vid, v=v, pred=p, ref=p, k="x")
    schema = pa.schema([("part", pa.int32()), ("vid", pa.int64()), ("v", pa.list_(pa.float32())), ("pred", pa.list_(pa.int64())),
                        ("ref", pa.list_(pa.int64())), ("k", pa.string())])
    rows = [r for g in range(6) for r in [row(g, g, [1.0, 0.0], None), row(g, g + 9, [0.0, 1.0], None), row(g, None, None, [g, g + 9])]]
    batches = pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=4)
    got = pa.Table.from_batches(list(EM._score(["k"])(iter(batches)))).to_pylist()
    assert sizes == [2] * 6 and [r["f1"] for r in got] == [1.0] * 6


def test_pair_counts_hold_few_python_objects():
    """A large batch stays in Arrow's form: only some of its pairs are Python strings at once."""
    import tracemalloc

    import pyarrow as pa

    from inkwell.operators.stemming import lcs_length, pair_counts
    n = 4000
    texts = [" ".join(f"t{(i + j) % 50}" for j in range(60)) for i in range(n)]
    text, tokens = pa.array(texts), pa.array([t.split() for t in texts])
    count = pair_counts(True, True, True, 4).func
    count(text[:10], text[:10], tokens[:10], tokens[:10])
    tracemalloc.start()
    got = count(text, text, tokens, tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == n and got[7].as_py() == {"rouge": [60, 59], "lcs": lcs_length(tokens[7].as_py(), tokens[7].as_py()),
                                                "bleu": [60, 59, 58, 57], "hyp_len": 60, "ref_len": 60}
    assert peak < 4_000_000, peak  # as lists of strings the batch takes over 25 MB
    assert len(count(text[:0], text[:0], tokens[:0], tokens[:0])) == 0
