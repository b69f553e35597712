"""Held-out accuracy of the learned scorers, and the language model against plain arithmetic."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from brute import words
from inkwell.llm import ngram_lm, quality, toxicity

SF = "/root/testdata/sf0.1"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def held_out(result, labels, column):
    y = {r.doc_id: r[column] for r in labels.collect()}
    return [(r.score, r.predicted, y[r.doc_id]) for r in result.collect() if r.held_out and y.get(r.doc_id) is not None]


def auc(rows):
    good = [s for s, _, y in rows if y]
    bad = [s for s, _, y in rows if not y]
    return np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])


def test_quality_held_out(spark):
    docs, labels = tables(spark)
    rows = held_out(quality.score_documents(docs, quality.fit(docs, labels)), labels, "quality")
    assert np.mean([p == y for _, p, y in rows]) > 0.97 and auc(rows) > 0.98


def test_toxicity_held_out(spark):
    docs, labels = tables(spark)
    y = {r.doc_id: r.toxic for r in labels.collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [(lang[r.doc_id], r.predicted, y[r.doc_id]) for r in
            toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect() if r.held_out and y.get(r.doc_id) is not None]
    assert np.mean([p for _, p, t in rows if t]) >= 0.85
    assert np.mean([p == 0 for _, p, t in rows if not t]) >= 0.97
    assert np.mean([t for _, p, t in rows if p]) >= 0.9
    for each in set(lang.values()):
        assert np.mean([p for la, p, t in rows if t and la == each]) >= 0.7


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    emit, trans = rng.normal(size=9), rng.normal(size=(2, 2))
    starts = np.array([0, 4, 5, 9])
    good, pairs = quality.forward_backward(emit, starts, trans)
    want, want_pairs = np.zeros(9), np.zeros((2, 2))
    for s, e in zip(starts, starts[1:]):
        total, mass, moves = 0.0, np.zeros(e - s), np.zeros((2, 2))
        for code in range(1 << (e - s)):
            y = [code >> k & 1 for k in range(e - s)]
            p = math.exp(sum((emit[s + k] / 2) * (1 if y[k] else -1) for k in range(e - s))
                         + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += p
            mass += p * np.array(y)
            for a, b in zip(y, y[1:]):
                moves[a, b] += p
        want[s:e] = mass / total
        want_pairs += moves / total
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    model = quality.train(["good line one\ngood line two"] * 5 + ["!!! ### !!!\n!!! ###"] * 5, [1] * 5 + [0] * 5)
    got = quality.score_documents(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert quality.score_documents(no_docs, model).count() == 0
    labels = spark.createDataFrame([(None, None, None), (1, None, None), (1, 1, 0), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for t in (labels, labels.limit(0)):
        m = quality.fit(odd_docs, t)
        assert quality.score_documents(odd_docs, m).count() == odd_docs.count()


def test_quality_learns_from_long_and_repeated_documents(spark, monkeypatch):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1][:40]
    good, bad = "A calm sentence of several plain words.", "BUY!!! $$$ | *** !!!"
    rows = [(i, "\n\n".join([good if k % 2 else bad] * 300)) for k, i in enumerate(ids)]
    rows += [(ids[0], bad)] * 500 + [(ids[1], "ü" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    taught = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda texts, ys: taught.extend(zip(texts, ys)) or train(texts, ys))
    model = quality.fit(docs, labels, sample=40, sample_lines=20)
    assert len(taught) == 40 and sum(y for _, y in taught) == 20
    assert all(len(quality.lines_of(t)) <= 20 and len(t.encode()) <= quality.SAMPLE_BYTES for t, _ in taught)
    up, down = model.score([good + "\n" + good, bad + "\n" + bad])
    assert up > 0.5 > down


PLAIN = toxicity.Lexicon()
BASE, AIMED = toxicity.PRIOR, toxicity.PRIOR + toxicity.AIMED


def weight(clause, lexicon=PLAIN):
    return toxicity.read_clause(toxicity.WORD.findall(clause.lower()), lexicon)


def test_grammar_reads_clauses():
    assert weight("you are an idiot") == AIMED and weight("what an idiot") == BASE
    assert weight("that is not stupid") == pytest.approx(BASE * toxicity.DENIED)
    assert weight("a critic called it worthless") == pytest.approx(BASE * toxicity.SAID)
    assert weight("i will kill you") == AIMED and weight("the cold may kill the crops") == 0
    assert weight("nothing here at all") == 0
    assert weight("idiot idiot idiot") == BASE  # one clause, one score
    got, clauses = toxicity.clause_weights('It said "a real moron". What an idiot! Fine.', PLAIN)
    assert clauses == 3 and got == pytest.approx([BASE * toxicity.SAID, BASE])


def test_clause_weights_against_brute_force():
    """Clause by clause from the rules, with a learned lexicon of words and beginnings."""
    rng = random.Random(4)
    lexicon = toxicity.Lexicon({"zorp": (40, 38), "blarg*": (30, 29), "idiot": (50, 1), "meh": (50, 20), "rare": (4, 4)}, 1000, 100)
    odds = lambda n, t: math.log((t + 0.5) / 101) - math.log((n - t + 0.5) / 901)
    vocabulary = ["zorp", "blargon", "blarg", "idiot", "moron", "kill", "will", "you", "not", "said", "meh", "rare", "a", "b", "c"]
    direct = {"zorp": odds(40, 38), "blargon": odds(30, 29), "moron": toxicity.PRIOR, "kill": toxicity.PRIOR, "meh": odds(50, 20)}

    def brute(words):
        best = 0.0
        for i, w in enumerate(words):
            x = direct.get(w, 0.0)
            if not x or w == "meh" and x < toxicity.INFORMED:
                continue
            before, behind = words[max(0, i - toxicity.REACH):i], words[i + 1:i + 1 + toxicity.REACH]
            if w == "kill" and not ("will" in before and "you" in behind):
                continue
            x += toxicity.AIMED * ("you" in before or "you" in behind)
            x *= toxicity.DENIED if "not" in before else 1
            x *= toxicity.SAID if "said" in words[:i] else 1
            best = max(best, x)
        return best

    for _ in range(500):
        clauses = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 4))]
        got, n = toxicity.clause_weights(". ".join(" ".join(c) for c in clauses), lexicon)
        want = [x for x in map(brute, clauses) if x]
        assert got == pytest.approx(want) and n == (len(clauses) if n else 0)


def test_lexicon_is_counted_as_in_plain_python(spark):
    rows = [(i, f"word{i % 3} blarg{i % 5} common idiot" if i % 4 == 0 else f"word{i % 3} common") for i in range(200)] + [(900, None)]
    taught = spark.createDataFrame([(i, int(i % 4 == 0), t) for i, t in rows], "doc_id long, y int, text string")
    got = toxicity.learn_lexicon(taught, 201, 50)
    held, bad = collections.Counter(), collections.Counter()
    for i, t in rows:
        found = {e for w in toxicity.WORD.findall(t or "") for e in toxicity.entries(w)}
        held.update(found)
        bad.update(found if i % 4 == 0 else ())
    assert all(v == (held[e], bad[e]) for e, v in got.seen.items())
    assert {"blarg*", "idiot", "blarg0", "blarg4"} <= set(got.seen) and "common" not in got.seen and "word*" not in got.seen
    assert got.weight("blargnew") > 3 and got.weight("common") == 0
    assert got.entry_weight("blarg*", 1) < got.entry_weight("blarg*")


def spoken(text):
    """What kinds of matches a text of fixed words holds, by their weight."""
    names = {AIMED: "aimed insult", AIMED * toxicity.SAID: "reported"}
    return {names[w] for w in toxicity.clause_weights(text, PLAIN)[0]}


@pytest.mark.parametrize("a, b", ['""', "“”", "„“", "«»", "»«", "””"])
def test_quotations_of_any_length(a, b):
    long = "all of it was fine and well " * 15
    direct = f"{a}{long}.{b} You are an idiot. {a}ok{b}"
    assert set(spoken(direct)) == {"aimed insult"}  # stands between two quotations
    assert set(spoken(f"{a}{long}\n{long}.{b} You are an idiot. {a}ok{b}")) == {"aimed insult"}
    assert set(spoken(f"{a}{long}. You are an idiot. {long}{b} ok")) == {"reported"}
    assert set(spoken(f"{a}One line.\nYou are an idiot.\nA third.{b} ok")) == {"reported"}
    assert set(spoken(f"The end. {a}You are an idiot.{b} Fine.")) == {"reported"}
    assert set(spoken(f"{a}A {a}good{b} word. You are an idiot. Then so.{b}")) == {"reported"} or a == "”"


def test_quotations_stray_and_nested_marks():
    assert set(spoken('A 5" pipe. You are an idiot. A 6" pipe.')) == {"aimed insult"}
    assert set(spoken('"Never closed. You are an idiot. "ok"')) == {"aimed insult"}
    assert set(spoken('"He was «well». You are an idiot. So," it ended.')) == {"reported"}
    assert set(spoken('"One paragraph.\n\n"You are an idiot.\n\n"A third." Fine.')) == {"reported"}
    assert toxicity.quotations('("a") b "c"') == [(1, 4), (8, 11)]
    assert toxicity.quotations("no marks") == []
    model = toxicity.fit_default()
    text = '"' + "fine words " * 40 + '." You are an idiot. "ok"'
    assert model.score([text, "fine words"])[0] >= toxicity.THRESHOLD > model.score(["fine words", None])[1]


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(None, None, None), (1, None, None), (1, 1, 0), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = {(r.doc_id, r.predicted) for r in toxicity.score_documents(odd_docs, model).collect()}
    assert (8, 1) in got and (3, 0) in got and (7, 0) in got
    left = toxicity.drop_toxic(odd_docs, model)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 1
    assert toxicity.drop_toxic(no_docs, toxicity.fit(no_docs, labels.limit(0))).count() == 0


def discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if not all(n):
        return [0, 0.5, 1, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return [0] + [min(max(x, 0.05), k + 1) for k, x in enumerate(d)]


def kneser_ney(rows, order=2):
    """Scores by plain counting; also checks that each context's probabilities sum to one."""
    start, end = "\0s", "\0e"
    text = {i: words(t) + [end] for i, t in rows}
    grams_of = lambda t, k: zip(*[([start] * (k - 1) + t)[j:] for j in range(k)])
    train = [text[i] for i, _ in rows if (zlib.crc32(str(i).encode()) if i is not None else 0) % 7 != 2]
    uni = collections.Counter(w for t in train for w in t)
    count = {order: collections.Counter(g for t in train for g in grams_of(t, order))}
    for k in range(order - 1, 0, -1):
        count[k] = collections.Counter(g[1:] for g in count[k + 1])
    total, kinds_ = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for k in range(2, order + 1):
        for g, c in count[k].items():
            total[g[:-1]] += c
            kinds_[g[:-1]][min(c, 3) - 1] += 1
    d = {k: discounts(list(count[k].values())) for k in count}
    after, all_after = count[1], sum(count[1].values()) or 1
    size, n = len(uni), sum(uni.values())
    rest = sum(d[1][min(c, 3)] for c in after.values()) / all_after if after else 1.0

    def p(v, w):
        if not v:
            return max(after[w,] - d[1][min(after[w,], 3)], 0) / all_after + rest / (size + 1)
        if not total[v]:
            return p(v[1:], w)
        k, c = len(v) + 1, count[len(v) + 1][(*v, w)]
        return (max(c - d[k][min(c, 3)], 0) + sum(d[k][j + 1] * kinds_[v][j] for j in range(3)) * p(v[1:], w)) / total[v]

    for v in list(total)[:5]:
        assert abs(sum(p(v, w) for w in uni) + p(v, "\0unknown") - 1) < 1e-9
    return {i: (len(t), sum(uni[w] > 0 for w in t), n, sum(math.log10((uni[w] + 1) / (n + size + 1)) for w in t),
                sum(math.log10(p(g[:-1], g[-1])) for g in grams_of(t, order))) for i, t in text.items()}


@pytest.mark.parametrize("flush,order,spread,pile", [
    (1 << 21, 2, 2, 1 << 25), (3000, 2, 2, 2000), (1 << 21, 3, 40, 1 << 25), (3000, 4, 40, 5000), (3000, 2, 300, 5000)])
def test_language_model(spark, monkeypatch, flush, order, spread, pile):
    """``spread`` makes more or fewer contexts hot, ``pile`` merges a shard's blobs early: the scores stay."""
    monkeypatch.setattr(ngram_lm, "FLUSH", flush)
    monkeypatch.setattr(ngram_lm, "SPREAD", spread)
    monkeypatch.setattr(ngram_lm, "PILE", pile)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "the " * 3000), (None, "x Y")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    want = kneser_ney([(r.doc_id, r.text) for r in docs.collect()], order)
    got = {r.doc_id: r for r in ngram_lm.score_documents(docs, order=order).collect()}
    assert set(got) == set(want)
    for i, w in want.items():
        g = got[i]
        assert (g.n_tokens, g.n_known, g.train_tokens) == w[:3]
        assert g.base_score == pytest.approx(w[3], rel=1e-9) and g.score == pytest.approx(w[4], rel=1e-9)


def test_hot_contexts_are_found_and_spread(spark):
    """A word in half of all places: found, bounded, and its n-grams go to many shards."""
    rng = random.Random(3)
    texts = [" ".join(f"hot w{rng.randrange(400)}" for _ in range(200)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bits = 4
    found = ngram_lm.hot_contexts(docs.select("text"), bits, 3)
    h, firsts = ngram_lm.tokens(texts)
    for k, history in enumerate(ngram_lm.histories(h, firsts, 3), 2):
        v, c = np.unique(history >> np.uint64(16), return_counts=True)
        assert set(v[c * (1 << bits) >= len(h)]) <= set(found[k]) and len(found[k]) <= ngram_lm.SPREAD << bits
    v = ngram_lm.histories(h, firsts, 2)[0] >> np.uint64(16)
    at = np.isin(v, found[2])
    assert at.sum() > len(h) / 3
    shard = ngram_lm.spread_key(v[at], h[at] >> np.uint64(16)) >> np.uint64(64 - bits)
    assert np.bincount(shard.astype(int), minlength=1 << bits).max() < at.sum() / 4


def test_language_model_beats_its_base_on_held_out_text(spark):
    docs, _ = tables(spark, "/root/testdata/sf0.01")
    rows = [r for r in ngram_lm.score_documents(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_odd_rows(spark, odd_docs, no_docs):
    got = ngram_lm.score_documents(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(math.isfinite(r.score) for r in got)
    assert ngram_lm.score_documents(no_docs).count() == 0
