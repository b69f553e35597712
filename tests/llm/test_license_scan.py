"""Templates against regular expressions, the summary against plain Python, odd rows."""

import random
import re

import pytest

from inkwell.llm import license_scan as L


def pattern(items):
    out = ""
    for x in items:
        if isinstance(x, bytes):
            out += re.escape(x.decode()) + " "
        elif isinstance(x, list):
            out += f"(?:{pattern(x)})?"
        else:
            out += "(?:[^ ]+ ){%d,%d}" % x
    return out


def brute(templates, words):
    """(template, first, longest end) by trying every stretch."""
    out = []
    for k, (_, text) in enumerate(templates):
        p = re.compile(pattern(L.parse(text)))
        for i in range(len(words)):
            ends = [j for j in range(i + 1, len(words) + 1) if p.fullmatch("".join(w.decode() + " " for w in words[i:j]))]
            if ends:
                out.append((k, i, max(ends)))
    return out


SMALL = (("x", "a b"), ("y", "a <<beginOptional>>b<<endOptional>> c"), ("z", 'b <<var;words="0-2">> c a'),
         ("w", '<<beginOptional>>c <<beginOptional>>a<<endOptional>><<endOptional>> b <<var;words="1-3">> b'),
         ("v", 'a <<beginOptional>>b <<var;words="0-1">><<endOptional>> <<var;words="1-2">> a'))


def test_automata_accept_what_the_templates_say():
    rng = random.Random(5)
    automata = L.compiled(SMALL)
    for _ in range(400):
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 14))]
        assert L.find(automata, words) == brute(SMALL, words)


def render(items, rng):
    """A text of the template: optional regions in or out, replaceable ones filled."""
    out = []
    for x in items:
        if isinstance(x, bytes):
            out.append(x.decode())
        elif isinstance(x, list):
            out += render(x, rng) if rng.random() < 0.5 else []
        else:
            out += ["holder"] * rng.randint(*x)
    return out


@pytest.mark.parametrize("k", range(len(L.TEMPLATES)))
def test_every_template_accepts_its_variants_and_nothing_with_a_mandatory_word_changed(k):
    rng = random.Random(k)
    label, text = L.TEMPLATES[k]
    items = L.parse(text)
    a = L.Automaton(label, items)
    for _ in range(5):
        words = [w.upper().encode().lower() for w in render(items, rng)]
        assert a.longest(words, 0) is not None
    plain = [x for x in items if isinstance(x, bytes)]
    for j in rng.sample(range(len(plain)), min(8, len(plain))):
        broken = list(items)
        at = [i for i, x in enumerate(items) if isinstance(x, bytes)][j]
        broken[at] = b"zzz"
        words = [w.encode() for w in render(broken, rng)]
        assert a.longest(words, 0) is None


def test_markup_errors():
    for bad in ("a <<beginOptional>> b", "a <<endOptional>>", '<<var;words="0-2">> a'):
        with pytest.raises(ValueError):
            L.compiled([("x", bad)])


def expected(text):
    words = L.tokens(text)
    hits = [(label, i) for label, phrase in L.PHRASES for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.encode().split()]
    starts = [i for _, i in hits]
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for x, _ in hits})))


def test_summary(spark):
    texts = [None, "", " \n", "Under THE MIT License", "under the mit license under the mit-license, cc by\nnc CC-BY-NC 4.0",
             "apache license version 20", "Apache License, Version 2.0.", "underé the mit license", "é" * 9,
             "This work is licensed under the GNU General Public License, version 3.", "under the " * 50_000 + "mit license",
             "cc by nc " * 40_000, "İ under the mıt license K under the mit license"]
    docs = spark.createDataFrame([(i if i else None, t, "x", 1) for i, t in enumerate(texts)] * 2,
                                 "doc_id long, text string, labels string, n_words int")
    got = L.summary(docs).collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        assert tuple(r)[1:6] == expected(texts[r.doc_id or 0])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)
    by = {r.doc_id: r for r in got}
    assert by[9].labels == "gpl-3" and by[9].n_base == 0 and by[6].labels == "apache-2"
    assert L.summary(docs.limit(0)).collect() == []


def test_base_columns_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = L.summary(docs).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {i: expected(t) for i, t in texts.items()}
    for r in got:
        words = L.tokens(texts[r.doc_id])
        assert r.labels == ",".join(sorted({L.PHRASES[k][0] for k, *_ in brute_phrases(words)}
                                           | {L.TEMPLATES[k][0] for k in range(len(L.TEMPLATES)) if holds(k, words)}))


def brute_phrases(words):
    return [(k, i) for k, (_, p) in enumerate(L.PHRASES) for i in range(len(words)) if words[i:i + len(p.split())] == p.encode().split()]


PATTERNS = [re.compile(r"(?:^| )" + pattern(L.parse(t))) for _, t in L.TEMPLATES]


def holds(k, words):
    return bool(PATTERNS[k].search(" ".join(w.decode() for w in words) + " "))
