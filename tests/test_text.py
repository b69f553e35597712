"""Python str semantics of the whitespace/token helpers, checked by character."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.functions.text import PY_WS_CHARS, ngrams, py_strip, sentence_count, ws_tokens

ALPHABET = list(PY_WS_CHARS) + list("ab.!?x​é-") + [" ", "\x1c"]


def test_py_ws_is_python_isspace():
    assert sorted(PY_WS_CHARS) == sorted(c for c in map(chr, range(0x110000)) if c.isspace())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=30))
def test_strip_split_sentences(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", py_strip("t").alias("s"), ws_tokens("t").alias("w"),
                     sentence_count("t").alias("n")).collect()
    import re
    for r in rows:
        t = texts[r["i"]]
        assert r["s"] == t.strip()
        assert list(r["w"]) == t.split()
        assert r["n"] == len(re.split(r"[.!?]+", t))


def test_ngrams_short_arrays(spark):
    df = spark.createDataFrame([(["a"],), ([],), (["a", "b", "c"],)], "t array<string>")
    got = [r[0] for r in df.select(ngrams("t", 2)).collect()]
    assert got == [[], [], ["a b", "b c"]]
    got3 = [r[0] for r in df.select(ngrams(F.col("t"), 3)).collect()]
    assert got3 == [[], [], ["a b c"]]
