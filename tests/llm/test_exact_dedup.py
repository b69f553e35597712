import hashlib
import re

import pytest

from inkwell.llm.exact_dedup import drop_exact_copies, exact_dedup


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        ids = [x for x in g if x is not None]
        out.append((i, min(ids) if ids else None, len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes,key_bits", [(4096, 64), (3, 64), (4, 3)])
def test_names_agree_with_text_equality(spark, block_bytes, key_bits):
    texts = ["", None, "a", "a b", "a\t b", "abcabcabcabc", "abcabcabcabd", "é" * 40, "é" * 41, "é" * 40, " a", "a ",
             "xyz" * 50, "xyz" * 51, "xyz" * 50]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup(df, block_bytes, key_bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_odd_rows(spark, odd_docs, no_docs):
    got = exact_dedup(odd_docs).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected(rows)
    assert sum(r.kept for r in got) == len({norm(t) for _, t in rows})
    left = drop_exact_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == len({norm(t) for _, t in rows})
    assert exact_dedup(no_docs).count() == 0 and drop_exact_copies(no_docs).count() == 0
