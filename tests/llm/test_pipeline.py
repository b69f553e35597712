"""The pipeline against its stages' brute-force versions, and its registration."""

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from brute import words
from inkwell.llm import toxicity
from test_decontaminate import brute as contained
from test_simhash import fingerprint, linked
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.fit(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [r for r, score in zip(rows, model.score([r[1] for r in rows])) if score < 0.3]
    seen, unique = set(), []
    for i, t in sorted(rows):
        n = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if n not in seen:
            seen.add(n)
            unique.append((i, t))
    fps = {i: fingerprint(t) for i, t in unique}
    sets = linked(set(fps.values()))
    firsts = {}
    for i, t in unique:
        firsts.setdefault(sets.find(fps[i]), (i, t))
    near = list(firsts.values())
    bad = {d for d, *_ in contained(near, bench)}
    clean = [(i, t) for i, t in near if i not in bad]
    assert len(rows) < docs.count() and len(unique) < len(rows) and bad

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, SF).collect()
    check_packing(got, clean, lambda t: library.encode(t, add_special_tokens=False).ids, 2048)


def test_stages_keep_columns_and_survive_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()


def test_stages_keep_columns_of_any_name(spark):
    rows = [(1, "one text of five words", "r", "w", 7, [1], 0.5), (1, "one text of five words", "r", "w", 7, [1], 0.5),
            (None, None, None, None, None, None, None), (2, "another text, quite unlike it", "s", "x", 8, [], 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __rid string, __row string, doc long, found array<int>, __toxicity double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.collect()} == {1, 2, None}
        assert all(tuple(r) in rows for r in out.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in pieces) == [(False, 1), (False, 1), (False, 2), (True, 0)]


@pytest.mark.parametrize("text", ["", None, "A b"])
def test_words(text):
    assert words(text) == ["a", "b"] if text else words(text) == []
