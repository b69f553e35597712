import random

import pytest

from brute import words
from inkwell.llm import decontaminate


def grams(w, n):
    return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items):
    out = []
    for d, text in docs:
        for i, item in items:
            w = words(item)
            if not w:
                continue
            n = min(5, len(w))
            g = grams(w, n)
            shared = len(g & grams(words(text), n))
            if shared >= 0.8 * len(g) - 1e-9:
                out.append((d, i, len(g), shared))
    return sorted(out, key=repr)


@pytest.mark.parametrize("filter_bits", [27, 16, 8])  # with eight bits most shingles pass the bitmaps
def test_finds_every_contained_item(spark, filter_bits):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abAB") for _ in range(rnd.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(1, 40)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, items[0][1]), (None, "a null id item of seven words")]
    docs = []
    for d in range(120):
        w = [word() for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 2)):
            part = words(rnd.choice(items[:40])[1])
            for _ in range(rnd.randint(0, 2)):
                part[rnd.randrange(len(part))] = word()
            w += part + [word()]
        docs.append((d, " ".join(w)))
    docs += [(500, None), (501, "A Null  ID item\tof seven words"), (502, " ".join(i[1] for i in items[:40]) * 20)]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string"), filter_bits=filter_bits)
    assert sorted(((r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got.collect()), key=repr) \
        == brute(docs, items)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "b c d e f"), (None, None)], "item_id long, text string")
    assert sorted(r.doc_id or 0 for r in decontaminate.contaminated(odd_docs, items).collect()) == [0, 1, 1, 2]
    left = decontaminate.drop_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 4
    assert decontaminate.drop_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert decontaminate.drop_contaminated(no_docs, items).count() == 0
