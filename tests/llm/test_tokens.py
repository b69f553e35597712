import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from inkwell.llm import bpe, packing
from inkwell.llm.token_counts import count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", " ", "  ", "\n", "\t", "é", "ß", "1", "²", "'s", "'ll", "'", "!", "?", "\x85", "\xa0", "\x1c", "’", "—",
         "中", "😀", "<|endoftext|>", "<|endof", "|>", " the", " word", "\r\n", "ǆ", "͸", "​", " ", "　",
         "٣", "²³"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: [x for x in t.encode(text, add_special_tokens=False).ids]


def ids(text, **kw):
    data = b"".join(bpe.encoder(PATH).encode(text, **kw))
    return [int.from_bytes(data[i:i + 4], "little") for i in range(0, len(data), 4)]


def test_pieces_give_the_library_ids(library):
    rnd = random.Random(1)
    for _ in range(2000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60)))
        assert ids(text) == library(text), repr(text)


def test_chunks_resynchronise(library):
    rnd = random.Random(2)
    for _ in range(800):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(100, 600)))
        assert ids(text, chunk=rnd.randint(80, 150), overlap=rnd.randint(1, 90)) == library(text), repr(text)
    for text in ("a" * 5000, " " * 5000, "a" * 1000 + " " * 3000 + "b " * 500, "ab " * 3000, "!" * 4000):
        assert ids(text, chunk=200, overlap=20) == library(text)


def test_counts(spark, odd_docs, no_docs, library):
    rows = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    want = sorted(((i, len(t.encode()), len(library(t)), len(library(t)) > 512) for i, t in rows), key=repr)
    got = sorted((tuple(r) for r in count_tokens(odd_docs, PATH).collect()), key=repr)
    assert got == want
    assert count_tokens(no_docs, PATH).count() == 0


def check_packing(got, rows, library, size):
    want = Counter()
    for i, t in rows:
        x = library(t) + [0]
        first = len(x) % size if len(x) > size else len(x)
        cuts = sorted({0, first, *range(first, len(x) + 1, size)})
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(b"".join(v.to_bytes(4, "little") for v in x[a:b])))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


@pytest.mark.parametrize("size", [16, 2048])
def test_packing(spark, odd_docs, no_docs, library, size):
    rows = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    check_packing(packing.pack(odd_docs, PATH, size).collect(), rows, library, size)
    assert packing.pack(no_docs, PATH).count() == 0


def test_packing_is_tight(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = packing.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH).collect()
    n = check_packing(got, rows, library, 2048)
    assert n <= 1.02 * -(-sum(r.length for r in got) // 2048)


def test_plans_hold_every_piece_once():
    rnd = random.Random(5)
    for _ in range(200):
        size = rnd.choice([4, 10, 64])
        counts = {rnd.randint(1, size): rnd.randint(1, 40) for _ in range(rnd.randint(1, 12))}
        slots = {}
        for length, rank, first, offset in packing.plan(counts, size):
            slots.setdefault(length, []).append((rank, first, offset))
        sequences = {}
        for length, n in counts.items():
            by = sorted(slots[length])
            for rank in range(n):
                start, first, offset = max(s for s in by if s[0] <= rank)
                sequences.setdefault(first + rank - start, []).append((offset, length))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= size
