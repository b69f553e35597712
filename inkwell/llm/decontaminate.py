"""Benchmark decontamination by size-partitioned MinHash containment search.

Containment is the share of a test item's distinct shingles (five words, A-Z lower-cased) that
occur in a document. The items are partitioned by their number of shingles n. The MinHash
sketch of an item holds its n - ceil(t n) + 1 smallest shingle hashes, a length that
each size partition derives from the threshold t: a document that contains a share t or more
misses at most n - ceil(t n) shingles, hence holds at least one of the sketch. So the search loses
nothing, however long the document. An item of fewer than five words is one shingle of all its words,
searched at that width.

The sketches are a table of (width, hash, item), the items another; both stay in Spark. Documents are read
once. A worker keeps of a document's shingles those whose hash is set in a bitmap over the items' hashes, and
drops documents without a hash of the sketches' bitmap; so few shingles of few documents move. The bitmaps have
2^FILTER_BITS bits each, whatever the benchmark's size: a fuller one lets more shingles through and loses none.
What is left meets the sketch table by an equi-join; the candidates are verified by exact containment
of shingle strings, one pair a row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import row_id, small_batches, store, text_or_empty, whole_rows
from inkwell.llm.words import LOWER, batch_word_hashes, gram_hashes

SHINGLE = 5
THRESHOLD = 0.8
FILTER_BITS = 27       # a bitmap's bits as a power of two: 16 MB
GRAMS = "struct<width:int,grams:array<struct<hash:long,gram:string>>>"
FOUND = "array<struct<width:int,hash:long,gram:string>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(LOWER).split()


def _grams_at(words: list[bytes], hashes: np.ndarray, at, width: int) -> set[tuple[int, str]]:
    """The distinct shingles at the places ``at``, as (signed hash, text)."""
    signed = hashes.view(np.int64)
    return {(int(signed[i]), b" ".join(words[i:i + width]).decode("utf-8", "replace")) for i in at}


def item_table(benchmark: DataFrame, width: int, threshold: float) -> DataFrame:
    """Items that have words: item (row identity), item_id, width, grams (by hash), n, needed, sketch (hashes)."""

    @F.pandas_udf(GRAMS)
    def shingled(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = words_of(text)
            w = min(width, len(words))
            hashes = gram_hashes(batch_word_hashes([b" ".join(words)])[0], w) if w else np.empty(0, np.uint64)
            rows.append((w, [{"hash": h, "gram": g} for h, g in sorted(_grams_at(words, hashes, range(len(hashes)), w))]))
        return pd.DataFrame(rows, columns=["width", "grams"])

    n = F.size("g.grams")
    least = F.greatest(F.lit(1), F.ceil(F.round(F.lit(float(threshold)) * n, 9)).cast("int"))  # fewest shared shingles
    rows = row_id(benchmark, "item_id", "text").select(
        F.col("__rid").alias("item"), "item_id", shingled(text_or_empty("text")).alias("g"))
    return store(rows.where(n > 0).select(
        "item", "item_id", "g.width", "g.grams", n.alias("n"), least.alias("needed"),
        F.slice(F.col("g.grams.hash"), F.lit(1), n - least + 1).alias("sketch")), "items")


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for the trailing ``bits`` bits of each ``hash``, as bytes; blocks without a bit do not reach the driver."""
    place = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)) + 1  # the bitmap functions count from one
    blocks = (hashes.groupBy(F.bitmap_bucket_number(place).alias("block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bytes")).collect())
    size = len(blocks[0]["bytes"]) if blocks else 1
    out = np.zeros(max(1 << bits >> 3, size), np.uint8)
    for b in blocks:
        out[(b["block"] - 1) * size:b["block"] * size] = np.frombuffer(b["bytes"], np.uint8)
    return out


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    place = hashes & np.uint64((1 << bits) - 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _finder(sent, widths: list[int], bits: int):
    """Of each text, the distinct shingles that may be an item's; null if none may be in a sketch."""

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.Series:
        sketches, grams = sent.value
        lowered = [t.encode("utf-8", "replace").translate(LOWER) for t in texts]
        hashes, firsts = batch_word_hashes(lowered)
        by_width, hit = {}, np.zeros(len(lowered), bool)
        for w in widths:
            h = gram_hashes(hashes, w)
            at = np.flatnonzero(_in_bitmap(grams, h, bits))
            of = np.searchsorted(firsts, at, "right") - 1
            inside = at + w <= firsts[of + 1]
            at, of = at[inside], of[inside]
            by_width[w] = h, at, of
            hit[of[_in_bitmap(sketches, h[at], bits)]] = True
        out = [None] * len(lowered)
        for d in np.flatnonzero(hit).tolist():
            words, found = lowered[d].split(), []
            for w, (h, at, of) in by_width.items():
                s, e = np.searchsorted(of, [d, d + 1])
                mine = h[firsts[d]:firsts[d + 1]]
                found += [{"width": w, "hash": x, "gram": g} for x, g in _grams_at(words, mine, at[s:e] - firsts[d], w)]
            out[d] = found
        return pd.Series(out, dtype=object)

    return find


def matched_rows(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc (the ``__rid`` of ``docs``), doc_id, item_id, item_shingles, shared_shingles of each document row and item
    row whose containment reaches the threshold. ``docs`` has doc_id, text and ``__rid``."""
    spark = docs.sparkSession
    small_batches(spark, 500)
    items = item_table(benchmark, width, threshold)
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most ``width`` of them
    sent = spark.sparkContext.broadcast(tuple(
        _bitmap(items.select(F.explode(hashes).alias("hash")), filter_bits) for hashes in ("sketch", "grams.hash")))
    found = _finder(sent, widths, filter_bits)(text_or_empty("text"))
    # stored: the pass over the documents is done once, and AQE may split a document or a hash of many rows
    hits = store(docs.select(F.col("__rid").alias("doc"), "doc_id", found.alias("found"))
                 .where(F.col("found").isNotNull()), "hits")
    sketch = store(items.select("width", "item", F.explode("sketch").alias("hash")), "sketches")
    pairs = store(hits.select("doc", F.explode("found").alias("f")).select("doc", "f.width", "f.hash").distinct()
                  .join(sketch, ["width", "hash"]).select("doc", "item", "width").distinct(), "pairs")
    mine = F.transform(F.filter("found", lambda f: f["width"] == F.col("width")), lambda f: f["gram"])
    shared = F.size(F.array_intersect(F.col("grams.gram"), mine))
    # a row is one pair: the item's shingles, and the document's that may be an item's
    return (pairs.join(items.drop("width", "sketch"), "item").join(hits, "doc")
            .select("doc", "doc_id", "item_id", F.col("n").cast("long").alias("item_shingles"), "needed",
                    shared.cast("long").alias("shared_shingles"))
            .where(F.col("shared_shingles") >= F.col("needed")).drop("needed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Pairs doc_id, item_id, item_shingles, shared_shingles, containment with containment >= threshold.

    Every row of either table takes part: repeated rows give repeated pairs, null ids stay null, null texts
    count as empty and contain nothing; other columns are ignored; an empty table gives an empty result.
    """
    rows = matched_rows(row_id(docs, "doc_id", "text"), benchmark, **kw).drop("doc")
    return rows.withColumn("containment", F.col("shared_shingles") / F.col("item_shingles"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` (all its columns) without the documents that contain a test item.

    Rows are judged one by one, so repeated rows stay or go together and null ids are no obstacle; null and
    empty texts stay; further columns of any name are kept; an empty table gives an empty result.
    """
    rows = whole_rows(docs)
    gone = store(matched_rows(rows, benchmark, **kw).select(F.col("doc").alias("__rid")).distinct(), "contaminated")
    return rows.join(gone, "__rid", "left_anti").select("__row.*")
