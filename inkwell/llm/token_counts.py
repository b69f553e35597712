"""Token counts of whole texts by overlap resynchronisation (see ``bpe``)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import bpe
from inkwell.llm.common import small_batches, text_or_empty


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, chunk: int = bpe.CHUNK,
                 overlap: int = bpe.OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) per input row, repeated rows included.

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers`` library that
    every worker can read. Null and empty texts have no bytes and no tokens; a text of any length is
    encoded whole, in chunks; other columns are ignored; an empty table gives an empty result.
    The plan is one scan and one Arrow step, without a shuffle.
    """
    small_batches(docs.sparkSession, 500)

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        enc = bpe.encoder(tokenizer)
        return pd.Series([sum(map(len, enc.encode(t, chunk, overlap))) // 4 for t in texts], dtype="int64")

    text = text_or_empty("text")
    return docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                       n_tokens(text).alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
