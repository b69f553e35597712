"""Incremental corpus ingestion with Structured Streaming.

The parser, cleaner and quality filter are stateless column expressions, so
they run unchanged on a streaming DataFrame. Deduplication is streaming
state keyed by the body hash: a message whose body arrived in an earlier trigger is dropped by a lookup
of its own key, without reading the sink. Within one trigger the first message in
``(user, path)`` order wins, as in the batch job; across triggers arrival order decides. The file
sink's log makes a replayed trigger append nothing twice. The state grows with the distinct bodies; a
cluster keeps it in RocksDB (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupStateTimeout

from inkwell.functions import fixed
from inkwell.operators.corpus import body_hash
from inkwell.operators.messages import prepare_messages
from inkwell.session import ship_package

RAW_SCHEMA = "path string, user string, folder string, content string"


def read_raw_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int = 1000) -> DataFrame:
    """A stream of raw message rows (path, user, folder, content) landing as files."""
    return (spark.readStream.schema(RAW_SCHEMA).format(fmt)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def clean_stream(raw: DataFrame, min_body_len: int = fixed.MIN_BODY_LENGTH,
                 max_body_len: int = fixed.MAX_BODY_LENGTH) -> DataFrame:
    """Parsed, cleaned, valid messages of a raw stream (stateless)."""
    return prepare_messages(raw, min_body_len, max_body_len).withColumn("body_hash", body_hash("body"))


def first_seen(cleaned: DataFrame) -> DataFrame:
    """The first message of each body hash over the life of the stream."""
    ship_package(cleaned.sparkSession)

    def keep_first(key, parts, state):
        first = None
        for part in parts:  # the key's rows of this trigger, in bounded pieces
            if not state.exists:
                best = part.sort_values(["user", "path"]).head(1)
                if first is None or (best.iloc[0]["user"], best.iloc[0]["path"]) < (
                        first.iloc[0]["user"], first.iloc[0]["path"]):
                    first = best
        if first is not None:
            state.update((True,))
            yield first

    return cleaned.groupBy("body_hash").applyInPandasWithState(
        keep_first, cleaned.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def start_ingest(raw: DataFrame, sink_path: str, checkpoint_path: str, trigger_once: bool = False):
    """Run the ingest: stateless cleaning, then first-by-hash state, appended to a Parquet sink.
    Restartable from ``checkpoint_path``."""
    writer = (first_seen(clean_stream(raw)).writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
