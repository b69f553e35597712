"""Streaming ingest gives the batch job's deduplicated messages on the same input."""

from inkwell.operators import corpus as C
from inkwell.operators import messages as M
from inkwell.sources import tables as T
from inkwell.streaming.ingest import read_raw_stream, start_ingest

from small_tables import SF_SMALL


def test_stream_matches_batch(spark, tmp_path):
    raw = T.raw_messages(spark, SF_SMALL).select("path", "user", "folder", "content")
    src = str(tmp_path / "src")
    raw.repartition(3).write.parquet(src)
    q = start_ingest(read_raw_stream(spark, src, max_files_per_trigger=1), str(tmp_path / "sink"),
                     str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "sink"))
    batch = C.dedup_first(M.prepare_messages(raw))
    assert got.count() == batch.count()
    assert {r[0] for r in got.select("body_hash").collect()} == {r[0] for r in batch.select("body_hash").collect()}
