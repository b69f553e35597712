"""Helpers shared by the training-data operators.

* ``row_id`` gives every input row a stable identity. Documents may repeat, and a
  doc_id may be null, so no operator may lean on doc_id to find a row again.
* ``store`` / ``drop`` write intermediate tables to the folder the cluster names in
  ``spark.checkpoint.dir`` and remove them again: an executor that is lost costs a
  re-read, never a recomputation with other row order.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.session import delete_on_exit, ensure_checkpoint_dir, ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    delete_on_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._inkwell_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_inkwell_path", None)
        if path:
            sc = t.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def row_id(df: DataFrame, *columns) -> DataFrame:
    """The named columns of ``df`` with a stable row identity ``__rid``.

    The identity is (hash of file, row index in that file) of a file source, so that two
    scans of one table agree whatever their splits. An input that is no
    plain file scan is written to the shared folder first.
    """
    rid = F.struct(F.xxhash64("_metadata.file_path").alias("f"),
                   F.col("_metadata.row_index").alias("r")).alias("__rid")
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    try:
        return df.select(*cols, rid)
    except AnalysisException:
        return store(df, "rows").select(*cols, rid)


def whole_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``__rid`` of each row, and the whole row as ``__row``, so that no column of it can clash."""
    return row_id(docs, F.struct("*").alias("__row"), "doc_id", "text")


def keep_rows(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows (see ``whole_rows``) whose ``__rid`` is in ``kept``, as they came."""
    return rows.join(kept.select("__rid"), "__rid", "left_semi").select("__row.*")


def text_or_empty(column="text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def doc_crc(column="doc_id"):
    """crc32 of the doc_id written as text; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Before a Python step: ship this package, and bound what a worker holds at once (a lower
    setting of the session wins)."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, a row's place in its ``tree`` (from 0), and ``n``, the rows of the tree.

    Range partitions keep a large tree in many tasks; their sizes, one row per tree and partition, give offsets.
    """
    at = F.monotonically_increasing_id()  # partition << 33 | place in it
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = store(ranged.select("*", at.alias("_at")), "placed").withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "_part", (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                       F.sum("_c").over(whole).alias("n"))
    return (placed.join(runs, ["tree", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_first", "_shift"))
