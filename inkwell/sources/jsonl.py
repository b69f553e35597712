"""JSON Lines samples: scan with a fixed schema, sinks for all/train/val.

Spark reads and writes directories of part files; blank lines are skipped on
read and non-ASCII text is written unescaped. Files have no row order in Spark,
so samples carry ``sample_id`` and "first n" means smallest ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.sources.maildir import uri
from inkwell.sources.mailtree import register

SAMPLE_SCHEMA = ("sample_id string, task_type string, "
                 "messages array<struct<role: string, content: string>>")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """All samples of a JSONL file or directory (missing fields -> null)."""
    return spark.read.schema(SAMPLE_SCHEMA).json(path)


def read_val(spark: SparkSession, path: str, max_samples: int = fixed.EVAL_MAX_SAMPLES) -> DataFrame:
    """The first ``max_samples`` samples (by sample_id; 0 = all)."""
    df = read_samples(spark, path)
    return df.orderBy("sample_id").limit(max_samples) if max_samples else df


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_splits(split_samples: DataFrame, out_dir: str) -> dict[str, str]:
    """Write all samples to ``raw`` and the split to ``split=train|val`` (one partitioned write)."""
    out = out_dir.rstrip("/")
    cols = ["sample_id", "task_type", "messages"]
    write_jsonl(split_samples.select(*cols), f"{out}/raw")
    split_samples.select(*cols, "split").write.mode("overwrite").partitionBy("split").json(f"{out}/splits")
    return {"raw": f"{out}/raw", "train": f"{out}/splits/split=train", "val": f"{out}/splits/split=val"}


def write_mail_tree(raw: DataFrame, root: str, name: Column | None = None) -> None:
    """Write raw messages as a mail tree ``<root>/<user>/<folder>/<name>.`` (UTF-8); the name is the doc_id by default.

    Tasks write through the file system that ``root``'s URI names, which all of them share; the files appear when the
    whole job has succeeded (see ``mailtree``).
    """
    register(raw.sparkSession)
    rows = raw.select("user", "folder", (F.col("doc_id").cast("string") if name is None else name).alias("name"), "content")
    rows.write.format("mailtree").option("path", uri(root)).mode("append").save()
