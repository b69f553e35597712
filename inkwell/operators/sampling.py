"""Exact, reproducible sampling: seeded order, proportional cap, stratified split.

Order within a stratum is ``md5('<seed>:<purpose>:<sample_id>')`` (ties by id),
the same in Spark and DuckDB. Taking the first ``n`` rows per stratum needs a
rank, and a plain ``row_number() OVER (PARTITION BY task ...)`` would put every
row of a stratum into one task. Instead (``exact_cut``):

1. count rows per (stratum, first ``digits`` hex chars of the key) — a partial
   aggregate; the count table has at most strata x 16**digits rows;
2. running sums over that small table find, per stratum, the buckets taken whole
   and the one boundary bucket with the number of rows still needed;
3. only rows of the boundary bucket (about 1/16**digits of a stratum) are
   ranked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import fixed


def order_key(seed: int, purpose: str, id_col: str = "sample_id") -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), F.col(id_col)))


def exact_cut(df: DataFrame, quota, key_col: str, strata_col: str = "task_type",
              id_col: str = "sample_id", digits: int = 4, flag_col: str = "_take") -> DataFrame:
    """Flag the first ``n_take`` rows (by ``key_col``, then ``id_col``) of every stratum.

    ``quota`` has one row per stratum: ``(strata_col, n_take)``, or is a function
    from the per-stratum sizes ``(strata_col, n)`` to that table. Returns ``df``
    with a boolean ``flag_col``; no row is dropped: a null stratum is a stratum like any other.
    """
    keyed = df.withColumn("_bucket", F.substring(F.col(key_col), 1, digits))
    counts = keyed.groupBy(strata_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    if callable(quota):
        # per-stratum sizes come from the small bucket-count table, not another scan
        quota = quota(counts.groupBy(strata_col).agg(F.sum("_n").alias("n")))
    w = (Window.partitionBy(strata_col).orderBy("_bucket")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marks = (counts.withColumn("_cum", F.sum("_n").over(w))
             .join(quota.withColumnRenamed(strata_col, "_stratum"), F.col(strata_col).eqNullSafe(F.col("_stratum")), "left")
             .select(F.col(strata_col).alias("_stratum"), F.col("_bucket").alias("_part"),
                     F.when(F.col("_cum") <= F.coalesce(F.col("n_take"), F.lit(0)), F.lit("all"))
                     .when(F.col("_cum") - F.col("_n") < F.col("n_take"), F.lit("part"))
                     .otherwise(F.lit("none")).alias("_mode"),
                     (F.col("n_take") - (F.col("_cum") - F.col("_n"))).alias("_need")))
    # marks has at most (#strata x 16**digits) rows: a proven size bound for broadcast.
    j = (keyed.join(F.broadcast(marks), F.col(strata_col).eqNullSafe(F.col("_stratum"))
                    & F.col("_bucket").eqNullSafe(F.col("_part")), "inner").drop("_stratum", "_part"))
    rest = j.where(F.col("_mode") != "part").withColumn(flag_col, F.col("_mode") == "all")
    rw = Window.partitionBy(strata_col).orderBy(key_col, id_col)
    boundary = (j.where(F.col("_mode") == "part")
                .withColumn(flag_col, F.row_number().over(rw) <= F.col("_need")))
    return rest.unionByName(boundary).drop("_bucket", "_mode", "_need")


def cap_quota(counts: DataFrame, max_samples: int, strata_col: str = "task_type") -> DataFrame:
    """Per-task quota of the proportional cap from the per-task sizes ``(strata_col, n)``: each
    stratum in order of its name (null first) gets the floor of its share, the last one the remainder."""
    everything = Window.partitionBy()  # over the per-task count table: one row per task
    total = F.sum("n").over(everything)
    share = F.floor(F.lit(max_samples) * F.col("n") / total).cast("long")
    last = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col(strata_col).desc_nulls_last())) == 1
    others = F.sum(share).over(everything) - share
    take = (F.when((F.lit(max_samples) == 0) | (total <= max_samples), F.col("n"))
            .when(last, F.lit(max_samples) - others).otherwise(share))
    return counts.select(strata_col, take.alias("n_take"))


def cap_samples(samples: DataFrame, max_samples: int = fixed.MAX_SAMPLES, seed: int = fixed.SEED,
                strata_col: str = "task_type", digits: int = 4) -> DataFrame:
    """Cap to ``max_samples`` keeping the task ratio; exact counts; 0 = no cap."""
    keyed = samples.withColumn("_key", order_key(seed, "cap"))
    flagged = exact_cut(keyed, lambda counts: cap_quota(counts, max_samples, strata_col), "_key", strata_col,
                        digits=digits)
    return flagged.where("_take").drop("_take", "_key")


def split_quota(counts: DataFrame, val_ratio: float, strata_col: str = "task_type") -> DataFrame:
    """Per-task validation size max(1, int(n * ratio)) from the per-task sizes ``(strata_col, n)``."""
    return counts.select(strata_col,
                         F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(float(val_ratio))).cast("long"))
                         .alias("n_take"))


def stratified_split(samples: DataFrame, val_ratio: float = fixed.VAL_RATIO, seed: int = fixed.SEED,
                     strata_col: str = "task_type", digits: int = 4) -> DataFrame:
    """Add ``split`` ('val' for the first max(1, int(n*ratio)) rows of each task, else 'train')."""
    keyed = samples.withColumn("_key", order_key(seed, "split"))
    flagged = exact_cut(keyed, lambda counts: split_quota(counts, val_ratio, strata_col), "_key", strata_col,
                        digits=digits)
    return (flagged.withColumn("split", F.when(F.col("_take"), F.lit("val")).otherwise(F.lit("train")))
            .drop("_take", "_key"))


def shuffled(samples: DataFrame, seed: int = fixed.SEED, purpose: str = "order") -> DataFrame:
    """Seeded, reproducible order (a distributed range-partitioned sort)."""
    return samples.withColumn("order_key", order_key(seed, purpose)).orderBy("order_key", "sample_id")


def split_summary(split_samples: DataFrame) -> DataFrame:
    """Counts by split x task with subtotals and the grand total (cube)."""
    return split_samples.cube("split", "task_type").agg(F.count(F.lit(1)).alias("n_samples"))


def task_counts(samples: DataFrame, task_col: str = "task_type") -> DataFrame:
    """Samples per task (missing task -> 'unknown'), most frequent first."""
    t = F.coalesce(F.col(task_col), F.lit("unknown")).alias("task_type")
    return (samples.groupBy(t).agg(F.count(F.lit(1)).alias("n_samples"))
            .orderBy(F.desc("n_samples"), "task_type"))


def leakage_audit(split_samples: DataFrame) -> DataFrame:
    """Assistant bodies found in both train and val (compose and reply rows of one reply)."""
    body = F.col("messages")[2]["content"]
    per_body = (split_samples.select(F.md5(body).alias("h"), "split").groupBy("h")
                .agg(F.countDistinct("split").alias("k")))
    return per_body.agg(F.count_if(F.col("k") > 1).alias("bodies_in_both"))
