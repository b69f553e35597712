"""Report and chart-data tables over run metrics and per-sample results.

Drawing is out of scope; these are the numbers behind the tables and charts.
Literal lookup tables (metric groups, chart series, rules) are a handful of rows
and are broadcast explicitly. Per-run top-k uses ``row_number() <= k``, which
Spark plans with a partial per-partition group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.functions.text import word_count
from inkwell.operators.errors import repetition_score
from inkwell.session import materialize


def _lookup(spark, rows, schema) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def results_table(run_metrics: DataFrame) -> DataFrame:
    """Grouped results table (C1): metrics in display groups, 4 decimals; absent metrics skipped."""
    spark = run_metrics.sparkSession
    rows = [(gi, g, mi, m) for gi, (g, ms) in enumerate(fixed.METRIC_GROUPS) for mi, m in enumerate(ms)]
    groups = _lookup(spark, rows, "group_pos int, metric_group string, metric_pos int, metric string")
    return (run_metrics.join(groups, "metric")
            .select("model_name", "group_pos", "metric_group", "metric_pos", "metric",
                    F.format_string("%.4f", F.col("value")).alias("display"))
            .orderBy("model_name", "group_pos", "metric_pos"))


def compare_runs(run_metrics: DataFrame, base: str = "base", tuned: str = "fine_tuned") -> DataFrame:
    """Base vs fine-tuned on the comparison metrics (C2/J4): missing -> 0, delta, signed display."""
    spark = run_metrics.sparkSession
    keys = _lookup(spark, [(i, k) for i, k in enumerate(fixed.COMPARE_KEYS)], "pos int, metric string")
    wide = (run_metrics.where(F.col("model_name").isin(base, tuned))
            .groupBy("metric").pivot("model_name", [base, tuned]).agg(F.first("value")))
    j = keys.join(wide, "metric", "left")
    b, t = F.coalesce(F.col(base), F.lit(0.0)), F.coalesce(F.col(tuned), F.lit(0.0))
    delta = t - b
    return j.select("pos", "metric", b.alias("base"), t.alias("fine_tuned"), delta.alias("delta"),
                    F.format_string("%.4f", b).alias("base_display"),
                    F.format_string("%.4f", t).alias("fine_tuned_display"),
                    F.concat(F.when(delta >= 0, F.lit("+")).otherwise(F.lit("")),
                             F.format_string("%.4f", delta)).alias("delta_display")).orderBy("pos")


def chart_bars(run_metrics: DataFrame) -> DataFrame:
    """Bar/line series (C3/C4): each chart's metric keys per run, missing -> 0."""
    series = F.array(*[F.struct(F.lit(c).alias("chart"), F.lit(i).alias("pos"), F.lit(m).alias("metric"))
                       for c, ms in fixed.CHART_SERIES for i, m in enumerate(ms)])
    grid = run_metrics.select("model_name").distinct().select("model_name", F.inline(series))
    j = grid.join(run_metrics, ["model_name", "metric"], "left")
    return j.select("model_name", "chart", "pos", "metric",
                    F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))


def chart_lengths(run_metrics: DataFrame) -> DataFrame:
    """Length bars (C5): words, sentences, chars/10 for predictions and references."""
    spark = run_metrics.sparkSession
    cats = _lookup(spark, [(0, "Words", "word_count", 1.0), (1, "Sentences", "sentence_count", 1.0),
                           (2, "Chars (÷10)", "char_count", 10.0)],
                   "pos int, category string, stat string, scale double")
    pivot = (run_metrics.groupBy("model_name").pivot("metric").agg(F.first("value")))
    out = []
    for r in ("word_count", "sentence_count", "char_count"):
        for side in ("pred", "ref"):
            if f"{side}_{r}_mean" not in pivot.columns:
                pivot = pivot.withColumn(f"{side}_{r}_mean", F.lit(None).cast("double"))
    stacked = pivot.select("model_name", F.inline(F.array(*[
        F.struct(F.lit(r).alias("stat"), F.col(f"pred_{r}_mean").alias("pred"), F.col(f"ref_{r}_mean").alias("ref"))
        for r in ("word_count", "sentence_count", "char_count")])))
    out = stacked.join(cats, "stat").select(
        "model_name", "pos", "category",
        (F.coalesce(F.col("pred"), F.lit(0.0)) / F.col("scale")).alias("generated"),
        (F.coalesce(F.col("ref"), F.lit(0.0)) / F.col("scale")).alias("reference"))
    return out


def worst_samples(per_sample: DataFrame, k: int = fixed.WORST_K, group=("model_name",)) -> DataFrame:
    """Bottom-k by rouge1 per run (ties by sample_id); null/NaN rouge excluded (O3)."""
    w = Window.partitionBy(*group).orderBy("rouge1", "sample_id")
    ok = per_sample.where(F.col("rouge1").isNotNull() & ~F.isnan("rouge1"))
    return ok.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def with_repetition(per_sample: DataFrame) -> DataFrame:
    return per_sample.withColumn("repetition_score", repetition_score(F.col("prediction")))


def most_repetitive(per_sample: DataFrame, k: int = fixed.REPETITIVE_K, group=("model_name",),
                    threshold: float = fixed.HIGH_REPETITION_SCORE) -> DataFrame:
    """Top-k by repetition score per run, only for runs where some score exceeds the threshold (O4)."""
    group = list(group)
    scored = with_repetition(per_sample)
    w = Window.partitionBy(*group).orderBy(F.desc("repetition_score"), "sample_id")
    # one row per run: which runs have any score above the threshold (broadcast side).
    runs = scored.groupBy(*group).agg(F.max(F.col("repetition_score") > threshold).alias("_any")).where("_any")
    shown = scored.join(F.broadcast(runs.select(*group)), group, "left_semi")
    return shown.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def sample_listing(per_sample: DataFrame, k: int = fixed.LISTING_K, group=("model_name",)) -> DataFrame:
    """First k samples per run by sample_id (O5)."""
    w = Window.partitionBy(*group).orderBy("sample_id")
    return per_sample.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def task_metric_stats(per_sample: DataFrame, group=("model_name",), metrics=fixed.TASK_METRICS) -> DataFrame:
    """Mean and sample std per task of the available metric columns, rounded half-even to 4 (A10)."""
    group = list(group)
    cols = [m for m in metrics if m in per_sample.columns]
    long = per_sample.select(*group, "task_type", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [*group, "task_type"], cols, "metric", "value")
    return long.groupBy(*group, "task_type", "metric").agg(
        F.bround(F.avg("value"), 4).alias("mean"), F.bround(F.stddev_samp("value"), 4).alias("std"))


def task_types(per_sample: DataFrame) -> DataFrame:
    """Distinct task types (the box plot's series, A13)."""
    return per_sample.select("task_type").distinct()


def exact_quantiles(df: DataFrame, group, value: str, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles with linear interpolation: ``(*group, n, q)`` with ``q`` aligned with ``probs``."""
    return quantiles_of_counts(stored_counts(df, group, value), group, probs)


def stored_counts(df: DataFrame, group, value: str) -> DataFrame:
    """Counts of each value (group, x, c), range-partitioned by (group, x) from sampled splitters
    and stored once with the number of their partition (``part``)."""
    # stored first: sampling the splitters must not compute the values a second time
    counts = materialize(value_counts(df, list(group), value), "values")
    return materialize(counts.repartitionByRange(*group, "x").withColumn("part", F.spark_partition_id()), "value_counts")


def quantiles_of_counts(counts: DataFrame, group, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles from ``stored_counts``, without a sketch and without a group in one task.

    Ties are one row. A value's rank is the count of smaller ones: the totals of the partitions before
    its own (a few rows a group) plus a running sum inside its partition.
    """
    group = list(group)
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (counts.groupBy(*group, "part").agg(F.sum("c").alias("pc"))
             .select(*group, "part", F.coalesce(F.sum("pc").over(before), F.lit(0)).alias("base"),
                     F.sum("pc").over(Window.partitionBy(*group)).alias("n")))
    inside = Window.partitionBy(*group, "part").orderBy("x")
    ranked = (counts.join(bases, [*group, "part"])
              .withColumn("upto", F.col("base") + F.sum("c").over(inside))
              .withColumn("first", F.col("upto") - F.col("c")))
    aggs = []
    for i, p in enumerate(probs):
        at = (F.col("n") - 1) * F.lit(p)
        for name, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when((F.col("first") <= rank) & (rank < F.col("upto")), F.col("x"))).alias(f"{name}{i}"))
    picked = ranked.groupBy(*group, "n").agg(*aggs)
    frac = lambda p: (F.col("n") - 1) * F.lit(p) - F.floor((F.col("n") - 1) * F.lit(p))
    return picked.select(*group, "n", F.array(*[
        F.col(f"lo{i}") + frac(p) * (F.col(f"hi{i}") - F.col(f"lo{i}")) for i, p in enumerate(probs)]).alias("q"))


def value_counts(df: DataFrame, group, value: str) -> DataFrame:
    """(group, x, c): how often each value occurs in each group; nulls are left out."""
    x = F.col(value).cast("double")
    # nulls go by their count of zero: a filter on the value would be pushed down and compute it twice
    return df.select(*group, x.alias("x")).groupBy(*group, "x").agg(F.count("x").alias("c")).where("c > 0")


def box_stats(per_sample: DataFrame, value: str = "rouge1", group=("model_name", "task_type")) -> DataFrame:
    """Box-plot numbers (C7): quartiles (exact, linear interpolation), whiskers at the most
    extreme data within 1.5 IQR, outlier count. Everything after the first sum reads the
    counts of distinct values, which are stored once."""
    group = list(group)
    counts = stored_counts(per_sample, group, value)
    quart = quantiles_of_counts(counts, group)
    quart = quart.select(*group, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                         F.col("q")[2].alias("q3"))
    j = counts.join(quart, group)
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col("x") >= lo) & (F.col("x") <= hi)
    return j.groupBy(*group, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("c"))).alias("n_outliers"))


def length_columns(per_sample: DataFrame) -> DataFrame:
    return per_sample.withColumn("pred_word_count", word_count("prediction")).withColumn(
        "ref_word_count", word_count("reference"))


def length_histogram(per_sample: DataFrame, bins: int = fixed.HIST_BINS, group=("model_name",)) -> DataFrame:
    """Equal-width histogram of word counts (C8): each series over its own min..max,
    last bin closed; min == max widens the range by 0.5 each side. Zero bins kept."""
    group = list(group)
    wc = length_columns(per_sample)
    long = wc.select(*group, F.inline(F.array(
        F.struct(F.lit("generated").alias("series"), F.col("pred_word_count").cast("double").alias("x")),
        F.struct(F.lit("reference").alias("series"), F.col("ref_word_count").cast("double").alias("x")))))
    rng = long.groupBy(*group, "series").agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"))
    rng = rng.select(*group, "series",
                     F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    # rng: one row per (run, series) — tiny, broadcast.
    binned = long.join(F.broadcast(rng), [*group, "series"]).select(
        *group, "series", F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).cast("int").alias("bin"))
    counts = binned.groupBy(*group, "series", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*group, "series", "lo", "hi",
                      F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, [*group, "series", "bin"], "left").select(
        *group, "series", "bin", (F.col("lo") + F.col("bin") * w).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * w).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def length_scatter(per_sample: DataFrame, group=("model_name",)) -> DataFrame:
    """Scatter points (C9) with the y=x line's end, max of both word counts per run."""
    group = list(group)
    wc = length_columns(per_sample)
    line = wc.groupBy(*group).agg(F.greatest(F.max("ref_word_count"), F.max("pred_word_count")).alias("line_max"))
    # line has one row per run: broadcast.
    return wc.select(*group, "sample_id", "ref_word_count", "pred_word_count").join(F.broadcast(line), group)


def error_summary(labelled: DataFrame, group=("model_name",)) -> DataFrame:
    """Scalar summary (A12): samples, clean count/pct, mean rouge1, repetition stats,
    word-count mean and sample std of both texts."""
    group = list(group)
    s = with_repetition(length_columns(labelled))
    none = F.array_contains("failures", "none")
    return s.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(none).alias("n_clean"),
        (F.lit(100.0) * F.count_if(none) / F.count(F.lit(1))).alias("pct_clean"),
        F.avg("rouge1").alias("mean_rouge1"),
        F.avg("repetition_score").alias("mean_repetition"),
        F.max("repetition_score").alias("max_repetition"),
        F.count_if(F.col("repetition_score") > fixed.HIGH_REPETITION_SCORE).alias("n_high_repetition"),
        F.avg("pred_word_count").alias("pred_words_mean"), F.stddev_samp("pred_word_count").alias("pred_words_std"),
        F.avg("ref_word_count").alias("ref_words_mean"), F.stddev_samp("ref_word_count").alias("ref_words_std"))
