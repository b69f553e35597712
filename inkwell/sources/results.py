"""Evaluation results: table sinks, the run document and its nested one-object form.

Our sink writes three tables (run metrics long form, per-sample results, run
config) instead of one nested document, so no step holds all per-sample rows. The
run document is re-aimed likewise: a header row per run (label, counts, metrics,
config) beside per-sample JSON Lines. The nested one-object form (``fine_tuned``/``base``
each with ``model_name, num_samples, metrics{...}, per_sample[...]``; ``base`` may be null
or absent) is read into the same tables, and written for bounded samples only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_results(run_metrics: DataFrame, per_sample: DataFrame, out_dir: str, config: dict | None = None,
                  fmt: str = "parquet") -> dict[str, str]:
    out = out_dir.rstrip("/")
    run_metrics.write.mode("overwrite").format(fmt).save(f"{out}/run_metrics")
    per_sample.write.mode("overwrite").format(fmt).save(f"{out}/per_sample")
    spark = run_metrics.sparkSession
    cfg = config or {}
    spark.createDataFrame([(k, str(v)) for k, v in cfg.items()], "key string, value string") \
        .write.mode("overwrite").format(fmt).save(f"{out}/run_config")
    return {k: f"{out}/{k}" for k in ("run_metrics", "per_sample", "run_config")}


def read_results(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    out = out_dir.rstrip("/")
    return (spark.read.format(fmt).load(f"{out}/run_metrics"), spark.read.format(fmt).load(f"{out}/per_sample"))


SAMPLE = """
    rouge1:double, rouge2:double, rougeL:double, bleu:double, distinct_1:double, distinct_2:double, distinct_3:double,
    format_compliance:double, has_greeting_rate:double, has_body_rate:double, has_closing_rate:double,
    pred_word_count_mean:double, pred_word_count_std:double, pred_sentence_count_mean:double,
    pred_sentence_count_std:double, pred_char_count_mean:double, pred_char_count_std:double,
    ref_word_count_mean:double, ref_word_count_std:double, ref_sentence_count_mean:double,
    ref_sentence_count_std:double, ref_char_count_mean:double, ref_char_count_std:double,
    sample_id:string, task_type:string, prompt:string, prediction:string, reference:string"""
RUN = f"struct<model_name:string, num_samples:bigint, metrics:map<string,double>, per_sample:array<struct<{SAMPLE}>>>"
RUN_DOCUMENT = f"fine_tuned {RUN}, base {RUN}, config map<string,string>"
SIDES = ("fine_tuned", "base")
LABELS = {"fine_tuned": "fine-tuned"}  # names written in a document where they differ from the run's
HEADER = "model_name string, label string, num_samples bigint, metrics map<string,double>, config map<string,string>"


def write_run_header(run_metrics: DataFrame, counts: DataFrame, path: str, config: dict | None = None,
                     labels: dict | None = None) -> None:
    """``<path>/runs``: one JSON line per run with its label, sample count, metrics and the config.

    ``counts``: model_name, num_samples; a run without a row there has a null count.
    """
    of = F.create_map(*[F.lit(x) for kv in (LABELS if labels is None else labels).items() for x in kv] or [
        F.lit(""), F.lit("")])
    cfg = [F.lit(x) for k, v in (config or {}).items() for x in (k, str(v))]
    (_metric_maps(run_metrics).join(counts.select("model_name", "num_samples"), "model_name", "left")
     .select("model_name", F.coalesce(of[F.col("model_name")], "model_name").alias("label"), "num_samples", "metrics",
             F.create_map(*cfg).cast("map<string,string>").alias("config"))
     .write.mode("overwrite").json(f"{path.rstrip('/')}/runs"))


def write_run(run_metrics: DataFrame, per_sample: DataFrame, path: str, config: dict | None = None,
              labels: dict | None = None) -> None:
    """The run document: the header rows, and every per-sample row as a JSON line under its
    ``model_name=``. Each task writes its own rows, so no step holds a run's samples."""
    counts = per_sample.groupBy("model_name").agg(F.count(F.lit(1)).alias("num_samples"))
    write_run_header(run_metrics, counts, path, config, labels)
    per_sample.write.mode("overwrite").partitionBy("model_name").json(f"{path.rstrip('/')}/per_sample")


def read_run_header(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """run_metrics (model_name, metric, value) and runs (model_name, label, num_samples, config)."""
    runs = spark.read.schema(HEADER).json(f"{path.rstrip('/')}/runs")
    return (runs.select("model_name", F.explode("metrics").alias("metric", "value")),
            runs.select("model_name", "label", "num_samples", "config"))


def read_run(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A run document -> run_metrics, per_sample rows with model_name, and runs, as ``read_run_json`` gives them."""
    metrics, about = read_run_header(spark, path)
    fields = SAMPLE.replace(":", " ")
    samples = spark.read.schema(f"{fields}, model_name string").json(f"{path.rstrip('/')}/per_sample")
    return metrics, samples.select("model_name", *[c for c in samples.columns if c != "model_name"]), about


def _metric_maps(run_metrics: DataFrame) -> DataFrame:
    return run_metrics.groupBy("model_name").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics"))


def write_run_json(run_metrics: DataFrame, per_sample: DataFrame, path: str, config: dict | None = None,
                   labels: dict | None = None) -> None:
    """Export of the nested one-object form: a side per run. It holds all per-sample rows in one document
    of one task, so it is for bounded samples; ``write_run`` is for any number."""
    labels = labels or {"fine_tuned": "fine-tuned", "base": "base"}
    fields = ["sample_id", *[c for c in per_sample.columns if c not in ("model_name", "sample_id")]]
    samples = per_sample.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("num_samples"), F.sort_array(F.collect_list(F.struct(*fields))).alias("per_sample"))
    runs = _metric_maps(run_metrics).join(samples, "model_name", "left")
    side = lambda s: F.max(F.when(F.col("model_name") == s, F.to_json(F.struct(
        F.lit(labels[s]).alias("model_name"), "num_samples", "metrics", "per_sample"))))
    cfg = _config_json(config or {})
    doc = runs.agg(*[F.coalesce(side(s), F.lit("null")).alias(s) for s in SIDES]).select(
        F.concat(F.lit('{"fine_tuned":'), "fine_tuned", F.lit(',"base":'), "base", F.lit(f',"config":{cfg}}}'))
        .alias("value"))
    doc.write.mode("overwrite").text(path)


def write_run_documents(per_sample: DataFrame, shard, metrics, path: str, config: dict | None = None,
                        labels: dict | None = None) -> None:
    """Nested run documents, one JSON line for each value of ``shard`` (a column that bounds the samples of a document).

    A document holds both runs' samples of its shard, their count, and the means of ``metrics`` over them; a run without a
    sample in it is absent there. Documents are written by as many tasks as shards are dealt to.
    """
    labels = LABELS if labels is None else labels
    fields = ["sample_id", *[c for c in per_sample.columns if c not in ("model_name", "sample_id")]]
    means = F.create_map(*[x for m in metrics for x in (F.lit(m), F.avg(m))])
    sides = per_sample.withColumn("_shard", shard).groupBy("_shard", "model_name").agg(
        F.count(F.lit(1)).alias("num_samples"), means.alias("metrics"),
        F.sort_array(F.collect_list(F.struct(*fields))).alias("per_sample"))
    side = lambda s: F.any_value(F.when(F.col("model_name") == s, F.struct(
        F.lit(labels.get(s, s)).alias("model_name"), "num_samples", "metrics", "per_sample")), ignoreNulls=True)
    cfg = [F.lit(x) for k, v in (config or {}).items() for x in (k, str(v))]
    (sides.groupBy("_shard").agg(*[side(s).alias(s) for s in SIDES])
     .select(*SIDES, F.create_map(*cfg).cast("map<string,string>").alias("config"))
     .write.mode("overwrite").json(path))


def _config_json(config: dict) -> str:
    import json

    return json.dumps({k: str(v) for k, v in config.items()}, ensure_ascii=False)


def read_run_json(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nested run document(s), one a file or (``lines``) one a line -> run_metrics (model_name, metric, value), per_sample rows with
    model_name, and runs (model_name, label, num_samples, config).

    ``model_name`` is the side of the document (``fine_tuned`` or ``base``), which the comparison joins on; the
    name written inside it is kept as ``label``. The schema is fixed, so an empty ``per_sample`` list or a
    missing or null ``base`` simply contributes no rows.
    """
    doc = spark.read.schema(RUN_DOCUMENT).option("multiLine", str(not lines).lower()).json(path)
    runs = doc.select("config", F.inline(F.array(*[
        F.struct(F.lit(s).alias("model_name"), F.col(s).alias("run")) for s in SIDES]))).where("run IS NOT NULL")
    metrics = runs.select("model_name", F.explode("run.metrics").alias("metric", "value"))
    samples = runs.select("model_name", F.inline("run.per_sample"))
    about = runs.select("model_name", F.col("run.model_name").alias("label"), "run.num_samples", "config")
    return metrics, samples, about


def join_predictions(samples: DataFrame, predictions: DataFrame) -> DataFrame:
    """J2: (model_name, sample_id, task_type, prompt, prediction, reference) by sample key.

    ``samples``: sample_id, task_type, prompt, reference; ``predictions``: model_name, sample_id, prediction.
    A sample without a prediction of a model is no pair; neither is a prediction without its sample.
    """
    return predictions.select("model_name", "sample_id", "prediction").join(
        samples.select("sample_id", "task_type", "prompt", "reference"), "sample_id")
