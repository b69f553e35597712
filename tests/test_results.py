"""Run-document reader (nested fine_tuned/base JSON) and result-table round trip."""

import json

from inkwell.operators.reports import compare_runs
from inkwell.sources.results import (join_predictions, read_results, read_run, read_run_header, read_run_json,
                                     write_results, write_run, write_run_json)


def _run(name, rouge):
    return {"model_name": name, "num_samples": 2, "metrics": {"rouge1": rouge, "bleu": 0.1},
            "per_sample": [{"rouge1": rouge, "task_type": "compose", "prompt": "p", "prediction": "x", "reference": "y"},
                           {"rouge1": 0.0, "task_type": "reply", "prompt": "q", "prediction": "z", "reference": "w"}]}


def test_read_run_json_with_and_without_base(spark, tmp_path):
    both = tmp_path / "both.json"
    both.write_text(json.dumps({"fine_tuned": _run("fine-tuned", 0.5), "base": _run("base", 0.25),
                                "config": {"max_samples": 100}}, indent=2))
    metrics, samples, about = read_run_json(spark, str(both))
    got = {(r["model_name"], r["metric"]): r["value"] for r in metrics.collect()}
    assert got == {("fine_tuned", "rouge1"): 0.5, ("fine_tuned", "bleu"): 0.1, ("base", "rouge1"): 0.25,
                   ("base", "bleu"): 0.1}
    assert samples.count() == 4
    assert {(r.model_name, r.label, r.num_samples, r.config["max_samples"]) for r in about.collect()} == {
        ("fine_tuned", "fine-tuned", 2, "100"), ("base", "base", 2, "100")}
    row = {r["metric"]: r for r in compare_runs(metrics).collect()}["rouge1"]
    assert (row["base"], row["fine_tuned"]) == (0.25, 0.5)
    only = tmp_path / "only.json"
    only.write_text(json.dumps({"fine_tuned": _run("fine-tuned", 0.5) | {"per_sample": []}, "base": None, "config": {}}))
    metrics, samples, about = read_run_json(spark, str(only))
    assert {r["model_name"] for r in metrics.collect()} == {"fine_tuned"}
    assert samples.count() == 0 and about.count() == 1


def test_run_document_round_trip(spark, tmp_path):
    rm = spark.createDataFrame([("base", "rouge1", 0.5), ("fine_tuned", "rouge1", 0.75)],
                               "model_name string, metric string, value double")
    ps = spark.createDataFrame([("base", "s1", 0.5, "a \"quoted\"\nline"), ("base", "s2", 0.25, None)],
                               "model_name string, sample_id string, rouge1 double, prediction string")
    write_run_json(rm, ps, str(tmp_path / "doc"), {"max_samples": 7})
    metrics, samples, about = read_run_json(spark, str(tmp_path / "doc"))
    assert {tuple(r) for r in metrics.collect()} == {tuple(r) for r in rm.collect()}
    assert {(r.model_name, r.sample_id, r.rouge1, r.prediction) for r in samples.collect()} == {
        tuple(r) for r in ps.collect()}
    assert {(r.model_name, r.label, r.num_samples) for r in about.collect()} == {
        ("base", "base", 2), ("fine_tuned", "fine-tuned", None)}


def test_run_is_written_in_parallel(spark, tmp_path):
    rm = spark.createDataFrame([("base", "rouge1", 0.5), ("base", "bleu", 0.1), ("fine_tuned", "rouge1", 0.75), ("7", "bleu", 0.2)],
                               "model_name string, metric string, value double")
    rows = [(m, f"s{i}", i / 64, None if i % 9 == 0 else f"a \"quoted\"\nline {i}", "t", "é")
            for m in ("base", "7") for i in range(40)]
    ps = spark.createDataFrame(rows, "model_name string, sample_id string, rouge1 double, prediction string, task_type string, "
                                     "reference string").repartition(4)
    write_run(rm, ps, str(tmp_path / "doc"), {"max_samples": 7})
    assert len(list((tmp_path / "doc/per_sample").glob("model_name=base/part-*.json"))) > 1  # no task holds a run
    metrics, samples, about = read_run(spark, str(tmp_path / "doc"))
    assert {tuple(r) for r in metrics.collect()} == {tuple(r) for r in rm.collect()}
    assert {(r.model_name, r.sample_id, r.rouge1, r.prediction, r.task_type, r.reference) for r in samples.collect()} \
        == set(rows) and samples.count() == 80
    assert {(r.model_name, r.label, r.num_samples, r.config["max_samples"]) for r in about.collect()} == {
        ("base", "base", 40, "7"), ("fine_tuned", "fine-tuned", None, "7"), ("7", "7", 40, "7")}
    head, _ = read_run_header(spark, str(tmp_path / "doc"))
    assert "per_sample" not in head._jdf.queryExecution().toString()
    row = {r["metric"]: r for r in compare_runs(head).collect()}["rouge1"]
    assert (row["base"], row["fine_tuned"]) == (0.5, 0.75)


def test_predictions_join_by_key(spark):
    s = spark.createDataFrame([("1", "t", "p", "r1"), ("2", "t", "p", "r2")],
                              "sample_id string, task_type string, prompt string, reference string")
    p = spark.createDataFrame([("a", "2", "x"), ("b", "1", "y"), ("b", "9", "z")],
                              "model_name string, sample_id string, prediction string")
    got = {(r.model_name, r.sample_id, r.prediction, r.reference) for r in join_predictions(s, p).collect()}
    assert got == {("a", "2", "x", "r2"), ("b", "1", "y", "r1")}


def test_result_tables_round_trip(spark, tmp_path):
    rm = spark.createDataFrame([("m", "rouge1", 0.5)], "model_name string, metric string, value double")
    ps = spark.createDataFrame([("m", "s1", 0.5)], "model_name string, sample_id string, rouge1 double")
    write_results(rm, ps, str(tmp_path / "out"), {"max_samples": 100})
    m2, p2 = read_results(spark, str(tmp_path / "out"))
    assert m2.collect() == rm.collect() and p2.collect() == ps.collect()
