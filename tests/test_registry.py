"""Every registered query runs at sf0.001 with a stable schema, and its executed plan has no
cross products and runs Python only where the operator needs it; entry() works."""

import __spark_entry__ as E

from small_tables import SF_SMALL
from inkwell.plans import registry

# the counts of a pair (ROUGE, LCS, BLEU) and the vector match are Arrow steps; all else is JVM expressions
PYTHON_ALLOWED = {"nested_results", "rouge_l", "rouge_n", "rouge_stemmed", "bleu_per_sample", "bleu_corpus", "embedding_match", "evaluate_full",
                  "evaluate_runs", "mail_tree_scan",
                  "per_sample_metrics", "metric_mean_std", "task_metric_stats", "failure_labels", "sample_listing"}
# file scans of queries that once read their input more often (further reads are of stored narrow tables)
MOST_SCANS = {"stage_counts": 1, "rouge_stemmed": 1, "rouge_l": 1, "task_types": 1, "length_histogram": 2,
              "length_scatter": 2, "box_stats": 3, "repetition_scores": 1}


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["sample_id", "task_type", "system_content", "user_content", "assistant_content"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_run_with_clean_plans(spark):
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    for name, fn in registry.QUERIES.items():
        df = fn(spark, SF_SMALL)
        assert len(df.columns) > 0, name
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        if name not in PYTHON_ALLOWED:
            assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name
        if name in MOST_SCANS:
            assert plan.count("Scan parquet") <= MOST_SCANS[name], (name, plan.count("Scan parquet"))
