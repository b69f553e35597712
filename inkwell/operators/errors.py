"""Failure-mode labels and repetition scores over per-sample results.

Labels read the per-sample table, whose prediction/reference were cut to 500
characters while rouge1 came from the full texts; both facts are kept. All
labels are in-row expressions (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.functions.text import let, lower_ws_tokens, ngrams, word_count

# fixed values: error-analysis rule sets (distinct from the format-compliance ones): no word
# boundary after the greeting word, and closings anywhere in the text.
NO_GREETING = r"(?imdu)^(dear|hi|hello|hey|good)"
NO_CLOSING = r"(?iu)(regards|sincerely|best|thanks|thank you)"


def has_repetition(pred) -> Column:
    """More than 10 words and some lower-cased word trigram occurs 3+ times."""
    def check(words):
        def on_sorted(s):
            return F.exists(F.sequence(F.lit(0), F.size(s) - fixed.REPETITION_MIN_REPEATS),
                            lambda i: F.get(s, i) == F.get(s, i + fixed.REPETITION_MIN_REPEATS - 1))
        enough = F.size(words) > fixed.REPETITION_MIN_WORDS
        return enough & let(F.array_sort(ngrams(words, 3)), on_sorted)
    return let(lower_ws_tokens(pred), check)


def repetition_score(pred) -> Column:
    """(trigrams - distinct trigrams) / trigrams of lower-cased words; 0 under 4 words."""
    def score(words):
        return F.when(F.size(words) < fixed.REPETITION_SCORE_MIN_WORDS, F.lit(0.0)).otherwise(
            let(ngrams(words, 3), lambda t: F.when(F.size(t) > 0, (F.size(t) - F.size(F.array_distinct(t))) / F.size(t))
                .otherwise(F.lit(0.0))))
    return let(lower_ws_tokens(pred), score)


def failure_flags(per_sample: DataFrame, pred: str = "prediction", ref: str = "reference",
                  rouge1: str = "rouge1") -> DataFrame:
    p, r = F.col(pred), F.col(ref)
    pw, rw = word_count(p), word_count(r)
    return per_sample.select(
        "*",
        has_repetition(p).alias("repetition"),
        (pw < fixed.TOO_SHORT_WORDS).alias("too_short"),
        ((pw > fixed.TOO_LONG_FACTOR * rw) & (rw > fixed.TOO_LONG_MIN_REF_WORDS)).alias("too_long"),
        (~p.rlike(NO_GREETING)).alias("no_greeting"),
        (~p.rlike(NO_CLOSING)).alias("no_closing"),
        (F.coalesce(F.col(rouge1), F.lit(0.0)) < fixed.OFF_TOPIC_ROUGE1).alias("off_topic"),
    )


def failure_labels(per_sample: DataFrame, **kw) -> DataFrame:
    """Adds ``failures`` (labels in rule order, ['none'] if empty) and ``failure_str``."""
    flagged = failure_flags(per_sample, **kw)
    labels = F.array_compact(F.array(*[F.when(F.col(m), F.lit(m)) for m in fixed.FAILURE_ORDER]))
    labelled = flagged.withColumn(
        "failures", F.when(F.size(labels) > 0, labels).otherwise(F.array(F.lit("none"))))
    return labelled.withColumn("failure_str", F.array_join("failures", ", "))


def failure_counts(labelled: DataFrame, group=("model_name",)) -> DataFrame:
    """Count per failure mode (multi-label) and percent of samples, most common first."""
    group = list(group)
    totals = labelled.groupBy(*group).agg(F.count(F.lit(1)).alias("n_samples"))
    counts = (labelled.select(*group, F.explode("failures").alias("mode"))
              .groupBy(*group, "mode").agg(F.count(F.lit(1)).alias("count")))
    # totals has one row per group (runs): a proven-small broadcast side.
    return (counts.join(F.broadcast(totals), group)
            .select(*group, "mode", "count", (F.lit(100.0) * F.col("count") / F.col("n_samples")).alias("pct"))
            .orderBy(*group, F.desc("count"), "mode"))


def recommendations(labelled: DataFrame, group=("model_name",)) -> DataFrame:
    """Rules fired: failure rate strictly above the rule's threshold (theta join
    against the literal 4-row rule table, broadcast)."""
    group = list(group)
    spark = labelled.sparkSession
    rules = spark.createDataFrame(
        [(i, m, float(t), msg) for i, (m, t, msg) in enumerate(fixed.RECOMMENDATION_RULES)],
        "rule_pos int, mode string, threshold double, message string")
    totals = labelled.groupBy(*group).agg(F.count(F.lit(1)).alias("n_samples"))
    counts = (labelled.select(*group, F.explode("failures").alias("mode"))
              .groupBy(*group, "mode").agg(F.count(F.lit(1)).alias("count")))
    rates = counts.join(F.broadcast(totals), group)
    fired = rates.join(F.broadcast(rules),
                       (rates["mode"] == rules["mode"]) & (rates["count"] > rules["threshold"] * rates["n_samples"]))
    return fired.select(*group, rules["rule_pos"], rules["mode"], "message").orderBy(*group, "rule_pos")
