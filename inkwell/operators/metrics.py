"""Text metrics over a table of (prediction, reference) pairs.

A pair is keyed by ``(model_name, sample_id)``; predictions are joined to
references by key, never by position.

Plan shape: only what is asked for is computed, and a pair's scores come from its own row: one Arrow step
counts clipped matches and the LCS (``stemming.pair_counts``), without a shuffle and without a row per gram.
Folding sorted gram arrays on the JVM instead took about three times as long. Corpus-level
sums (BLEU, distinct-n) are small partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.operators.stemming import lcs_length, pair_counts  # noqa: F401 - lcs_length is part of this API
from inkwell.session import ship_package
from inkwell.functions.text import (PY_WS, char_count, f1, let, lower_ws_tokens, ngrams, py_strip,
                                    safe_ratio, sentence_count, word_count, ws_tokens)

KEYS = ("model_name", "sample_id")
ROUGE_ORDERS = (1, 2)
BLEU_ORDERS = (1, 2, 3, 4)

# fixed values: format compliance patterns (Java). (?d): only "\n" ends a line, as in Python;
# (?U): Unicode word boundary, as Python's \b on str.
GREETING = (r"(?imdU)^(dear\b|hi\b|hello\b|hey\b|good" + PY_WS +
            r"+(?:morning|afternoon|evening)\b|greetings\b|to whom)")
CLOSING = (r"(?imdU)(regards|sincerely|best|thanks|thank you|cheers|warm regards|kind regards|"
           r"respectfully|take care|all the best|cordially)" + PY_WS + r"*[,.]?" + PY_WS + r"*$")


# ------------------------------------------------------------------ tokens

def rouge_tokens(text) -> Column:
    """ROUGE tokens without stemming: lower-case runs of [a-z0-9]."""
    return F.array_remove(F.split(F.lower(text if isinstance(text, Column) else F.col(text)), "[^a-z0-9]+", -1), "")


def bleu_tokens(text) -> Column:
    """BLEU tokens: case-sensitive ``split()``."""
    return ws_tokens(text)


# ------------------------------------------------------------------ scores from counts

def overlap_f(overlap, pred_len, ref_len, n: int) -> Column:
    """F1 of clipped n-gram matches, from the token counts of both sides."""
    grams = lambda c: F.greatest(F.col(c) - (n - 1), F.lit(1))
    return f1(overlap / grams(pred_len), overlap / grams(ref_len))


def bleu_from_counts(nums, dens, hyp_len, ref_len, epsilon: float = fixed.BLEU_EPSILON) -> Column:
    """BLEU-4 from summed clipped numerators / denominators (uniform weights,
    smoothing method 1, brevity penalty, 0 without unigram matches)."""
    logs = None
    for num, den in zip(nums, dens):
        p = F.when(num == 0, F.lit(epsilon) / den).otherwise(num / den)
        term = F.lit(1.0 / len(nums)) * F.log(p)
        logs = term if logs is None else logs + term
    bp = (F.when(hyp_len > ref_len, F.lit(1.0)).when(hyp_len == 0, F.lit(0.0))
          .otherwise(F.exp(F.lit(1.0) - ref_len / hyp_len)))
    return F.when(nums[0] == 0, F.lit(0.0)).otherwise(bp * F.exp(logs))


# ------------------------------------------------------------------ in-row features

def has_greeting(text) -> Column:
    return text.rlike(GREETING)


def has_closing(text) -> Column:
    return text.rlike(CLOSING)


def has_body(text) -> Column:
    return F.length(py_strip(text)) >= fixed.BODY_MIN_CHARS


def compliance_score(g, b, c) -> Column:
    return (F.lit(fixed.GREETING_WEIGHT) * g.cast("double") + F.lit(fixed.BODY_WEIGHT) * b.cast("double")
            + F.lit(fixed.CLOSING_WEIGHT) * c.cast("double"))


def distinct_ratio(tokens, n: int) -> Column:
    return let(ngrams(tokens, n),
               lambda g: F.when(F.size(g) > 0, F.size(F.array_distinct(g)) / F.size(g)).otherwise(F.lit(0.0)))


# ------------------------------------------------------------------ per pair

def pair_scores(pairs: DataFrame, keys=KEYS, stem: bool = True, with_lcs: bool = True, with_rouge: bool = True,
                with_bleu: bool = True, carry=(), features: bool = False) -> DataFrame:
    """Per-pair overlap metrics, as asked: rouge1 and rouge2 (``with_rouge``), rougeL
    (``with_lcs``), per-pair BLEU and the sufficient statistics of corpus BLEU (``with_bleu``).

    ``stem`` applies to ROUGE. ``carry`` columns of ``pairs`` and, with ``features``, the in-row
    text features ride along. All counts are made inside the pair's row, without a shuffle.
    """
    keys = list(keys)
    carry = [c for c in carry if c not in keys and c not in ("prediction", "reference")]
    rouge = with_rouge or with_lcs
    feat_cols = _feature_columns(F.col("prediction"), F.col("reference")) if features else []
    cols = [*keys, *carry, *feat_cols]
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)  # noqa: E731 - a missing text is an empty one
    tok = pairs.select(*keys, text("prediction"), text("reference"), *carry)
    if rouge:
        tok = tok.select("*", rouge_tokens("prediction").alias("pred_rt"), rouge_tokens("reference").alias("ref_rt"))
        cols += [F.size("pred_rt").alias("pred_rn"), F.size("ref_rt").alias("ref_rn")]
    if rouge or with_bleu:
        ship_package(pairs.sparkSession)
        counts = pair_counts(stem, with_rouge, with_lcs, len(BLEU_ORDERS) if with_bleu else 0)
        cols.append(counts("prediction", "reference", "pred_rt", "ref_rt").alias("pc"))
    j = tok.select(*cols)
    out = [*keys, *carry, *(FEATURE_NAMES if features else [])]
    if with_rouge:
        out += [overlap_f(F.get("pc.rouge", n - 1), "pred_rn", "ref_rn", n).alias(f"rouge{n}") for n in ROUGE_ORDERS]
    if with_lcs:
        out.append(F.when((F.col("pred_rn") == 0) | (F.col("ref_rn") == 0), F.lit(0.0))
                   .otherwise(f1(F.col("pc.lcs") / F.col("pred_rn"), F.col("pc.lcs") / F.col("ref_rn")))
                   .alias("rougeL"))
    if not with_bleu:
        return j.select(*out)
    out += [F.col("pc.hyp_len").alias("hyp_len"), F.col("pc.ref_len").alias("ref_len")]
    for n in BLEU_ORDERS:
        out.append(F.get("pc.bleu", n - 1).alias(f"bleu_num_{n}"))
        out.append(F.greatest(F.col("pc.hyp_len") - (n - 1), F.lit(1)).alias(f"bleu_den_{n}"))
    res = j.select(*out)
    nums = [F.col(f"bleu_num_{n}") for n in BLEU_ORDERS]
    dens = [F.col(f"bleu_den_{n}") for n in BLEU_ORDERS]
    return res.withColumn("bleu", bleu_from_counts(nums, dens, F.col("hyp_len"), F.col("ref_len")))


FEATURE_NAMES = ("distinct_1", "distinct_2", "distinct_3", "has_greeting", "has_body", "has_closing",
                 "pred_word_count", "pred_sentence_count", "pred_char_count",
                 "ref_word_count", "ref_sentence_count", "ref_char_count")


def _feature_columns(p: Column, r: Column) -> list:
    lt = lower_ws_tokens(p)
    cols = [*[distinct_ratio(lt, n) for n in (1, 2, 3)],
            has_greeting(p), has_body(p), has_closing(p),
            word_count(p), sentence_count(p), char_count(p),
            word_count(r), sentence_count(r), char_count(r)]
    return [c.alias(n) for c, n in zip(cols, FEATURE_NAMES)]


def text_features(df: DataFrame, keys=KEYS) -> DataFrame:
    """In-row features: distinct-n, format flags and length counts of both texts."""
    return df.select(*keys, *_feature_columns(F.col("prediction"), F.col("reference")))


LENGTH_STATS = ("word_count", "sentence_count", "char_count")


def shown(pairs: DataFrame, keys=KEYS, rouge1: bool = False, rouge_l: bool = False, carry=(),
          prompt_chars: int = fixed.PROMPT_CHARS, text_chars: int = fixed.TEXT_CHARS) -> DataFrame:
    """Task (missing -> 'unknown') and cut prompt/prediction/reference per sample, with stemmed
    rouge1 (and rougeL) of the whole texts if asked. One pass, no shuffle."""
    keys = list(keys)
    cols = {"task_type": F.coalesce(F.col("task_type"), F.lit("unknown")),
            "prompt": F.substring("prompt", 1, prompt_chars),
            "prediction_shown": F.substring("prediction", 1, text_chars),
            "reference_shown": F.substring("reference", 1, text_chars)}
    cut = pairs.select(*keys, *carry, "prediction", "reference", *[c.alias(n) for n, c in cols.items()])
    scores = [n for n, want in (("rouge1", rouge1), ("rougeL", rouge_l)) if want]
    if scores:
        cut = pair_scores(cut, keys, with_rouge=rouge1, with_lcs=rouge_l, with_bleu=False, carry=[*carry, *cols])
    return cut.select(*keys, *carry, "task_type", "prompt", F.col("prediction_shown").alias("prediction"),
                      F.col("reference_shown").alias("reference"), *scores)


def per_sample(pairs: DataFrame, keys=KEYS, stem: bool = True, with_lcs: bool = True,
               prompt_chars: int = fixed.PROMPT_CHARS, text_chars: int = fixed.TEXT_CHARS) -> DataFrame:
    """All per-sample metrics (each pair scored as a one-pair corpus), plus task,
    truncated prompt/prediction/reference (task missing -> 'unknown')."""
    keys = list(keys)
    shown = pairs.select(*keys, "prediction", "reference",
                         F.coalesce(F.col("task_type"), F.lit("unknown")).alias("task_type"),
                         F.substring("prompt", 1, prompt_chars).alias("prompt"),
                         F.substring("prediction", 1, text_chars).alias("prediction_display"),
                         F.substring("reference", 1, text_chars).alias("reference_display"))
    j = pair_scores(shown, keys, stem, with_lcs, features=True,
                    carry=("task_type", "prompt", "prediction_display", "reference_display"))
    g, b, c = F.col("has_greeting"), F.col("has_body"), F.col("has_closing")
    cols = [*keys, "task_type", "prompt", F.col("prediction_display").alias("prediction"),
            F.col("reference_display").alias("reference"), "rouge1", "rouge2"]
    if with_lcs:
        cols.append("rougeL")
    cols += ["bleu", "distinct_1", "distinct_2", "distinct_3",
             compliance_score(g, b, c).alias("format_compliance"),
             g.cast("double").alias("has_greeting_rate"), b.cast("double").alias("has_body_rate"),
             c.cast("double").alias("has_closing_rate")]
    for side in ("pred", "ref"):
        for s in LENGTH_STATS:
            cols.append(F.col(f"{side}_{s}").cast("double").alias(f"{side}_{s}_mean"))
            cols.append(F.lit(0.0).alias(f"{side}_{s}_std"))
    return j.select(*cols)


# ------------------------------------------------------------------ corpus level

def distinct_n_corpus(pairs: DataFrame, group=("model_name",), text_col: str = "prediction",
                      max_n: int = 3) -> DataFrame:
    """distinct_n = unique / total lower-cased whitespace n-grams over the whole
    corpus of each group (0 when there are none). Two partial aggregates; a
    frequent gram is combined map-side."""
    group = list(group)
    lt = lower_ws_tokens(text_col)
    spec = F.array(*[F.struct(F.lit(n).alias("n"), ngrams(lt, n).alias("g")) for n in range(1, max_n + 1)])
    grams = (pairs.select(*group, F.inline(spec))
             .select(*group, "n", F.explode("g").alias("gram")))
    counts = grams.groupBy(*group, "n", "gram").agg(F.count(F.lit(1)).alias("c"))
    per_n = counts.groupBy(*group, "n").agg(F.count(F.lit(1)).alias("uniq"), F.sum("c").alias("total"))
    orders = pairs.select(*group).distinct().select(
        *group, F.explode(F.sequence(F.lit(1), F.lit(max_n))).alias("n"))
    full = orders.join(per_n, [*group, "n"], "left")
    return full.select(*group, F.concat(F.lit("distinct_"), F.col("n")).alias("metric"),
                       safe_ratio(F.coalesce("uniq", F.lit(0)), F.coalesce("total", F.lit(0))).alias("value"))


def bleu_corpus(pairs: DataFrame, keys=KEYS, group=("model_name",)) -> DataFrame:
    """Corpus BLEU per run from summed counts."""
    j = pair_scores(pairs, keys, with_rouge=False, with_lcs=False)
    nums, dens = ([F.sum(f"bleu_{x}_{n}") for n in BLEU_ORDERS] for x in ("num", "den"))
    return j.groupBy(*group).agg(bleu_from_counts(nums, dens, F.sum("hyp_len"), F.sum("ref_len")).alias("bleu"))


def evaluate(pairs: DataFrame, keys=KEYS, group=("model_name",), stem: bool = True,
             with_lcs: bool = True, embeddings: DataFrame | None = None) -> DataFrame:
    """All corpus metrics per run, long form ``(model_name, metric, value)``.

    ROUGE is the mean of per-pair F1; BLEU is corpus BLEU from summed counts;
    distinct-n pools all predictions of a run; length stats use population std.
    The embedding match (M6) is added when an ``embeddings`` table is given.
    """
    keys, group = list(keys), list(group)
    j = pair_scores(pairs, keys, stem, with_lcs, features=True)
    g, b, c = F.col("has_greeting"), F.col("has_body"), F.col("has_closing")
    aggs = [F.avg("rouge1").alias("rouge1"), F.avg("rouge2").alias("rouge2")]
    if with_lcs:
        aggs.append(F.avg("rougeL").alias("rougeL"))
    nums = [F.sum(f"bleu_num_{n}") for n in BLEU_ORDERS]
    dens = [F.sum(f"bleu_den_{n}") for n in BLEU_ORDERS]
    aggs.append(bleu_from_counts(nums, dens, F.sum("hyp_len"), F.sum("ref_len")).alias("bleu"))
    aggs += [F.avg(compliance_score(g, b, c)).alias("format_compliance"),
             F.avg(g.cast("double")).alias("has_greeting_rate"),
             F.avg(b.cast("double")).alias("has_body_rate"),
             F.avg(c.cast("double")).alias("has_closing_rate")]
    for side in ("pred", "ref"):
        for s in LENGTH_STATS:
            aggs.append(F.avg(f"{side}_{s}").alias(f"{side}_{s}_mean"))
            aggs.append(F.stddev_pop(f"{side}_{s}").alias(f"{side}_{s}_std"))
    run = j.groupBy(*group).agg(*aggs)
    metric_cols = [a for a in run.columns if a not in group]
    long = run.unpivot(group, metric_cols, "metric", "value")
    parts = [long, distinct_n_corpus(pairs, group)]
    if embeddings is not None:
        from inkwell.operators.embedding import embedding_match
        em = embedding_match(pairs, embeddings, keys)
        emr = em.groupBy(*group).agg(F.avg("precision").alias("bertscore_precision"),
                                     F.avg("recall").alias("bertscore_recall"),
                                     F.avg("f1").alias("bertscore_f1"))
        parts.append(emr.unpivot(group, ["bertscore_precision", "bertscore_recall", "bertscore_f1"],
                                 "metric", "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_mean_std(per_sample_df: DataFrame, group=("model_name",), exclude=()) -> DataFrame:
    """Mean and population std of every numeric per-sample metric (long input)."""
    group = list(group)
    skip = set(group) | set(KEYS) | {"task_type", "prompt", "prediction", "reference"} | set(exclude)
    metric_cols = [f.name for f in per_sample_df.schema.fields
                   if f.name not in skip and f.dataType.typeName() in ("double", "long", "integer")]
    long = per_sample_df.select(*group, *[F.col(m).cast("double").alias(m) for m in metric_cols]).unpivot(
        group, metric_cols, "metric", "value")
    return long.groupBy(*group, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (the last step of registry queries)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])

