"""Query registry: one Spark query per operator group, each with its DuckDB oracle.

Every query reads the driver tables (directly or through the derived views) and
runs over whole tables. Float outputs are rounded to 6 places as the last step,
on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.operators import corpus as C
from inkwell.operators import messages as M
from inkwell.plans import oracle as O
from inkwell.session import ensure_checkpoint_dir, materialize
from inkwell.sources import jsonl as JS
from inkwell.sources import maildir as MD
from inkwell.sources import results as RS
from inkwell.sources import tables as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _scratch(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/inkwell-io/{name}-{uuid.uuid4().hex}"


def _with(ctes: str, body: str) -> str:
    recursive = "RECURSIVE " if "FROM lcs WHERE" in ctes else ""
    return f"WITH {recursive}{ctes.strip()}\n{body}"


# ------------------------------------------------------------------ corpus build

def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed, cleaned, valid, deduplicated messages from raw_messages.

    Materialised once: compose, reply threading and the summaries all read it.
    """
    return materialize(C.dedup_first(M.prepare_messages(T.raw_messages(spark, sf_dir))), "messages")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chat samples, materialised (the exact cut reads its input three times)."""
    return materialize(C.all_samples(messages(spark, sf_dir)), "samples")


@register("folder_filter", _with(O.CORPUS_CTES, 'SELECT doc_id, path, "user", folder, box FROM chosen'))
def q_folder_filter(spark, sf_dir):
    return M.select_folders(T.raw_messages(spark, sf_dir)).select("doc_id", "path", "user", "folder", "box")


@register("parse_messages", _with(O.CORPUS_CTES, "SELECT * FROM parsed"))
def q_parse_messages(spark, sf_dir):
    raw = M.select_folders(T.raw_messages(spark, sf_dir))
    raw = raw.where(F.octet_length("content") <= fixed.MAX_BODY_LENGTH + fixed.FILE_SIZE_SLACK)
    return M.parse_messages(raw).select(
        "doc_id", "path", "user", "box", "message_id", "date", "from_addr", "to_addr", "cc",
        "subject", "body", "x_folder")


@register("clean_body", _with(O.CORPUS_CTES, "SELECT doc_id, path, body FROM cleaned"))
def q_clean_body(spark, sf_dir):
    raw = M.select_folders(T.raw_messages(spark, sf_dir))
    raw = raw.where(F.octet_length("content") <= fixed.MAX_BODY_LENGTH + fixed.FILE_SIZE_SLACK)
    return M.parse_messages(raw).select("doc_id", "path", M.clean_body("body").alias("body"))


@register("quality_filter", _with(O.CORPUS_CTES, 'SELECT doc_id, path, "user", box, subject, body FROM valid'))
def q_quality_filter(spark, sf_dir):
    return M.prepare_messages(T.raw_messages(spark, sf_dir)).select(
        "doc_id", "path", "user", "box", "subject", "body")


@register("dedup_first", _with(O.CORPUS_CTES,
                               'SELECT path, "user", box, subject, from_addr, body, body_hash FROM messages'))
def q_dedup_first(spark, sf_dir):
    return messages(spark, sf_dir).select("path", "user", "box", "subject", "from_addr", "body", "body_hash")


@register("user_box_counts", _with(O.CORPUS_CTES,
                                   'SELECT "user", box, count(*) AS n_messages FROM messages GROUP BY ROLLUP ("user", box)'))
def q_user_box_counts(spark, sf_dir):
    return C.user_box_counts(messages(spark, sf_dir))


SAMPLE_CTES = O.CORPUS_CTES + f""",
compose AS (
  SELECT md5('compose:' || path) AS sample_id, 'compose' AS task_type,
         {O.q(fixed.SYSTEM_PROMPT_COMPOSE)} AS system_content,
         {O.q(fixed.COMPOSE_PREFIX)} || cs AS user_content, b AS assistant_content
  FROM (SELECT path, {O.strip_subject_prefix('subject')} AS cs, {O.strip('body')} AS b
        FROM messages WHERE box = 'sent') s
  WHERE cs <> '' AND b <> ''),
orig AS (
  SELECT ns, from_addr, orig_subject, orig_body FROM (
    SELECT {O.normalise_subject('subject')} AS ns, from_addr, {O.strip('subject')} AS orig_subject,
           {O.strip('body')} AS orig_body,
           row_number() OVER (PARTITION BY {O.normalise_subject('subject')} ORDER BY "user", path) AS rn
    FROM messages WHERE box = 'inbox') i
  WHERE rn = 1 AND ns <> ''),
rep AS (
  SELECT path, {O.normalise_subject('subject')} AS ns, {O.strip('body')} AS reply_body
  FROM messages WHERE box = 'sent' AND regexp_matches({O.strip('subject')}, {O.q(O.REPLY_SUBJECT)})),
reply AS (
  SELECT md5('reply:' || rep.path) AS sample_id, 'reply' AS task_type,
         {O.q(fixed.SYSTEM_PROMPT_REPLY)} AS system_content,
         {O.q(fixed.REPLY_PREFIX)} || chr(10) || chr(10) || 'From: ' || orig.from_addr || chr(10) ||
         'Subject: ' || orig.orig_subject || chr(10) || chr(10) || orig.orig_body AS user_content,
         rep.reply_body AS assistant_content
  FROM rep JOIN orig ON rep.ns = orig.ns
  WHERE rep.ns <> '' AND orig.orig_body <> '' AND rep.reply_body <> ''),
samples AS (SELECT * FROM compose UNION ALL SELECT * FROM reply)
"""


@register("compose_samples", _with(SAMPLE_CTES, "SELECT * FROM compose"))
def q_compose_samples(spark, sf_dir):
    return C.flatten_samples(C.compose_samples(messages(spark, sf_dir)))


@register("reply_pairs", _with(SAMPLE_CTES, "SELECT * FROM reply"))
def q_reply_pairs(spark, sf_dir):
    return C.flatten_samples(C.reply_pairs(messages(spark, sf_dir)))


@register("all_samples", _with(SAMPLE_CTES, "SELECT * FROM samples"))
def q_all_samples(spark, sf_dir):
    return C.flatten_samples(C.all_samples(messages(spark, sf_dir)))


# ------------------------------------------------------------------ sampling

from inkwell.operators import sampling as S  # noqa: E402

CAP_CHECK = 250  # the cap of ``capped_samples``, whose feature it is; the splits take every sample
VAL_CHECK = 20   # the limit of ``val_load``, whose feature it is (below the number of validation samples)


def _key_sql(purpose: str) -> str:
    return f"md5(concat_ws(':', '{fixed.SEED}', '{purpose}', sample_id))"


def _split_ctes(cap: int) -> str:
    return SAMPLE_CTES + f""",
counts AS (SELECT task_type, count(*) AS n FROM samples GROUP BY task_type),
tot AS (SELECT sum(n) AS total, coalesce(sum(n) FILTER (WHERE task_type = 'compose'), 0) AS nc FROM counts),
quota AS (
  SELECT c.task_type,
         CASE WHEN {cap} = 0 OR t.total <= {cap} THEN c.n
              WHEN c.task_type = 'compose' THEN CAST(floor({cap} * t.nc / t.total) AS BIGINT)
              ELSE {cap} - CAST(floor({cap} * t.nc / t.total) AS BIGINT) END AS n_take
  FROM counts c, tot t),
cap_ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY task_type ORDER BY {_key_sql('cap')}, sample_id) AS rn FROM samples s),
capped AS (SELECT c.* EXCLUDE (rn) FROM cap_ranked c JOIN quota q ON c.task_type = q.task_type WHERE c.rn <= q.n_take),
vquota AS (SELECT task_type, greatest(1, CAST(floor(count(*) * CAST({fixed.VAL_RATIO} AS DOUBLE)) AS BIGINT)) AS n_val
           FROM capped GROUP BY task_type),
split_ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY task_type ORDER BY {_key_sql('split')}, sample_id) AS rn FROM capped c),
splits AS (
  SELECT s.* EXCLUDE (rn), CASE WHEN s.rn <= v.n_val THEN 'val' ELSE 'train' END AS split
  FROM split_ranked s JOIN vquota v ON s.task_type = v.task_type)
"""


CAPPED_CTES = _split_ctes(CAP_CHECK)
SPLIT_CTES = _split_ctes(0)


def _capped(spark, sf_dir):
    return S.cap_samples(samples(spark, sf_dir), max_samples=CAP_CHECK)


@register("shuffled_order", _with(SAMPLE_CTES,
                                  f"SELECT sample_id, task_type, {_key_sql('order')} AS order_key FROM samples "
                                  "ORDER BY order_key, sample_id"))
def q_shuffled_order(spark, sf_dir):
    return S.shuffled(samples(spark, sf_dir)).select("sample_id", "task_type", "order_key")


@register("capped_samples", _with(CAPPED_CTES, "SELECT sample_id, task_type FROM capped"))
def q_capped_samples(spark, sf_dir):
    return _capped(spark, sf_dir).select("sample_id", "task_type")


@register("train_val_split", _with(SPLIT_CTES, "SELECT sample_id, task_type, split FROM splits"))
def q_train_val_split(spark, sf_dir):
    return S.stratified_split(samples(spark, sf_dir)).select("sample_id", "task_type", "split")


@register("split_summary", _with(SPLIT_CTES,
                                 "SELECT split, task_type, count(*) AS n_samples FROM splits GROUP BY CUBE (split, task_type)"))
def q_split_summary(spark, sf_dir):
    return S.split_summary(S.stratified_split(samples(spark, sf_dir)))


@register("task_counts", _with(SAMPLE_CTES,
                               "SELECT CASE WHEN sample_id < '2' THEN 'unknown' ELSE task_type END AS task_type, "
                               "count(*) AS n_samples FROM samples GROUP BY 1 ORDER BY n_samples DESC, task_type"))
def q_task_counts(spark, sf_dir):
    """Counts per task from a JSON Lines file in which some rows lack the task (A4, A5)."""
    path = _scratch(spark, "samples")
    task = F.when(F.col("sample_id") >= "2", F.col("task_type")).alias("task_type")
    JS.write_jsonl(samples(spark, sf_dir).select("sample_id", task, "messages"), path)
    return S.task_counts(JS.read_samples(spark, path))


# ------------------------------------------------------------------ metrics

from inkwell.operators import metrics as MT  # noqa: E402

R = MT.round_doubles
MCTES = O.metric_ctes()                            # stemmed ROUGE-1/2 and ROUGE-L
STEM_CTES = O.metric_ctes(lcs=False)               # stemmed ROUGE-1/2
RAW_CTES = O.metric_ctes(stem=False, lcs=False)    # ROUGE-1/2 without stems


SHARD = 100  # conversations of one nested run document


def _pairs(spark, sf_dir):
    return T.pairs(spark, sf_dir)


def _r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


@register("rouge_n", _with(RAW_CTES, f"SELECT model_name, sample_id, {_r6('rouge1', 'rouge1')}, "
                                  f"{_r6('rouge2', 'rouge2')} FROM pair_metrics"))
def q_rouge_n(spark, sf_dir):
    return R(MT.pair_scores(_pairs(spark, sf_dir), stem=False, with_lcs=False, with_bleu=False).select(
        *MT.KEYS, "rouge1", "rouge2"))


@register("bleu_per_sample", _with(RAW_CTES, f"SELECT model_name, sample_id, {_r6('bleu', 'bleu')} FROM pair_metrics"))
def q_bleu_per_sample(spark, sf_dir):
    return R(MT.pair_scores(_pairs(spark, sf_dir), with_rouge=False, with_lcs=False).select(*MT.KEYS, "bleu"))


_BLEU_CORPUS_SQL = " + ".join(
    f"0.25 * ln(CASE WHEN sum(num{n}) = 0 THEN 0.1 / sum(den{n}) ELSE sum(num{n}) / sum(den{n}) END)" for n in (1, 2, 3, 4))


@register("bleu_corpus", _with(RAW_CTES, f"""
SELECT model_name, round(CASE WHEN sum(num1) = 0 THEN 0.0 ELSE
  (CASE WHEN sum(hyp_len) > sum(ref_len) THEN 1.0 WHEN sum(hyp_len) = 0 THEN 0.0
        ELSE exp(1.0 - sum(ref_len) / sum(hyp_len)) END) * exp({_BLEU_CORPUS_SQL}) END, 6) AS bleu
FROM pair_metrics GROUP BY model_name"""))
def q_bleu_corpus(spark, sf_dir):
    return R(MT.bleu_corpus(_pairs(spark, sf_dir)))


@register("rouge_l", _with(O.metric_ctes(stem=False), "SELECT model_name, sample_id, round(rougeL, 6) AS \"rougeL\" FROM pair_metrics"))
def q_rouge_l(spark, sf_dir):
    return R(MT.pair_scores(_pairs(spark, sf_dir), stem=False, with_rouge=False, with_bleu=False).select(
        *MT.KEYS, "rougeL"))


@register("distinct_n", _with(RAW_CTES, """
SELECT model_name, 'distinct_' || n AS metric,
       round(CASE WHEN count(*) FILTER (WHERE g IS NOT NULL) = 0 THEN 0.0
                  ELSE count(DISTINCT g) / count(*) FILTER (WHERE g IS NOT NULL) END, 6) AS value
FROM (SELECT model_name, n, unnest(CASE n WHEN 1 THEN g1 WHEN 2 THEN g2 ELSE g3 END) AS g
      FROM (SELECT model_name, """ + ", ".join(f"{O.ngrams('pl', n)} AS g{n}" for n in (1, 2, 3)) + """ FROM pair_metrics) x,
           (SELECT unnest([1, 2, 3]) AS n) ns
      UNION ALL SELECT DISTINCT model_name, n, NULL AS g FROM pair_metrics, (SELECT unnest([1, 2, 3]) AS n) ns) y
GROUP BY model_name, n"""))
def q_distinct_n(spark, sf_dir):
    return R(MT.distinct_n_corpus(_pairs(spark, sf_dir)))


@register("distinct_n_per_sample", _with(RAW_CTES, "SELECT model_name, sample_id, " + ", ".join(
    _r6(f"distinct_{n}", f"distinct_{n}") for n in (1, 2, 3)) + " FROM pair_metrics"))
def q_distinct_n_per_sample(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return R(MT.text_features(p).select(*MT.KEYS, "distinct_1", "distinct_2", "distinct_3"))


@register("format_compliance", _with(RAW_CTES, f"""
SELECT model_name, {_r6('avg(' + O.compliance_sql() + ')', 'format_compliance')},
       {_r6('avg(CAST(has_greeting AS DOUBLE))', 'has_greeting_rate')},
       {_r6('avg(CAST(has_body AS DOUBLE))', 'has_body_rate')},
       {_r6('avg(CAST(has_closing AS DOUBLE))', 'has_closing_rate')}
FROM pair_metrics GROUP BY model_name"""))
def q_format_compliance(spark, sf_dir):
    f = MT.text_features(_pairs(spark, sf_dir))
    g, b, c = F.col("has_greeting"), F.col("has_body"), F.col("has_closing")
    return R(f.groupBy("model_name").agg(
        F.avg(MT.compliance_score(g, b, c)).alias("format_compliance"),
        F.avg(g.cast("double")).alias("has_greeting_rate"),
        F.avg(b.cast("double")).alias("has_body_rate"),
        F.avg(c.cast("double")).alias("has_closing_rate")))


_LEN_SQL = ", ".join(
    f"{_r6(f'avg({side}_{s})', f'{side}_{s}_mean')}, {_r6(f'stddev_pop({side}_{s})', f'{side}_{s}_std')}"
    for side in ("pred", "ref") for s in MT.LENGTH_STATS)


@register("length_stats", _with(RAW_CTES, f"SELECT model_name, {_LEN_SQL} FROM pair_metrics GROUP BY model_name"))
def q_length_stats(spark, sf_dir):
    f = MT.text_features(_pairs(spark, sf_dir))
    aggs = []
    for side in ("pred", "ref"):
        for s in MT.LENGTH_STATS:
            aggs += [F.avg(f"{side}_{s}").alias(f"{side}_{s}_mean"),
                     F.stddev_pop(f"{side}_{s}").alias(f"{side}_{s}_std")]
    return R(f.groupBy("model_name").agg(*aggs))


PER_SAMPLE_COLS = ["rouge1", "rouge2", "rougeL", "bleu", "distinct_1", "distinct_2", "distinct_3", "format_compliance",
                   "has_greeting_rate", "has_body_rate", "has_closing_rate"] + [
    f"{side}_{s}_{k}" for side in ("pred", "ref") for s in MT.LENGTH_STATS for k in ("mean", "std")]

_PER_SAMPLE = f""",
per_sample AS (
  SELECT model_name, sample_id, coalesce(task_type, 'unknown') AS task_type, substr(prompt, 1, 200) AS prompt,
         substr(prediction, 1, 500) AS prediction, substr(reference, 1, 500) AS reference,
         rouge1, rouge2, {{rougeL}}bleu, distinct_1, distinct_2, distinct_3,
         {O.compliance_sql()} AS format_compliance,
         CAST(has_greeting AS DOUBLE) AS has_greeting_rate, CAST(has_body AS DOUBLE) AS has_body_rate,
         CAST(has_closing AS DOUBLE) AS has_closing_rate,
         {', '.join(f"CAST({side}_{s} AS DOUBLE) AS {side}_{s}_mean, CAST(0.0 AS DOUBLE) AS {side}_{s}_std" for side in ('pred', 'ref') for s in MT.LENGTH_STATS)}
  FROM pair_metrics)
"""
PS_CTES = MCTES + _PER_SAMPLE.replace("{rougeL}", 'rougeL AS "rougeL", ')
PS_STEM_CTES = STEM_CTES + _PER_SAMPLE.replace("{rougeL}", "")  # for reports that use no ROUGE-L


def per_sample_table(spark, sf_dir):
    return MT.per_sample(_pairs(spark, sf_dir))


def shown_table(spark, sf_dir, rouge1: bool = False):
    """What the error reports read: task and cut texts per sample, and stemmed rouge1 of the whole texts."""
    return MT.shown(_pairs(spark, sf_dir), rouge1=rouge1)


@register("per_sample_metrics", _with(PS_CTES, "SELECT model_name, sample_id, task_type, prompt, prediction, reference, "
                                      + ", ".join(_r6(c, c) for c in PER_SAMPLE_COLS) + " FROM per_sample"))
def q_per_sample_metrics(spark, sf_dir):
    return R(per_sample_table(spark, sf_dir))


_EMB = f""",
emb_n AS (SELECT count(*) AS n FROM embeddings),
etok AS (
  SELECT model_name, sample_id, side, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM (
    SELECT model_name, sample_id, 'p' AS side, {O.ws_tokens('lower(prediction)')} AS t FROM pairs
    UNION ALL SELECT model_name, sample_id, 'r' AS side, {O.ws_tokens('lower(reference)')} AS t FROM pairs) s),
ev AS (
  SELECT e.model_name, e.sample_id, e.side, e.pos, CAST(x.embedding AS DOUBLE[]) AS v
  FROM etok e CROSS JOIN emb_n
  JOIN embeddings x ON x.vec_id = CAST('0x' || substr(md5(e.token), 1, 15) AS BIGINT) % emb_n.n),
best AS (
  SELECT a.model_name, a.sample_id, a.side, a.pos, max(list_cosine_similarity(a.v, b.v)) AS s
  FROM ev a JOIN ev b ON a.model_name = b.model_name AND a.sample_id = b.sample_id AND a.side <> b.side
  GROUP BY ALL),
pr AS (
  SELECT model_name, sample_id, avg(s) FILTER (WHERE side = 'p') AS precision, avg(s) FILTER (WHERE side = 'r') AS recall
  FROM best GROUP BY ALL),
em AS (
  SELECT p.model_name, p.sample_id, coalesce(pr.precision, 0.0) AS precision, coalesce(pr.recall, 0.0) AS recall
  FROM pairs p LEFT JOIN pr ON p.model_name = pr.model_name AND p.sample_id = pr.sample_id),
em_f AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM em)
"""



_EVAL_METRICS = (["rouge1", "rouge2", "rougeL", "bleu", "format_compliance", "has_greeting_rate", "has_body_rate",
                  "has_closing_rate"] + [f"{side}_{s}_{k}" for side in ("pred", "ref") for s in MT.LENGTH_STATS
                                         for k in ("mean", "std")])

_EVAL_SQL = _EMB + f"""
, run AS (
  SELECT model_name, avg(rouge1) AS rouge1, avg(rouge2) AS rouge2, avg(rougeL) AS "rougeL",
         CASE WHEN sum(num1) = 0 THEN 0.0 ELSE
           (CASE WHEN sum(hyp_len) > sum(ref_len) THEN 1.0 WHEN sum(hyp_len) = 0 THEN 0.0
                 ELSE exp(1.0 - sum(ref_len) / sum(hyp_len)) END) * exp({_BLEU_CORPUS_SQL}) END AS bleu,
         avg({O.compliance_sql()}) AS format_compliance,
         avg(CAST(has_greeting AS DOUBLE)) AS has_greeting_rate, avg(CAST(has_body AS DOUBLE)) AS has_body_rate,
         avg(CAST(has_closing AS DOUBLE)) AS has_closing_rate,
         {', '.join(f"avg({side}_{s}) AS {side}_{s}_mean, stddev_pop({side}_{s}) AS {side}_{s}_std" for side in ('pred', 'ref') for s in MT.LENGTH_STATS)}
  FROM pair_metrics GROUP BY model_name),
dn AS (
  SELECT model_name, 'distinct_' || n AS metric,
         CASE WHEN count(g) = 0 THEN 0.0 ELSE count(DISTINCT g) / count(g) END AS value
  FROM (SELECT model_name, n, unnest(CASE n WHEN 1 THEN g1 WHEN 2 THEN g2 ELSE g3 END) AS g
        FROM (SELECT model_name, {', '.join(f"{O.ngrams('pl', n)} AS g{n}" for n in (1, 2, 3))} FROM pair_metrics) x,
             (SELECT unnest([1, 2, 3]) AS n) ns
        UNION ALL SELECT DISTINCT model_name, n, NULL AS g FROM pair_metrics, (SELECT unnest([1, 2, 3]) AS n) ns) y
  GROUP BY model_name, n),
run_metrics AS (
  SELECT model_name, metric, value FROM (UNPIVOT run ON {', '.join(_EVAL_METRICS)} INTO NAME metric VALUE value)
  UNION ALL SELECT model_name, metric, value FROM dn
  UNION ALL SELECT model_name, metric, value FROM (UNPIVOT (
    SELECT model_name, avg(precision) AS bertscore_precision, avg(recall) AS bertscore_recall, avg(f1) AS bertscore_f1
    FROM em_f GROUP BY model_name) ON bertscore_precision, bertscore_recall, bertscore_f1 INTO NAME metric VALUE value))
"""


@register("evaluate_runs", _with(MCTES + _EVAL_SQL, "SELECT model_name, metric, round(value, 6) AS value FROM run_metrics"))
def q_evaluate_runs(spark, sf_dir):
    return R(run_metrics(spark, sf_dir))


def run_metrics(spark, sf_dir):
    """Every metric of every run."""
    return MT.evaluate(_pairs(spark, sf_dir), embeddings=T.read_table(spark, sf_dir, "embeddings"))


@register("metric_mean_std", _with(PS_CTES, """
SELECT model_name, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
FROM (UNPIVOT (SELECT model_name, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PER_SAMPLE_COLS) + """ FROM per_sample)
      ON """ + ", ".join(PER_SAMPLE_COLS) + """ INTO NAME metric VALUE value)
GROUP BY model_name, metric"""))
def q_metric_mean_std(spark, sf_dir):
    return R(MT.metric_mean_std(per_sample_table(spark, sf_dir)))


# ------------------------------------------------------------------ error analysis and reports

from inkwell.operators import errors as ER  # noqa: E402
from inkwell.operators import reports as RP  # noqa: E402


def labelled_table(spark, sf_dir):
    """Per-sample results with failure labels, materialised (read by several reports)."""
    return materialize(ER.failure_labels(shown_table(spark, sf_dir, rouge1=True)), "labelled")


_NO_GREETING_RE2 = "(?im)^(dear|hi|hello|hey|good)"
_NO_CLOSING_RE2 = "(?i)(regards|sincerely|best|thanks|thank you)"

LAB_CTES = PS_STEM_CTES + f""",
ps_tok AS (SELECT *, {O.ws_tokens('lower(prediction)')} AS lw, len({O.ws_tokens('prediction')}) AS pwc,
                  len({O.ws_tokens('reference')}) AS rwc FROM per_sample),
tri AS (SELECT model_name, sample_id, unnest({O.ngrams('lw', 3)}) AS g FROM ps_tok),
tri_c AS (SELECT model_name, sample_id, g, count(*) AS c FROM tri GROUP BY ALL),
tri_s AS (SELECT model_name, sample_id, max(c) AS maxc, sum(c) AS total, count(*) AS uniq FROM tri_c GROUP BY ALL),
flags AS (
  SELECT p.*, coalesce(t.maxc, 0) AS maxc, coalesce(t.total, 0) AS total, coalesce(t.uniq, 0) AS uniq,
         (len(p.lw) > 10 AND coalesce(t.maxc, 0) >= 3) AS repetition,
         (p.pwc < 10) AS too_short,
         (p.pwc > 2 * p.rwc AND p.rwc > 10) AS too_long,
         NOT regexp_matches(p.prediction, {O.q(_NO_GREETING_RE2)}) AS no_greeting,
         NOT regexp_matches(p.prediction, {O.q(_NO_CLOSING_RE2)}) AS no_closing,
         (coalesce(p.rouge1, 0.0) < 0.1) AS off_topic,
         CASE WHEN len(p.lw) < 4 OR coalesce(t.total, 0) = 0 THEN 0.0
              ELSE (t.total - t.uniq) / t.total END AS repetition_score
  FROM ps_tok p LEFT JOIN tri_s t ON p.model_name = t.model_name AND p.sample_id = t.sample_id),
labelled AS (
  SELECT *, coalesce(nullif(concat_ws(', ',
            CASE WHEN repetition THEN 'repetition' END, CASE WHEN too_short THEN 'too_short' END,
            CASE WHEN too_long THEN 'too_long' END, CASE WHEN no_greeting THEN 'no_greeting' END,
            CASE WHEN no_closing THEN 'no_closing' END, CASE WHEN off_topic THEN 'off_topic' END), ''), 'none')
         AS failure_str
  FROM flags),
modes AS (SELECT model_name, sample_id, unnest(string_split(failure_str, ', ')) AS mode FROM labelled),
mode_counts AS (
  SELECT m.model_name, m.mode, count(*) AS count, any_value(n.n) AS n_samples
  FROM modes m JOIN (SELECT model_name, count(*) AS n FROM labelled GROUP BY model_name) n
    ON m.model_name = n.model_name
  GROUP BY m.model_name, m.mode)
"""

_FLAGS = ("repetition", "too_short", "too_long", "no_greeting", "no_closing", "off_topic")


@register("failure_labels", _with(LAB_CTES, "SELECT model_name, sample_id, failure_str, " + ", ".join(_FLAGS)
                                  + " FROM labelled"))
def q_failure_labels(spark, sf_dir):
    return ER.failure_labels(shown_table(spark, sf_dir, rouge1=True)).select(*MT.KEYS, "failure_str", *_FLAGS)


@register("failure_counts", _with(LAB_CTES, "SELECT model_name, mode, count, round(100.0 * count / n_samples, 6) AS pct "
                                  "FROM mode_counts ORDER BY model_name, count DESC, mode"))
def q_failure_counts(spark, sf_dir):
    return R(ER.failure_counts(labelled_table(spark, sf_dir)))


@register("repetition_scores", _with(LAB_CTES, "SELECT model_name, sample_id, round(repetition_score, 6) AS repetition_score "
                                     "FROM labelled"))
def q_repetition_scores(spark, sf_dir):
    return R(RP.with_repetition(shown_table(spark, sf_dir)).select(*MT.KEYS, "repetition_score"))


_RULES_SQL = " UNION ALL ".join(
    f"SELECT {i} AS rule_pos, {O.q(m)} AS mode, CAST({t} AS DOUBLE) AS threshold, {O.q(msg)} AS message"
    for i, (m, t, msg) in enumerate(fixed.RECOMMENDATION_RULES))


@register("recommendations", _with(LAB_CTES + f", rules AS ({_RULES_SQL})",
                                   "SELECT c.model_name, r.rule_pos, r.mode, r.message FROM mode_counts c "
                                   "JOIN rules r ON c.mode = r.mode AND c.count > r.threshold * c.n_samples "
                                   "ORDER BY c.model_name, r.rule_pos"))
def q_recommendations(spark, sf_dir):
    return ER.recommendations(labelled_table(spark, sf_dir))


@register("error_summary", _with(LAB_CTES, """
SELECT model_name, count(*) AS n_samples, count(*) FILTER (WHERE failure_str = 'none') AS n_clean,
       round(100.0 * count(*) FILTER (WHERE failure_str = 'none') / count(*), 6) AS pct_clean,
       round(avg(rouge1), 6) AS mean_rouge1, round(avg(repetition_score), 6) AS mean_repetition,
       round(max(repetition_score), 6) AS max_repetition,
       count(*) FILTER (WHERE repetition_score > 0.1) AS n_high_repetition,
       round(avg(pwc), 6) AS pred_words_mean, round(stddev_samp(pwc), 6) AS pred_words_std,
       round(avg(rwc), 6) AS ref_words_mean, round(stddev_samp(rwc), 6) AS ref_words_std
FROM labelled GROUP BY model_name"""))
def q_error_summary(spark, sf_dir):
    return R(RP.error_summary(labelled_table(spark, sf_dir)))


@register("worst_samples", _with(LAB_CTES, """
SELECT model_name, sample_id, task_type, round(rouge1, 6) AS rouge1, failure_str, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY rouge1, sample_id) AS rank
  FROM labelled WHERE rouge1 IS NOT NULL AND NOT isnan(rouge1)) w WHERE rank <= 5"""))
def q_worst_samples(spark, sf_dir):
    return R(RP.worst_samples(labelled_table(spark, sf_dir)).select(
        *MT.KEYS, "task_type", "rouge1", "failure_str", "rank"))


@register("most_repetitive", _with(LAB_CTES, """
SELECT model_name, sample_id, round(repetition_score, 6) AS repetition_score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY repetition_score DESC, sample_id) AS rank
  FROM labelled WHERE model_name IN (SELECT model_name FROM labelled GROUP BY model_name
                                     HAVING max(repetition_score) > 0.1)) w WHERE rank <= 3"""))
def q_most_repetitive(spark, sf_dir):
    return R(RP.most_repetitive(shown_table(spark, sf_dir)).select(*MT.KEYS, "repetition_score", "rank"))


@register("sample_listing", _with(PS_CTES, """
SELECT model_name, sample_id, task_type, prompt, prediction, reference, round(rouge1, 6) AS rouge1,
       round("rougeL", 6) AS "rougeL", rank FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY sample_id) AS rank FROM per_sample) w WHERE rank <= 5"""))
def q_sample_listing(spark, sf_dir):
    first = RP.sample_listing(_pairs(spark, sf_dir))  # scores are needed for the listed samples only
    return R(MT.shown(first, rouge1=True, rouge_l=True, carry=("rank",)).select(
        *MT.KEYS, "task_type", "prompt", "prediction", "reference", "rouge1", "rougeL", "rank"))


_TASK_COLS = [c for c in fixed.TASK_METRICS if c in PER_SAMPLE_COLS]


@register("task_metric_stats", _with(PS_CTES, """
SELECT model_name, task_type, metric, round_even(avg(value), 4) AS mean, round_even(stddev_samp(value), 4) AS std
FROM (UNPIVOT (SELECT model_name, task_type, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _TASK_COLS)
                                     + " FROM per_sample) ON " + ", ".join(_TASK_COLS) + """ INTO NAME metric VALUE value)
GROUP BY model_name, task_type, metric"""))
def q_task_metric_stats(spark, sf_dir):
    return RP.task_metric_stats(per_sample_table(spark, sf_dir))


@register("task_types", _with(PS_STEM_CTES, "SELECT DISTINCT task_type FROM per_sample"))
def q_task_types(spark, sf_dir):
    return RP.task_types(shown_table(spark, sf_dir))


@register("box_stats", _with(PS_STEM_CTES, """
, quart AS (
  SELECT model_name, task_type, count(*) AS n, quantile_cont(rouge1, [0.25, 0.5, 0.75]) AS q
  FROM per_sample GROUP BY model_name, task_type)
SELECT p.model_name, p.task_type, any_value(q.n) AS n, round(any_value(q.q[1]), 6) AS q1,
       round(any_value(q.q[2]), 6) AS median, round(any_value(q.q[3]), 6) AS q3,
       round(min(p.rouge1) FILTER (WHERE p.rouge1 BETWEEN q.q[1] - 1.5 * (q.q[3] - q.q[1]) AND q.q[3] + 1.5 * (q.q[3] - q.q[1])), 6) AS whisker_low,
       round(max(p.rouge1) FILTER (WHERE p.rouge1 BETWEEN q.q[1] - 1.5 * (q.q[3] - q.q[1]) AND q.q[3] + 1.5 * (q.q[3] - q.q[1])), 6) AS whisker_high,
       count(*) FILTER (WHERE NOT (p.rouge1 BETWEEN q.q[1] - 1.5 * (q.q[3] - q.q[1]) AND q.q[3] + 1.5 * (q.q[3] - q.q[1]))) AS n_outliers
FROM per_sample p JOIN quart q ON p.model_name = q.model_name AND p.task_type = q.task_type
GROUP BY p.model_name, p.task_type""".replace("\n, quart", ", quart", 1)))
def q_box_stats(spark, sf_dir):
    return R(RP.box_stats(shown_table(spark, sf_dir, rouge1=True)))


@register("length_histogram", _with(LAB_CTES, """
, series AS (
  SELECT model_name, 'generated' AS series, CAST(pwc AS DOUBLE) AS x FROM labelled
  UNION ALL SELECT model_name, 'reference' AS series, CAST(rwc AS DOUBLE) AS x FROM labelled),
rng0 AS (SELECT model_name, series, min(x) AS lo0, max(x) AS hi0 FROM series GROUP BY ALL),
rng AS (SELECT model_name, series, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
               CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM rng0),
binned AS (SELECT s.model_name, s.series, CAST(least(floor((s.x - r.lo) / ((r.hi - r.lo) / 30)), 29) AS INTEGER) AS bin
           FROM series s JOIN rng r ON s.model_name = r.model_name AND s.series = r.series),
counts AS (SELECT model_name, series, bin, count(*) AS c FROM binned GROUP BY ALL),
grid AS (SELECT model_name, series, lo, hi, unnest(range(0, 30)) AS bin FROM rng)
SELECT g.model_name, g.series, CAST(g.bin AS INTEGER) AS bin, round(g.lo + g.bin * ((g.hi - g.lo) / 30), 6) AS bin_start,
       round(CASE WHEN g.bin = 29 THEN g.hi ELSE g.lo + (g.bin + 1) * ((g.hi - g.lo) / 30) END, 6) AS bin_end,
       coalesce(c.c, 0) AS count
FROM grid g LEFT JOIN counts c ON g.model_name = c.model_name AND g.series = c.series AND g.bin = c.bin
""".replace("\n, series", ", series", 1)))
def q_length_histogram(spark, sf_dir):
    return R(RP.length_histogram(shown_table(spark, sf_dir)))


@register("length_scatter", _with(LAB_CTES, """
SELECT l.model_name, l.sample_id, l.rwc AS ref_word_count, l.pwc AS pred_word_count, m.line_max
FROM labelled l JOIN (SELECT model_name, greatest(max(rwc), max(pwc)) AS line_max FROM labelled GROUP BY model_name) m
  ON l.model_name = m.model_name"""))
def q_length_scatter(spark, sf_dir):
    return RP.length_scatter(shown_table(spark, sf_dir))


# ---- reports over run metrics

def run_metrics_table(spark, sf_dir):
    return materialize(run_metrics(spark, sf_dir), "run_metrics")


_GROUPS_SQL = " UNION ALL ".join(
    f"SELECT {gi} AS group_pos, {O.q(g)} AS metric_group, {mi} AS metric_pos, {O.q(m)} AS metric"
    for gi, (g, ms) in enumerate(fixed.METRIC_GROUPS) for mi, m in enumerate(ms))


@register("results_table", _with(MCTES + _EVAL_SQL + f", groups AS ({_GROUPS_SQL})", """
SELECT r.model_name, g.group_pos, g.metric_group, g.metric_pos, g.metric, printf('%.4f', r.value) AS display
FROM run_metrics r JOIN groups g ON r.metric = g.metric ORDER BY r.model_name, g.group_pos, g.metric_pos"""))
def q_results_table(spark, sf_dir):
    return RP.results_table(run_metrics_table(spark, sf_dir))


_KEYS_SQL = " UNION ALL ".join(f"SELECT {i} AS pos, {O.q(k)} AS metric" for i, k in enumerate(fixed.COMPARE_KEYS))


@register("compare_runs", _with(MCTES + _EVAL_SQL + f", ckeys AS ({_KEYS_SQL})", """
, cmp AS (
  SELECT k.pos, k.metric,
         coalesce(max(r.value) FILTER (WHERE r.model_name = 'base'), 0.0) AS base,
         coalesce(max(r.value) FILTER (WHERE r.model_name = 'fine_tuned'), 0.0) AS fine_tuned
  FROM ckeys k LEFT JOIN run_metrics r ON r.metric = k.metric GROUP BY k.pos, k.metric)
SELECT pos, metric, round(base, 6) AS base, round(fine_tuned, 6) AS fine_tuned, round(fine_tuned - base, 6) AS delta,
       printf('%.4f', base) AS base_display, printf('%.4f', fine_tuned) AS fine_tuned_display,
       CASE WHEN fine_tuned - base >= 0 THEN '+' ELSE '' END || printf('%.4f', fine_tuned - base) AS delta_display
FROM cmp ORDER BY pos""".replace("\n, cmp", ", cmp", 1)))
def q_compare_runs(spark, sf_dir):
    return R(RP.compare_runs(run_metrics_table(spark, sf_dir)))


_SERIES_SQL = " UNION ALL ".join(f"SELECT {O.q(c)} AS chart, {i} AS pos, {O.q(m)} AS metric"
                                 for c, ms in fixed.CHART_SERIES for i, m in enumerate(ms))


@register("chart_bars", _with(MCTES + _EVAL_SQL + f", series AS ({_SERIES_SQL})", """
SELECT m.model_name, s.chart, s.pos, s.metric, round(coalesce(r.value, 0.0), 6) AS value
FROM (SELECT DISTINCT model_name FROM run_metrics) m CROSS JOIN series s
LEFT JOIN run_metrics r ON r.model_name = m.model_name AND r.metric = s.metric"""))
def q_chart_bars(spark, sf_dir):
    return R(RP.chart_bars(run_metrics_table(spark, sf_dir)))


@register("chart_lengths", _with(MCTES + _EVAL_SQL, """
SELECT model_name, pos, category, round(coalesce(pred, 0.0) / scale, 6) AS generated,
       round(coalesce(ref, 0.0) / scale, 6) AS reference
FROM (SELECT r.model_name, c.pos, c.category, c.scale,
             max(r.value) FILTER (WHERE r.metric = 'pred_' || c.stat || '_mean') AS pred,
             max(r.value) FILTER (WHERE r.metric = 'ref_' || c.stat || '_mean') AS ref
      FROM run_metrics r, (SELECT 0 AS pos, 'Words' AS category, 'word_count' AS stat, 1.0 AS scale
                           UNION ALL SELECT 1, 'Sentences', 'sentence_count', 1.0
                           UNION ALL SELECT 2, 'Chars (÷10)', 'char_count', 10.0) c
      GROUP BY r.model_name, c.pos, c.category, c.scale) x"""))
def q_chart_lengths(spark, sf_dir):
    return R(RP.chart_lengths(run_metrics_table(spark, sf_dir)))


# ------------------------------------------------------------------ prompts, chats, sequences

from inkwell.operators import prompts as PR  # noqa: E402


def chats(spark, sf_dir):
    return PR.conversations_to_chats(T.read_table(spark, sf_dir, "conversations"))


_HDR = "'<|start_header_id|>' || x.role || '<|end_header_id|>' || chr(10) || chr(10)"
CHAT_CTES = f"""
chats AS (
  SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS messages
  FROM conversations GROUP BY conv_id),
chat_parts AS (
  SELECT conv_id, messages,
         list_filter(messages, lambda x: x.role <> 'assistant') AS prompt_messages,
         coalesce(list_filter(messages, lambda x: x.role = 'assistant')[-1].content, '') AS reference
  FROM chats),
rendered AS (
  SELECT *, '<|begin_of_text|>' || array_to_string(list_transform(messages, lambda x: {_HDR} || x.content || '<|eot_id|>'), '') AS chat_text,
         '<|begin_of_text|>' || array_to_string(list_transform(prompt_messages, lambda x: {_HDR} || x.content || '<|eot_id|>'), '')
           || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) AS prompt_text
  FROM chat_parts),
seq AS (
  SELECT conv_id, len({O.ws_tokens('chat_text')}) AS n_tokens FROM rendered)
"""


def _chat_parts(spark, sf_dir):
    c = chats(spark, sf_dir)
    prompt, reference = PR.prompt_and_reference("messages")
    return c.select("conv_id", "messages", prompt.alias("prompt_messages"), reference.alias("reference"))


@register("prompt_reference", _with(CHAT_CTES, """
SELECT conv_id, len(prompt_messages) AS n_prompt_messages, substr(coalesce(prompt_messages[-1].content, ''), 1, 200) AS prompt,
       substr(reference, 1, 500) AS reference, length(reference) AS reference_chars FROM chat_parts"""))
def q_prompt_reference(spark, sf_dir):
    p = _chat_parts(spark, sf_dir)
    t = PR.truncate_fields(p.withColumn("prediction", F.lit("")).withColumn("task_type", F.lit(None).cast("string")))
    return t.select("conv_id", F.size("prompt_messages").cast("long").alias("n_prompt_messages"),
                    F.col("prompt_display").alias("prompt"), F.col("reference_display").alias("reference"),
                    F.length("reference").cast("long").alias("reference_chars"))


@register("render_chat", _with(CHAT_CTES, "SELECT conv_id, chat_text, prompt_text FROM rendered"))
def q_render_chat(spark, sf_dir):
    p = _chat_parts(spark, sf_dir)
    return p.select("conv_id", PR.render_chat("messages").alias("chat_text"),
                    PR.render_chat("prompt_messages", generation_cue=True).alias("prompt_text"))


_REQ_HDR = lambda role: f"'<|start_header_id|>{role}<|end_header_id|>' || chr(10) || chr(10)"


def _tone_sql() -> str:
    return "CASE WHEN tone <> 'Professional' THEN ' Use a ' || lower(tone) || ' tone.' ELSE '' END"


@register("request_prompts", _with(f"requests AS ({T.view_sql('requests')})", f"""
, p AS (
  SELECT item_id,
         CASE WHEN {O.strip('subject')} <> '' THEN {O.q(fixed.COMPOSE_PREFIX)} || subject || {_tone_sql()} ||
              CASE WHEN {O.strip('context')} <> '' THEN chr(10) || chr(10) || 'Additional context: ' || context ELSE '' END END AS compose_prompt,
         CASE WHEN {O.strip('subject')} = '' THEN {O.q(fixed.BLANK_SUBJECT_MESSAGE)} END AS compose_error,
         CASE WHEN {O.strip('original_email')} <> '' THEN 'Reply to this email:' || {_tone_sql()} || chr(10) || chr(10) || original_email END AS reply_prompt,
         CASE WHEN {O.strip('original_email')} = '' THEN {O.q(fixed.BLANK_EMAIL_MESSAGE)} END AS reply_error
  FROM requests)
SELECT item_id, compose_prompt, compose_error,
       '<|begin_of_text|>' || {_REQ_HDR('system')} || {O.q(fixed.SYSTEM_PROMPT_COMPOSE)} || '<|eot_id|>' || {_REQ_HDR('user')}
         || compose_prompt || '<|eot_id|>' || {_REQ_HDR('assistant')} AS compose_chat,
       reply_prompt, reply_error,
       '<|begin_of_text|>' || {_REQ_HDR('system')} || {O.q(fixed.SYSTEM_PROMPT_REPLY)} || '<|eot_id|>' || {_REQ_HDR('user')}
         || reply_prompt || '<|eot_id|>' || {_REQ_HDR('assistant')} AS reply_chat
FROM p""".replace("\n, p AS", ", p AS", 1)))
def q_request_prompts(spark, sf_dir):
    return PR.request_prompts(T.requests(spark, sf_dir))


def _seq(spark, sf_dir):
    p = _chat_parts(spark, sf_dir)
    return PR.seq_length_cut(p.select("conv_id", PR.render_chat("messages").alias("text")), "text")


@register("seq_length_cut", _with(CHAT_CTES, f"""
SELECT conv_id, n_tokens, n_tokens > {fixed.MAX_SEQ_LENGTH} AS over_length, least(n_tokens, {fixed.MAX_SEQ_LENGTH}) AS kept_tokens
FROM seq"""))
def q_seq_length_cut(spark, sf_dir):
    return _seq(spark, sf_dir).select("conv_id", "n_tokens", "over_length", "kept_tokens")


@register("pack_sequences", _with(CHAT_CTES, f"""
, st AS (
  SELECT conv_id, n_tokens, CAST(coalesce(sum(n_tokens) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
  FROM seq),
pieces AS (
  SELECT conv_id, n_tokens, s, unnest(range(CAST(floor(s / {fixed.MAX_SEQ_LENGTH}) AS BIGINT),
                                            CAST(floor((s + n_tokens - 1) / {fixed.MAX_SEQ_LENGTH}) AS BIGINT) + 1)) AS chunk
  FROM st WHERE n_tokens > 0)
SELECT chunk, conv_id, greatest(s, chunk * {fixed.MAX_SEQ_LENGTH}) - s AS token_from,
       least(s + n_tokens, (chunk + 1) * {fixed.MAX_SEQ_LENGTH}) - s AS token_to
FROM pieces""".replace("\n, st AS", ", st AS", 1)))
def q_pack_sequences(spark, sf_dir):
    return PR.pack_sequences(_seq(spark, sf_dir), "conv_id", "n_tokens", fixed.MAX_SEQ_LENGTH)


# ------------------------------------------------------------------ file sources and sinks

@register("mail_tree_scan", _with(O.CORPUS_CTES,
                                  'SELECT "user", box, subject, from_addr, body, body_hash FROM messages'))
def q_mail_tree_scan(spark, sf_dir):
    """raw_messages written as a real mail tree, some of its folders with hidden file names, then
    scanned back (S1-S4) and run through parse/clean/filter/dedup."""
    root = _scratch(spark, "maildir")
    raw = T.raw_messages(spark, sf_dir)
    hidden = F.when(F.col("folder") == "notes_inbox", "_").when(F.col("folder") == "sent", ".").otherwise("")
    JS.write_mail_tree(raw, root, F.concat(hidden, F.col("doc_id").cast("string")))
    raw = MD.read_maildir(spark, root)
    msgs = C.dedup_first(M.prepare_messages(raw, size_col="length"))
    return msgs.select("user", "box", "subject", "from_addr", "body", "body_hash")


@register("jsonl_roundtrip", _with(SPLIT_CTES, "SELECT sample_id, task_type, split, user_content FROM splits"))
def q_jsonl_roundtrip(spark, sf_dir):
    """Split samples written as JSON Lines (raw + partitioned train/val) and read back (S5-S8)."""
    split = S.stratified_split(samples(spark, sf_dir))
    paths = JS.write_splits(split, _scratch(spark, "samples"))
    back = (JS.read_samples(spark, paths["train"]).withColumn("split", F.lit("train"))
            .unionByName(JS.read_samples(spark, paths["val"]).withColumn("split", F.lit("val"))))
    return back.select("sample_id", "task_type", "split", F.col("messages")[1]["content"].alias("user_content"))


@register("jsonl_all", _with(SPLIT_CTES, "SELECT sample_id, task_type, user_content FROM splits"))
def q_jsonl_all(spark, sf_dir):
    """The sink of all samples, before the split, read back (S8's third file)."""
    paths = JS.write_splits(S.stratified_split(samples(spark, sf_dir)), _scratch(spark, "samples"))
    return JS.read_samples(spark, paths["raw"]).select(
        "sample_id", "task_type", F.col("messages")[1]["content"].alias("user_content"))


@register("results_roundtrip", _with(MCTES + _EVAL_SQL, f"""
SELECT model_name, metric, round(value, 6) AS value FROM run_metrics
UNION ALL SELECT model_name, 'num_samples', count(*) FROM pair_metrics GROUP BY model_name
UNION ALL SELECT DISTINCT model_name, 'max_samples', {fixed.EVAL_MAX_SAMPLES}.0 FROM pair_metrics
UNION ALL SELECT model_name, 'sum_of_rougeL', round(sum(rougeL), 6) FROM pair_metrics GROUP BY model_name"""))
def q_results_roundtrip(spark, sf_dir):
    """Metrics, per-sample results, sample counts and config written as tables and as a run
    document, the document read back (S9-S10)."""
    out = _scratch(spark, "results")
    config = {"max_samples": fixed.EVAL_MAX_SAMPLES}
    RS.write_results(run_metrics(spark, sf_dir), per_sample_table(spark, sf_dir), out, config)
    RS.write_run(*RS.read_results(spark, out), f"{out}/document", config)
    metrics, samples, about = RS.read_run(spark, f"{out}/document")
    more = about.select("model_name", F.inline(F.array(
        F.struct(F.lit("num_samples").alias("metric"), F.col("num_samples").cast("double").alias("value")),
        F.struct(F.lit("max_samples").alias("metric"), F.col("config")["max_samples"].cast("double").alias("value")))))
    sums = samples.groupBy("model_name").agg(F.sum("rougeL").alias("value")).select(
        "model_name", F.lit("sum_of_rougeL").alias("metric"), "value")
    return R(metrics.unionByName(more).unionByName(sums))


@register("nested_results", _with(PS_CTES, f"""
SELECT model_name, task_type AS item, 'sum_of_rougeL' AS metric, round(sum("rougeL"), 6) AS value FROM per_sample
GROUP BY model_name, task_type
UNION ALL SELECT model_name, CASE model_name WHEN 'fine_tuned' THEN 'fine-tuned' ELSE model_name END, 'num_samples',
                 count(*)::DOUBLE FROM per_sample GROUP BY model_name
UNION ALL SELECT model_name, 'mean of documents', 'rouge1', round(avg(m), 6) FROM (
  SELECT model_name, avg(rouge1) AS m FROM per_sample
  GROUP BY model_name, CAST(split_part(sample_id, ':', 1) AS BIGINT) // {SHARD}) d GROUP BY model_name"""))
def q_nested_results(spark, sf_dir):
    """Per-sample results written as nested run documents, one for each SHARD conversations, and read back
    into samples, counts, labels and metrics (S10)."""
    path = _scratch(spark, "nested")
    shown = MT.shown(_pairs(spark, sf_dir), rouge1=True, rouge_l=True)
    shard = F.floor(F.split_part("sample_id", F.lit(":"), F.lit(1)).cast("long") / SHARD)
    RS.write_run_documents(shown, shard, ["rouge1", "rougeL"], path)
    metrics, read, about = RS.read_run_json(spark, path, lines=True)
    sums = read.groupBy("model_name", F.col("task_type").alias("item")).agg(F.sum("rougeL").alias("value"))
    counts = about.groupBy("model_name", F.col("label").alias("item")).agg(F.sum("num_samples").cast("double").alias("value"))
    means = metrics.where("metric = 'rouge1'").groupBy("model_name").agg(F.avg("value").alias("value"))
    out = lambda df, item, metric: df.select("model_name", item, F.lit(metric).alias("metric"), "value")
    return R(out(sums, "item", "sum_of_rougeL").unionByName(out(counts, "item", "num_samples")).unionByName(
        out(means, F.lit("mean of documents").alias("item"), "rouge1")))


@register("compare_run_document", ORACLE["compare_runs"])
def q_compare_run_document(spark, sf_dir):
    """The comparison from a run document's header, whose tuned run is labelled "fine-tuned" (C2, J4)."""
    path = _scratch(spark, "document")
    counts = _pairs(spark, sf_dir).groupBy("model_name").agg(F.count(F.lit(1)).alias("num_samples"))
    RS.write_run_header(run_metrics(spark, sf_dir), counts, path)
    metrics, _ = RS.read_run_header(spark, path)
    return R(RP.compare_runs(metrics))


@register("join_predictions", f"""
WITH pairs AS ({T.view_sql('pairs')})
SELECT model_name, sample_id, task_type, length(prompt) AS prompt_chars, length(prediction) AS prediction_chars,
       length(reference) AS reference_chars FROM pairs WHERE length(prediction) % 5 <> 0""")
def q_join_predictions(spark, sf_dir):
    """Predictions of two models, some missing, joined to their samples by key (J2)."""
    p = _pairs(spark, sf_dir)
    samples = p.where("model_name = 'base'").select("sample_id", "task_type", "prompt", "reference")
    predictions = p.where(F.length("prediction") % 5 != 0).select("model_name", "sample_id", "prediction")
    j = RS.join_predictions(samples, predictions)
    chars = [F.length(c).cast("long").alias(f"{c}_chars") for c in ("prompt", "prediction", "reference")]
    return j.select("model_name", "sample_id", "task_type", *chars)


# ------------------------------------------------------------------ stemming and embedding match

from inkwell.operators import embedding as EM  # noqa: E402


@register("rouge_stemmed", _with(MCTES, "SELECT model_name, sample_id, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, "
                                 "round(rougeL, 6) AS \"rougeL\" FROM pair_metrics"))
def q_rouge_stemmed(spark, sf_dir):
    """ROUGE-1/2/L with Porter-stemmed tokens."""
    return R(MT.pair_scores(_pairs(spark, sf_dir), with_bleu=False).select(
        *MT.KEYS, "rouge1", "rouge2", "rougeL"))


@register("embedding_match", _with(RAW_CTES + _EMB, """
SELECT model_name, sample_id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM em_f"""))
def q_embedding_match(spark, sf_dir):
    return R(EM.embedding_match(_pairs(spark, sf_dir), T.read_table(spark, sf_dir, "embeddings")))


@register("evaluate_full", _with(MCTES + _EVAL_SQL, "SELECT model_name, metric, round(value, 6) AS value FROM run_metrics"))
def q_evaluate_full(spark, sf_dir):
    """Every corpus metric per run: stemmed ROUGE-1/2/L, BLEU, embedding match,
    distinct-n, format compliance, length stats."""
    return R(run_metrics(spark, sf_dir))


# ------------------------------------------------------------------ pipeline audits

_REJECTED = f"""
, rejected AS (
  SELECT c.doc_id, CASE WHEN length(c.body) < 50 OR length(c.body) > 2000 THEN 'body_length'
              WHEN {O.strip('c.subject')} = '' THEN 'blank_subject'
              ELSE 'auto_subject' END AS stage
  FROM cleaned c WHERE c.doc_id NOT IN (SELECT doc_id FROM valid))""".replace("\n,", ",", 1)

_STAGES = _with(O.CORPUS_CTES, _REJECTED + """
SELECT 'files' AS stage, count(*) AS n FROM raw_messages
UNION ALL SELECT 'skipped_folder', count(*) FROM sel WHERE box IS NULL
UNION ALL SELECT 'oversize', count(*) FROM chosen WHERE octet_length(encode(content)) > 7000
UNION ALL SELECT 'no_blank_line', count(*) FROM sized WHERE pos = 0
UNION ALL SELECT stage, count(*) FROM rejected GROUP BY stage
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM valid) - (SELECT count(*) FROM messages)
UNION ALL SELECT box, count(*) FROM messages GROUP BY box""")


@register("stage_counts", _STAGES)
def q_stage_counts(spark, sf_dir):
    return C.stage_counts(T.raw_messages(spark, sf_dir))


@register("reject_list", _with(O.CORPUS_CTES, _REJECTED + """
SELECT user_name AS "user", r.path, CASE
    WHEN s.box IS NULL THEN 'skipped_folder'
    WHEN z.doc_id IS NULL THEN 'oversize'
    WHEN z.pos = 0 THEN 'no_blank_line'
    ELSE coalesce(j.stage, 'duplicates') END AS reason
FROM raw_messages r JOIN sel s USING (doc_id) LEFT JOIN sized z USING (doc_id) LEFT JOIN rejected j USING (doc_id)
WHERE r.path NOT IN (SELECT path FROM messages)"""))
def q_reject_list(spark, sf_dir):
    """Every file that the corpus leaves out, with its reason; messages and counts come from the same pass."""
    return C.build_corpus(T.raw_messages(spark, sf_dir)).rejects


@register("leakage_audit", _with(SPLIT_CTES, """
SELECT count(*) AS bodies_in_both FROM (
  SELECT md5(assistant_content) AS h FROM splits GROUP BY 1 HAVING count(DISTINCT split) > 1) x"""))
def q_leakage_audit(spark, sf_dir):
    split = S.stratified_split(samples(spark, sf_dir))
    return S.leakage_audit(split)


@register("val_load", _with(SPLIT_CTES, f"""
SELECT sample_id, task_type, user_content FROM splits WHERE split = 'val'
ORDER BY sample_id LIMIT {VAL_CHECK}"""))
def q_val_load(spark, sf_dir):
    """Validation samples written as JSONL, then loaded back limited to the first
    ``max_samples`` by id (the evaluation loader; the limit is the feature)."""
    split = S.stratified_split(samples(spark, sf_dir))
    paths = JS.write_splits(split, _scratch(spark, "samples"))
    val = JS.read_val(spark, paths["val"], VAL_CHECK)
    return val.select("sample_id", "task_type", F.col("messages")[1]["content"].alias("user_content"))


# ------------------------------------------------------------------ streaming

from inkwell.streaming import ingest as IG  # noqa: E402


@register("stream_ingest", _with(O.CORPUS_CTES,
                                 'SELECT "user", box, subject, body, body_hash FROM messages'))
def q_stream_ingest(spark, sf_dir):
    """raw_messages landed as files and ingested by the Structured Streaming job
    (stateless cleaning, per-trigger dedup against the sink), run to completion."""
    src, sink, ckpt = _scratch(spark, "landing"), _scratch(spark, "ingested"), _scratch(spark, "ingest-ckpt")
    T.raw_messages(spark, sf_dir).select("path", "user", "folder", "content").write.parquet(src)
    q = IG.start_ingest(IG.read_raw_stream(spark, src), sink, ckpt, trigger_once=True)
    q.awaitTermination()
    return spark.read.parquet(sink).select("user", "box", "subject", "body", "body_hash")
