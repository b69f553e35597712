"""Corpus building: dedup, compose samples, reply threading, union and counts.

Order is ``ord = (user, path)``: "first" always means smallest ``(user, path)``.
Both "first per key" steps are plain ``min(struct(...))`` aggregates, so Spark
combines map-side before the shuffle: a key held by a third of all rows still
sends at most one row per map task to its reducer.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.operators.messages import is_reply_subject, normalise_subject, strip_subject_prefix
from inkwell.functions.text import py_strip
from inkwell.session import materialize

MESSAGE_COLUMNS = ("user", "path", "box", "message_id", "date", "from_addr", "to_addr", "cc",
                   "subject", "body", "x_folder")
REJECT_REASONS = ("skipped_folder", "oversize", "no_blank_line", "body_length", "blank_subject", "auto_subject")
SAMPLE_SCHEMA = ("sample_id", "task_type", "messages")


def body_hash(body="body") -> Column:
    return F.md5(F.encode(F.col(body) if isinstance(body, str) else body, "UTF-8"))


def dedup_first(messages: DataFrame) -> DataFrame:
    """Keep the first message (by user, path) per MD5 of its body, over all boxes.

    Must run after the quality filter: the hash covers the body only, so a copy
    with a bad subject must not win.
    """
    cols = [c for c in MESSAGE_COLUMNS if c in messages.columns]
    # stored once, so that parsing runs once; the choice then reads three narrow columns, and no body is sorted
    hashed = materialize(messages.select(*cols, body_hash("body").alias("body_hash")), "hashed")
    first = (hashed.groupBy("body_hash").agg(F.min(F.struct("user", "path")).alias("m"))
             .select("body_hash", F.col("m.user").alias("user"), F.col("m.path").alias("path")))
    return hashed.join(first, ["body_hash", "user", "path"], "left_semi").select(*cols, "body_hash")


def sample_id(task_type: str, key="path") -> Column:
    """Stable unique id: md5('<task>:<path>')."""
    return F.md5(F.concat(F.lit(task_type + ":"), F.col(key)))


def _chat(system: str, user: Column, assistant: Column) -> Column:
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
        F.struct(F.lit("assistant").alias("role"), assistant.alias("content")),
    )


def compose_samples(messages: DataFrame) -> DataFrame:
    """One compose sample per sent message with a non-empty cleaned subject and body."""
    sent = messages.where(F.col("box") == "sent")
    subj = strip_subject_prefix("subject")
    body = py_strip("body")
    return (sent.select("path", subj.alias("clean_subject"), body.alias("b"))
            .where((F.col("clean_subject") != "") & (F.col("b") != ""))
            .select(sample_id("compose").alias("sample_id"),
                    F.lit("compose").alias("task_type"),
                    _chat(fixed.SYSTEM_PROMPT_COMPOSE,
                          F.concat(F.lit(fixed.COMPOSE_PREFIX), F.col("clean_subject")),
                          F.col("b")).alias("messages")))


def first_inbox_by_subject(messages: DataFrame) -> DataFrame:
    """First inbox message (by user, path) per non-empty normalised subject."""
    inbox = (messages.where(F.col("box") == "inbox")
             .select(normalise_subject("subject").alias("norm_subject"), "user", "path",
                     "from_addr", py_strip("subject").alias("orig_subject"),
                     py_strip("body").alias("orig_body"))
             .where(F.col("norm_subject") != ""))
    return (inbox.groupBy("norm_subject")
            .agg(F.min(F.struct("user", "path", "from_addr", "orig_subject", "orig_body")).alias("o"))
            .select("norm_subject", "o.from_addr", "o.orig_subject", "o.orig_body"))


def reply_pairs(messages: DataFrame) -> DataFrame:
    """Sent replies ('Re:' subjects) joined to the first inbox message with the same subject.

    The inbox side is reduced to one row per subject first, so the join cannot fan
    out; many replies may share one original. The originals are stored: were they aggregated in the join's
    own plan, aggregate and join would share one exchange, which AQE must leave whole. As it is, Spark broadcasts them
    if their measured size allows, and otherwise both sides are plain exchanges, in which AQE splits a
    subject that holds many replies and gives each part the one original.
    """
    replies = (messages.where((F.col("box") == "sent") & is_reply_subject("subject"))
               .select("path", normalise_subject("subject").alias("norm_subject"),
                       py_strip("body").alias("reply_body"))
               .where(F.col("norm_subject") != ""))
    originals = materialize(first_inbox_by_subject(messages), "originals")
    joined = replies.join(originals, "norm_subject", "inner")
    joined = joined.where((F.col("orig_body") != "") & (F.col("reply_body") != ""))
    prompt = F.concat(F.lit(fixed.REPLY_PREFIX + "\n\nFrom: "), F.col("from_addr"),
                      F.lit("\nSubject: "), F.col("orig_subject"), F.lit("\n\n"), F.col("orig_body"))
    return joined.select(sample_id("reply").alias("sample_id"), F.lit("reply").alias("task_type"),
                         _chat(fixed.SYSTEM_PROMPT_REPLY, prompt, F.col("reply_body")).alias("messages"))


def all_samples(messages: DataFrame) -> DataFrame:
    """Compose and reply samples together (bag union)."""
    return compose_samples(messages).unionByName(reply_pairs(messages))


def flatten_samples(samples: DataFrame) -> DataFrame:
    """One column per chat role, for tabular checks."""
    m = F.col("messages")
    return samples.select("sample_id", "task_type",
                          m[0]["content"].alias("system_content"),
                          m[1]["content"].alias("user_content"),
                          m[2]["content"].alias("assistant_content"))


def user_box_counts(messages: DataFrame) -> DataFrame:
    """Messages per (user, box) with per-user and grand totals (rollup)."""
    return messages.rollup("user", "box").agg(F.count(F.lit(1)).alias("n_messages"))


def checked_messages(raw: DataFrame, min_body_len: int = fixed.MIN_BODY_LENGTH,
                     max_body_len: int = fixed.MAX_BODY_LENGTH, size_col: str | None = None) -> DataFrame:
    """One row per file with the first check it fails: ``user, path, box, reason``, the message columns and ``body_hash``.

    Checks, in pipeline order: skipped_folder, oversize, no_blank_line, body_length, blank_subject,
    auto_subject; ``reason`` is null for a message that passes all. The text of a file that fails one of the first
    three is not parsed, and no rejected file keeps message columns.
    """
    from inkwell.operators.messages import clean_body, evaluated_once, folder_box, message_columns

    limit = max_body_len + fixed.FILE_SIZE_SLACK
    size = F.col(size_col) if size_col else F.octet_length("content")
    early = (F.when(F.col("box").isNull(), F.lit("skipped_folder"))
             .when(F.col("_size") > limit, F.lit("oversize"))
             .when(F.coalesce(F.instr("content", "\n\n"), F.lit(0)) == 0, F.lit("no_blank_line")))
    tagged = raw.select("user", "path", "content", folder_box("folder").alias("box"), size.alias("_size"))
    tagged = tagged.select("user", "path", "box", early.alias("_early"), "content")
    parsed = message_columns(
        tagged.withColumn("content", F.when(F.col("_early").isNull(), F.col("content")))).withColumn(
        "body", clean_body("body"))
    n = F.length("body")
    low = F.lower("subject")
    auto = F.lit(False)
    for kw in fixed.AUTO_SUBJECT_KEYWORDS:
        auto = auto | F.contains(low, F.lit(kw))
    reason = (F.when(F.col("_early").isNotNull(), F.col("_early"))
              .when((n < min_body_len) | (n > max_body_len), F.lit("body_length"))
              .when(py_strip("subject") == "", F.lit("blank_subject"))
              .when(auto, F.lit("auto_subject")))
    message = [c for c in MESSAGE_COLUMNS if c not in ("user", "path", "box")]
    checked = evaluated_once(evaluated_once(parsed.select("user", "path", "box", "_early", *message)).select(
        "user", "path", "box", reason.alias("reason"), *message, body_hash("body").alias("body_hash")))
    valid = F.col("reason").isNull()
    return checked.select("user", "path", "box", "reason",
                          *[F.when(valid, F.col(c)).alias(c) for c in (*message, "body_hash")])


def stage_counts(raw: DataFrame, min_body_len: int = fixed.MIN_BODY_LENGTH,
                 max_body_len: int = fixed.MAX_BODY_LENGTH, size_col: str | None = None) -> DataFrame:
    """Rows removed or kept at each corpus stage, as ``(stage, n)``.

    Stages: files, the checks of ``checked_messages``, duplicates, and the kept messages per box (sent, inbox).
    One scan and one parse give a narrow row per file (stage, or the body's hash); one aggregate by hash and
    one of its few kinds follow. ``build_corpus`` gives the same counts beside the corpus itself.
    """
    checked = checked_messages(raw, min_body_len, max_body_len, size_col)
    valid = F.col("reason").isNull()
    by_hash = checked.groupBy("reason", F.col("body_hash").alias("h")).agg(
        F.count(F.lit(1)).alias("c"), F.min(F.when(valid, F.struct("user", "path", "box"))).alias("m"))
    row = lambda stage, n: F.struct(stage.alias("stage"), n.cast("long").alias("n"))
    files = row(F.lit("files"), F.col("c"))
    kept = F.array(files, row(F.lit("duplicates"), F.col("c") - 1), row(F.col("m.box"), F.lit(1)))
    lost = F.array(files, row(F.col("reason"), F.col("c")))
    rows = by_hash.select(F.inline(F.when(valid, kept).otherwise(lost)))
    always = raw.sparkSession.createDataFrame(
        [(x, 0) for x in ("files", "skipped_folder", "oversize", "no_blank_line", "duplicates")], "stage string, n long")
    return rows.unionByName(always).groupBy("stage").agg(F.sum("n").alias("n"))


class Corpus(NamedTuple):
    """What one pass over the files leaves: the deduplicated messages, every rejected file with its reason, and
    the counts of the stages."""

    messages: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def build_corpus(raw: DataFrame, min_body_len: int = fixed.MIN_BODY_LENGTH,
                 max_body_len: int = fixed.MAX_BODY_LENGTH, size_col: str | None = None) -> Corpus:
    """Messages, rejects and counts from one scan and one parse of ``raw``.

    The job that stores the checked files counts them as they pass (``DataFrame.observe``), so the counts of the
    checks need no second read. First copies are chosen from narrow columns of the stored table; the others are
    rejects with reason ``duplicates``. ``rejects`` is (user, path, reason); a path that occurs
    more than once is judged row by row. ``counts`` names every stage, also those without a file.
    """
    checked = checked_messages(raw, min_body_len, max_body_len, size_col)
    seen = Observation("checked files")
    of = lambda cond: F.coalesce(F.sum(F.when(cond, 1)), F.lit(0))
    watched = checked.observe(seen, F.count(F.lit(1)).alias("files"),
                              *[of(F.col("reason") == r).alias(r) for r in REJECT_REASONS])
    files = materialize(watched, "checked").withColumn(
        "_row", F.struct("_metadata.file_path", "_metadata.row_index"))
    valid = files.where(F.col("reason").isNull())
    # the row's place last: of two rows with one user and path, one stays
    first = materialize(valid.groupBy("body_hash").agg(F.min(F.struct("user", "path", "_row", "box")).alias("m"))
                        .select("body_hash", F.col("m._row").alias("_row"), F.col("m.box").alias("box")), "first")
    winners = first.select("body_hash", "_row")
    messages = valid.join(winners, ["body_hash", "_row"], "left_semi").select(*MESSAGE_COLUMNS, "body_hash")
    copies = valid.join(winners, ["body_hash", "_row"], "left_anti")
    rejects = files.where(F.col("reason").isNotNull()).select("user", "path", "reason").unionByName(
        copies.select("user", "path", F.lit("duplicates").alias("reason")))
    boxes = first.agg(*[of(F.col("box") == b).alias(b) for b in ("sent", "inbox")]).first().asDict()
    counts = dict(seen.get)
    kept = sum(boxes.values())
    passed = counts["files"] - sum(counts[r] for r in REJECT_REASONS)
    return Corpus(messages, rejects, {**counts, "duplicates": passed - kept, **boxes})
