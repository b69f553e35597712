"""Prompt construction, chat rendering and sequence-length preparation.

All string work is built-in expressions. A chat is a conversation's messages in
turn order; a conversation is a natural, bounded unit (a handful of turns), so
collecting one into an array is per-row work, not an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.session import materialize
from inkwell.functions.text import col_, py_strip, ws_tokens


# ------------------------------------------------------------------ chats

def conversations_to_chats(conv: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) rows -> (conv_id, messages array<struct<role, content>>) in turn order."""
    msgs = conv.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                                             F.col(text_col).alias("content")))).alias("_m"))
    return msgs.select(id_col, F.transform("_m", lambda m: F.struct(m["role"].alias("role"),
                                                                    m["content"].alias("content"))).alias("messages"))


def prompt_and_reference(messages="messages") -> tuple[Column, Column]:
    """(prompt messages = every non-assistant message, reference = last assistant content or '')."""
    m = col_(messages)
    prompt = F.filter(m, lambda x: x["role"] != F.lit("assistant"))
    assistant = F.filter(m, lambda x: x["role"] == F.lit("assistant"))
    reference = F.coalesce(F.try_element_at(assistant, F.lit(-1))["content"], F.lit(""))
    return prompt, reference


def truncate_fields(df: DataFrame, prompt_messages: str = "prompt_messages", prediction: str = "prediction",
                    reference: str = "reference", task_type: str = "task_type",
                    prompt_chars: int = fixed.PROMPT_CHARS, text_chars: int = fixed.TEXT_CHARS) -> DataFrame:
    """Per-sample display fields: last prompt message [:200], texts [:500], task default 'unknown'."""
    last_prompt = F.coalesce(F.try_element_at(F.col(prompt_messages), F.lit(-1))["content"], F.lit(""))
    return df.select(
        "*",
        F.substring(last_prompt, 1, prompt_chars).alias("prompt_display"),
        F.substring(F.col(prediction), 1, text_chars).alias("prediction_display"),
        F.substring(F.col(reference), 1, text_chars).alias("reference_display"),
        F.coalesce(F.col(task_type), F.lit("unknown")).alias("task_display"))


def _header(role) -> Column:
    return F.concat(F.lit(fixed.CHAT_HEADER_START), role, F.lit(fixed.CHAT_HEADER_END + "\n\n"))


def render_chat(messages="messages", generation_cue: bool = False) -> Column:
    """Chat text: begin marker, then per message header + content + end-of-turn;
    with ``generation_cue`` an open assistant header at the end."""
    body = F.array_join(F.transform(col_(messages), lambda m: F.concat(_header(m["role"]), m["content"],
                                                                       F.lit(fixed.CHAT_EOT))), "")
    parts = [F.lit(fixed.CHAT_BEGIN), body]
    if generation_cue:
        parts.append(_header(F.lit("assistant")))
    return F.concat(*parts)


def render_system_user(system, user) -> Column:
    """The serving prompt: system and user turns plus the assistant cue."""
    return F.concat(F.lit(fixed.CHAT_BEGIN), _header(F.lit("system")), col_(system), F.lit(fixed.CHAT_EOT),
                    _header(F.lit("user")), col_(user), F.lit(fixed.CHAT_EOT), _header(F.lit("assistant")))


# ------------------------------------------------------------------ request prompts

def _tone_clause(tone) -> Column:
    t = col_(tone)
    return F.when(t != F.lit(fixed.TONE_DEFAULT), F.concat(F.lit(" Use a "), F.lower(t), F.lit(" tone.")))\
        .otherwise(F.lit(""))


def compose_request_prompt(subject="subject", tone="tone", context="context") -> tuple[Column, Column]:
    """(user prompt or null, error or null) of a compose request."""
    s, c = col_(subject), col_(context)
    ctx = F.when(py_strip(c) != F.lit(""), F.concat(F.lit("\n\n" + fixed.CONTEXT_PREFIX), c)).otherwise(F.lit(""))
    blank = py_strip(s) == F.lit("")
    prompt = F.concat(F.lit(fixed.COMPOSE_PREFIX), s, _tone_clause(tone), ctx)
    return (F.when(~blank, prompt), F.when(blank, F.lit(fixed.BLANK_SUBJECT_MESSAGE)))


def reply_request_prompt(original="original_email", tone="tone") -> tuple[Column, Column]:
    """(user prompt or null, error or null) of a reply request."""
    o = col_(original)
    blank = py_strip(o) == F.lit("")
    prompt = F.concat(F.lit(fixed.REPLY_PREFIX), _tone_clause(tone), F.lit("\n\n"), o)
    return (F.when(~blank, prompt), F.when(blank, F.lit(fixed.BLANK_EMAIL_MESSAGE)))


def request_prompts(requests: DataFrame) -> DataFrame:
    """Compose and reply prompts (rendered for serving) for every request row."""
    cp, ce = compose_request_prompt()
    rp, re_ = reply_request_prompt()
    return requests.select(
        "item_id",
        cp.alias("compose_prompt"), ce.alias("compose_error"),
        F.when(cp.isNotNull(), render_system_user(F.lit(fixed.SYSTEM_PROMPT_COMPOSE), cp)).alias("compose_chat"),
        rp.alias("reply_prompt"), re_.alias("reply_error"),
        F.when(rp.isNotNull(), render_system_user(F.lit(fixed.SYSTEM_PROMPT_REPLY), rp)).alias("reply_chat"))


# ------------------------------------------------------------------ sequence length and packing

def seq_length_cut(df: DataFrame, text_col: str = "text", max_len: int = fixed.MAX_SEQ_LENGTH,
                   tokens=None) -> DataFrame:
    """Token count per sample, over-length flag and the kept token count.
    Tokens default to whitespace tokens; pass a token-array column to override."""
    t = tokens if tokens is not None else ws_tokens(text_col)
    n = F.size(t).cast("long")
    return df.withColumn("n_tokens", n).withColumn("over_length", n > max_len).withColumn(
        "kept_tokens", F.least(n, F.lit(max_len).cast("long")))


def pack_sequences(df: DataFrame, order_col: str, len_col: str = "n_tokens",
                   window: int = fixed.MAX_SEQ_LENGTH) -> DataFrame:
    """Pack samples, in ``order_col`` order, into fixed windows of ``window`` tokens.

    Running token offsets come from a distributed prefix sum: the (key, length) rows are
    range-partitioned by key from sampled splitters, so that clustered keys spread too, and stored
    once with their partition number; partition totals (one row each) get a
    running sum over that small table, and exact running sums run inside each
    partition only. A sample straddling window boundaries yields one row per window
    it touches: ``(chunk, order key, token_from, token_to)`` (0-based, half-open).
    ``order_col`` must be a unique integer key.
    """
    ranged = df.select(F.col(order_col).cast("long").alias("_k"), F.col(len_col).cast("long").alias("_len"))
    keyed = materialize(ranged.repartitionByRange("_k").withColumn("_bucket", F.spark_partition_id()), "ranges")
    totals = keyed.groupBy("_bucket").agg(F.sum("_len").alias("_t"))
    before = (totals.withColumn("_off", F.coalesce(F.sum("_t").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
        .select("_bucket", "_off"))
    # one row per non-empty bucket; Spark broadcasts it only if its measured size allows.
    in_bucket = Window.partitionBy("_bucket").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    starts = (keyed.join(before, "_bucket")
              .withColumn("_start", F.col("_off") + F.coalesce(F.sum("_len").over(in_bucket), F.lit(0).cast("long"))))
    nonempty = starts.where(F.col("_len") > 0)
    first = F.floor(F.col("_start") / window).cast("long")
    last = F.floor((F.col("_start") + F.col("_len") - 1) / window).cast("long")
    pieces = nonempty.select("_k", "_start", "_len", F.explode(F.sequence(first, last)).alias("chunk"))
    lo = F.greatest(F.col("_start"), F.col("chunk") * window) - F.col("_start")
    hi = F.least(F.col("_start") + F.col("_len"), (F.col("chunk") + 1) * window) - F.col("_start")
    return pieces.select("chunk", F.col("_k").alias(order_col), lo.alias("token_from"), hi.alias("token_to"))

