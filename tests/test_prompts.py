"""Prompt builders, chat rendering and packing against direct Python models."""

import random

from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.operators import prompts as PR


def test_request_prompts(spark):
    rows = [(1, "Professional", "Budget", "", "orig"), (2, "Casual", "  ", "ctx", ""),
            (3, "Friendly", "Plan", "  more  ", "Hello there")]
    df = spark.createDataFrame(rows, "item_id int, tone string, subject string, context string, original_email string")
    got = {r["item_id"]: r for r in PR.request_prompts(df).collect()}
    assert got[1]["compose_prompt"] == fixed.COMPOSE_PREFIX + "Budget"
    assert got[2]["compose_prompt"] is None and got[2]["compose_error"] == fixed.BLANK_SUBJECT_MESSAGE
    assert got[3]["compose_prompt"] == fixed.COMPOSE_PREFIX + "Plan Use a friendly tone.\n\nAdditional context:   more  "
    assert got[1]["reply_prompt"] == "Reply to this email:\n\norig"
    assert got[2]["reply_error"] == fixed.BLANK_EMAIL_MESSAGE
    assert got[3]["reply_prompt"] == "Reply to this email: Use a friendly tone.\n\nHello there"
    assert got[1]["compose_chat"].endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")


def test_prompt_reference_and_render(spark):
    conv = spark.createDataFrame([(1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A1"),
                                  (1, 3, "assistant", "A2"), (2, 0, "user", "only")],
                                 "conv_id long, turn long, role string, text string")
    chats = PR.conversations_to_chats(conv)
    prompt, ref = PR.prompt_and_reference("messages")
    got = {r["conv_id"]: r for r in chats.select("conv_id", prompt.alias("p"), ref.alias("r"),
                                                 PR.render_chat("messages").alias("t")).collect()}
    assert [m["content"] for m in got[1]["p"]] == ["S", "U"] and got[1]["r"] == "A2"
    assert got[2]["r"] == ""
    assert got[2]["t"] == "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nonly<|eot_id|>"


def test_packing_matches_running_sum(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([0, 1, 5, 40, 130, 600])) for k in rng.sample(range(100000), 300)]
    df = spark.createDataFrame(rows, "k long, n_tokens long")
    got = sorted((r["chunk"], r["k"], r["token_from"], r["token_to"])
                 for r in PR.pack_sequences(df, "k", window=128).collect())
    want, start = [], 0
    for k, n in sorted(rows):
        for c in range(start // 128, (start + n - 1) // 128 + 1) if n > 0 else []:
            want.append((c, k, max(start, c * 128) - start, min(start + n, (c + 1) * 128) - start))
        start += n
    assert got == sorted(want)


def test_seq_length_cut(spark):
    df = spark.createDataFrame([("a b c",), ("",)], "text string")
    got = [(r["n_tokens"], r["over_length"], r["kept_tokens"]) for r in
           PR.seq_length_cut(df, max_len=2).select("n_tokens", "over_length", "kept_tokens").collect()]
    assert got == [(3, True, 2), (0, False, 0)]
    assert F is not None


def test_packing_sparse_keys_default_width(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice([0, 3, 50, 700])) for k in rng.sample(range(10 ** 12), 200)]
    df = spark.createDataFrame(rows, "k long, n_tokens long")
    got = sorted((r["chunk"], r["k"], r["token_from"], r["token_to"]) for r in PR.pack_sequences(df, "k", window=512).collect())
    want, start = [], 0
    for k, n in sorted(rows):
        for c in range(start // 512, (start + n - 1) // 512 + 1) if n > 0 else []:
            want.append((c, k, max(start, c * 512) - start, min(start + n, (c + 1) * 512) - start))
        start += n
    assert got == sorted(want)
