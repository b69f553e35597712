"""Header parsing and body cleaning: hand goldens and an independent line-loop model."""

import random
import re
import time

from pyspark.sql import functions as F

from inkwell.operators import messages as M
from inkwell.sources.maildir import decode_text


def model_headers(block: str) -> dict:
    out, key = {}, None
    for line in block.splitlines():
        if not line.strip():
            continue
        if line[0] in " \t" and key:
            out[key] += " " + line.strip()
            continue
        if ":" in line:
            k, v = line.split(":", 1)
            key = k.strip()
            out[key] = v.strip()
    return out


HEADER_CASES = [
    "Subject: a\nFrom: x\n",
    "Subject: first\nSubject: second\n",
    "To: a,\n\t b\n  c  \nSubject: s",
    "To: a\nno colon here\n  continues To\nSubject: s",
    "  leading: continuation\nSubject: s",
    ":empty key\n  not a continuation: z\nSubject: s",
    "Subject:   spaced   \n\n\nCc: c",
    "subject: lower\nSubject: Upper",
    "Subject: a\x0bFrom: split by vt Cc: ls",
    "Subject:\n continued only",
]


def test_header_fold_matches_model(spark):
    df = spark.createDataFrame([(i, h + "\n\nbody") for i, h in enumerate(HEADER_CASES)], "i int, content string")
    rows = M.parse_messages(df).collect()
    assert len(rows) == len(HEADER_CASES)
    for r in rows:
        head, body = (HEADER_CASES[r["i"]] + "\n\nbody").split("\n\n", 1)
        h = model_headers(head)
        for col, name in M.HEADER_FIELDS:
            assert r[col] == h.get(name, ""), (HEADER_CASES[r["i"]], col)
        assert r["body"] == body.strip()


def test_no_blank_line_dropped(spark):
    df = spark.createDataFrame([(1, "Subject: x\nbody without separator")], "i int, content string")
    assert M.parse_messages(df).count() == 0


def clean(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(M.clean_body("t")).collect()]


def test_clean_cuts_and_filters(spark):
    got = clean(spark, [
        "Keep this\n-----Original Message-----\nold",
        "Keep\n---------- Forwarded by A on 1/1 ----------\nold",
        "The person said hello\nand they wrote: things",  # 'on ' inside 'person' starts the cut
        "> quoted\nline two\n   > also quoted\nthree",
        "Body\nThis message is confidential.\ntail",
        "Body\nENRON DISCLAIMER stuff",
        "Body\n*** see ECONNECTION tail",
        "a\n\n\n\nb    c  ",
        "　 padded  ",
    ])
    assert got == ["Keep this", "Keep", "The pers", "line two\nthree", "Body", "Body", "Body", "a\n\nb c", "padded"]


def test_subject_rules(spark):
    df = spark.createDataFrame([("Re: Re: x",), ("  RE : Topic ",), ("Fwd: y",), ("Fw:",), ("Regarding",)], "s string")
    rows = df.select(M.strip_subject_prefix("s").alias("c"), M.normalise_subject("s").alias("n"),
                     M.is_reply_subject("s").alias("r")).collect()
    assert [r["c"] for r in rows] == ["Re: x", "Topic", "y", "", "Regarding"]
    assert [r["n"] for r in rows] == ["re: x", "topic", "y", "", "regarding"]
    assert [r["r"] for r in rows] == [True, True, False, False, False]


def test_folder_rule(spark):
    names = ["sent", "_sent_mail", "Sent Items", "sent_mail", "inbox", "notes_inbox", "all_documents", " sent", "Inbox_"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r[0] for r in df.select(M.folder_box("f")).collect()]
    assert got == ["sent", "sent", "sent", "sent", "inbox", "inbox", None, None, "inbox"]


def test_decode_drops_bad_bytes_and_translates_newlines(spark):
    raw = b"Subject: x\r\n\r\nline1\rline2\xff\xfe end"
    df = spark.createDataFrame([(bytearray(raw),)], "c binary")
    got = df.select(decode_text(F.col("c"))).first()[0]
    assert got == raw.decode("utf-8", errors="ignore").replace("\r\n", "\n").replace("\r", "\n")


def test_quality_filter(spark):
    df = spark.createDataFrame([
        ("x" * 50, "ok"), ("x" * 49, "ok"), ("x" * 2001, "ok"), ("x" * 60, "  "),
        ("x" * 60, "Out of Office: gone"), ("x" * 60, "UNDELIVERABLE")], "body string, subject string")
    got = [r[0] for r in df.select(M.is_valid_email("body", "subject")).collect()]
    assert got == [True, False, False, False, False, False]
    assert re.search("x", "x")


def test_clean_guard_dotted_capital_i(spark):
    # Java's Unicode case-insensitive match equates U+0130 with "i"; the guard must not skip it.
    got = clean(spark, ["Keep\n-----Orİginal Message-----\nold"])
    assert got == ["Keep"]


def model_cuts(text):
    """The cutting steps by the patterns as the rules state them (backtracking searches)."""
    for p in (r"-{3,}\s*Original Message\s*-{3,}", r"-{3,}\s*Forwarded by\s.*?-{3,}", r"On .+? wrote:"):
        m = re.search(p, text, re.I | re.S)
        text = text[:m.start()] if m else text
    text = "\n".join(x for x in text.split("\n") if not x.strip().startswith(">"))
    for p in (r"(?:This message|This e-?mail|This communication).*?(?:confidential|privileged).*", r"ENRON DISCLAIMER.*",
              r"\*{3,}.*?ECONNECTION.*"):
        text = re.sub(p, "", text, flags=re.I | re.S)
    return re.sub(" +", " ", re.sub("\n{3,}", "\n\n", text)).strip()


def test_cuts_equal_the_searches_on_random_texts(spark):
    rng = random.Random(17)
    parts = ["on ", "On ", " wrote:", "wrote:", "x", "\n", "---", "-", "----", "Original Message", "original  message", " ", "　",
             "Forwarded by ", "forwarded by\n", "> q", ">", "This message ", "this e-mail", "privileged", "Confidential", "***", "*",
             "ECONNECTION", "enron disclaimer", "\U0001f600", "ſ", "İ", "è", "On  wrote:", "on x wrote:", "tıs"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    assert clean(spark, texts) == [model_cuts(t) for t in texts]


def test_long_bodies_clean_in_linear_time(spark):
    """Openings without end, and one end behind all of them: a search that starts again at each opening takes hours."""
    n = 2_000_000
    hard = ["on " * (n // 3), "on " * (n // 3) + "x wrote:", "this message " * (n // 13) + "confidentia", "*** " * (n // 4) + "econnectio",
            "-" * n, "--- " * (n // 4) + "original message", "x wrote:" + "on " * (n // 3), "---" + " " * n + "forwarded by", ">" * 9 + " " * n]
    began = time.time()
    got = clean(spark, hard)
    assert time.time() - began < 60
    assert [len(x) for x in got[:3]] == [n // 3 * 3 - 1, 0, n // 13 * 13 + 11]


def test_decode_drops_exactly_the_bytes_that_python_ignores(spark):
    rng = random.Random(23)
    pool = [b"a", b"\xc3\xa9", b"\xef\xbf\xbd", b"\xe2\x82", b"\xf0\x9f\x98\x80", b"\xf0\x90\x80", b"\xed\xa0\x80", b"\xc0\x80", b"\xff", b"\x80",
            b"\xe2\x82\xac", b"\xf4\x90\x80\x80", b"\xe0\x80\x80", b"\n", b"$1", b"\\"]
    rows = [b"".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    rows += [bytes(rng.randrange(256) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    df = spark.createDataFrame([(bytearray(b),) for b in rows], "b binary")
    got = [r[0] for r in df.select(decode_text(F.col("b"))).collect()]
    assert got == [b.decode("utf-8", errors="ignore").replace("\r\n", "\n").replace("\r", "\n") for b in rows]


def test_a_subject_of_half_of_all_replies_is_split(spark):
    """The join's two sides are exchanges of their own, in which the hot subject is split at run time."""
    from inkwell.operators import corpus as C
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = 6000
        msgs = spark.range(n).selectExpr(
            "'u' AS user", "concat('p', id) AS path", "if(id % 10 = 0, 'inbox', 'sent') AS box", "'f' AS from_addr",
            "concat('Re: ', if(id = 0 OR id % 10 <> 0 AND id % 2 = 0, 'hot', concat('s', (id DIV 10 * 10) % 300))) AS subject",
            "concat('body ', id, repeat(sha2(cast(id AS string), 256), 8)) AS body").repartition(8)
        df = C.reply_pairs(msgs)
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skew=true" in plan and plan.count("Exchange hashpartitioning") == 2 and "Aggregate" not in plan
        rows = msgs.collect()
        inbox = {M_subject(r.subject) for r in rows if r.box == "inbox"}
        assert len(got) == sum(r.box == "sent" and M_subject(r.subject) in inbox for r in rows)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def M_subject(s):
    return s.removeprefix("Re: ").lower()
