"""One pass over the files gives messages, rejects with reasons and counts."""

from small_tables import SF_SMALL

from inkwell.operators import corpus as C
from inkwell.operators import messages as M
from inkwell.sources import tables as T

BODY = "A body that is long enough to be kept, with words and more words. "


def mail(subject="Plan", body=BODY):
    return f"Subject: {subject}\n\n{body}"


def test_same_messages_and_counts_as_the_separate_steps(spark):
    raw = T.raw_messages(spark, SF_SMALL).repartition(7)
    built = C.build_corpus(raw)
    alone = C.dedup_first(M.prepare_messages(raw)).select(*built.messages.columns)
    assert sorted(map(str, built.messages.collect())) == sorted(map(str, alone.collect()))
    counts = {r.stage: r.n for r in C.stage_counts(raw).collect()}
    assert {k: n for k, n in built.counts.items() if n or k in counts} == counts
    reasons = {}
    for r in built.rejects.collect():
        reasons[r.reason] = reasons.get(r.reason, 0) + 1
    assert reasons == {k: n for k, n in built.counts.items() if n and k not in ("files", "sent", "inbox")}
    assert built.messages.count() + built.rejects.count() == built.counts["files"]


def test_odd_files(spark):
    rows = [("a", "a/1", "sent", mail()), ("a", "a/1", "sent", mail()), ("b", "b/1", "inbox", mail()),
            ("a", "a/2", "sent", None), ("a", "a/3", "sent", ""), ("a", "a/4", None, mail()), ("a", "a/5", "calendar", mail()),
            ("a", "a/6", "sent", mail(body="x" * 50_000)), ("a", "a/7", "sent", mail(body="short")),
            ("a", "a/8", "sent", mail(" ")), ("a", "a/9", "sent", "no blank line"), (None, None, "inbox", mail(body=BODY * 2))]
    raw = spark.createDataFrame(rows, "user string, path string, folder string, content string")
    built = C.build_corpus(raw)
    assert sorted(((r.user, r.path) for r in built.messages.collect()), key=str) == [("a", "a/1"), (None, None)]
    assert sorted((r.path, r.reason) for r in built.rejects.collect()) == [
        ("a/1", "duplicates"), ("a/2", "no_blank_line"), ("a/3", "no_blank_line"), ("a/4", "skipped_folder"),
        ("a/5", "skipped_folder"), ("a/6", "oversize"), ("a/7", "body_length"), ("a/8", "blank_subject"),
        ("a/9", "no_blank_line"), ("b/1", "duplicates")]
    assert built.counts["files"] == 12 and built.counts["sent"] == 1 and built.counts["inbox"] == 1
    none = C.build_corpus(raw.limit(0))
    assert none.messages.count() == 0 and none.rejects.count() == 0 and not any(none.counts.values())
