"""Rule-hit goldens of the derived raw_messages view at sf0.01 (FIXTURES.md)."""

import __spark_entry__ as E


def test_stage_counts_sf001(spark):
    got = {r["stage"]: r["n"] for r in E.queries()["stage_counts"](spark, "/root/testdata/sf0.01").collect()}
    assert got == {"files": 1000, "skipped_folder": 166, "oversize": 52, "no_blank_line": 5, "body_length": 269,
                   "blank_subject": 9, "auto_subject": 9, "duplicates": 23, "sent": 279, "inbox": 188}


def test_reply_pairs_sf001(spark):
    assert E.queries()["reply_pairs"](spark, "/root/testdata/sf0.01").count() == 106


def test_stage_counts_independent_of_partitioning(spark):
    from inkwell.operators import corpus as C
    from inkwell.sources import tables as T
    raw = T.raw_messages(spark, "/root/testdata/sf0.001")
    a = {r["stage"]: r["n"] for r in C.stage_counts(raw.repartition(1)).collect()}
    b = {r["stage"]: r["n"] for r in C.stage_counts(raw.repartition(9)).collect()}
    assert a == b
