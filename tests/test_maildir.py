"""Mail-tree scan on a generated mini tree: hidden folder names, nested folders,
skipped folders, CRLF, bad UTF-8, size prefilter, hidden files."""

import os

import pytest
from pyspark.sql import functions as F

from inkwell.operators import corpus as C
from inkwell.operators import messages as M
from inkwell.sources.maildir import read_maildir

BODY = "This is a perfectly ordinary message body that is long enough to keep."


def _write(root, rel, data: bytes):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as fh:
        fh.write(data)


def make_tree(root, hidden_file=False):
    _write(root, "alice/_sent_mail/1.", f"Subject: Re: plan\nFrom: alice\n\n{BODY} one".encode())
    _write(root, "alice/sent/2.", f"Subject: Re: plan\r\nFrom: alice\r\n\r\n{BODY} crlf".encode())
    _write(root, "alice/Sent Items/deep/er/3.", f"Subject: hello\nFrom: a\n\n{BODY} nested".encode())
    _write(root, "bob/inbox/1.", f"Subject: plan\nFrom: carol\n\n{BODY} original".encode())
    _write(root, "bob/notes_inbox/2.", b"Subject: bad bytes\nFrom: d\n\n" + BODY.encode() + b" \xff\xfe bytes")
    _write(root, "bob/all_documents/3.", f"Subject: skip\n\n{BODY}".encode())
    _write(root, "bob/inbox/4.", f"Subject: big\n\n{'x' * 7100}".encode())
    _write(root, "carol/inbox/1.", f"Subject: plan\nFrom: carol\n\n{BODY} original".encode())  # duplicate body
    if hidden_file:
        _write(root, "carol/inbox/_9.", f"Subject: hidden\n\n{BODY} hidden".encode())


def test_scan_reads_selected_folders(spark, tmp_path):
    root = str(tmp_path / "maildir")
    make_tree(root)
    raw = read_maildir(spark, root)
    rows = {(r["user"], r["folder"]) for r in raw.select("user", "folder").collect()}
    assert rows == {("alice", "_sent_mail"), ("alice", "sent"), ("alice", "Sent Items"), ("bob", "inbox"),
                    ("bob", "notes_inbox"), ("carol", "inbox")}
    assert raw.where("length > 7000").count() == 0
    msgs = C.dedup_first(M.prepare_messages(raw, size_col="length")).collect()
    bodies = sorted(m["body"] for m in msgs)
    assert f"{BODY} crlf" in bodies
    assert f"{BODY}  bytes" not in bodies and f"{BODY} bytes".replace(" bytes", "  bytes") not in bodies
    assert any(b.startswith(BODY) and b.endswith("bytes") for b in bodies)
    # the duplicate original keeps the first (user, path): bob before carol
    orig = [m for m in msgs if m["body"] == f"{BODY} original"]
    assert len(orig) == 1 and orig[0]["user"] == "bob"
    samples = C.flatten_samples(C.reply_pairs(C.dedup_first(M.prepare_messages(raw, size_col="length")))).collect()
    assert len(samples) == 2  # both sent "Re: plan" replies thread to bob's original
    assert all("From: carol\nSubject: plan\n\n" in s["user_content"] for s in samples)


def test_hidden_files_are_read(spark, tmp_path):
    root = str(tmp_path / "maildir")
    make_tree(root, hidden_file=True)
    rows = read_maildir(spark, root).collect()
    assert len(rows) == 7  # oversize file filtered in the scan
    hidden = [r for r in rows if r["path"].endswith("carol/inbox/_9.")]
    assert len(hidden) == 1 and hidden[0]["user"] == "carol" and hidden[0]["content"].endswith("hidden")
    assert hidden[0]["path"].startswith("file:/") and hidden[0]["length"] == len(hidden[0]["content"])
    assert read_maildir(spark, root, hidden=False).count() == 6


def test_missing_root(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_maildir(spark, str(tmp_path / "nope"))


def test_replies_to_a_hot_subject(spark):
    rows = []
    for i in range(30):
        rows.append(("u", f"p/s{i:03d}", "sent", "Re: budget" if i % 3 else f"Re: t{i}", f"reply body number {i}"))
    rows += [("u", "p/i1", "inbox", "budget", "original budget"), ("u", "p/i2", "inbox", "t3", "orig t3"),
             ("v", "p/i0", "inbox", "Budget", "another original")]
    msgs = spark.createDataFrame(rows, "user string, path string, box string, subject string, body string") \
        .withColumn("from_addr", F.lit("x"))
    plain = {tuple(r) for r in C.flatten_samples(C.reply_pairs(msgs)).collect()}
    assert len(plain) == 21  # 20 hot "Re: budget" replies + "Re: t3"
    budget = [r for r in plain if "Subject: budget" in r[3]]
    assert len(budget) == 20 and all(r[3].endswith("original budget") for r in budget)


def test_size_bound_reaches_the_listing(spark, tmp_path):
    from inkwell.sources.mailtree import list_tree
    root = str(tmp_path / "maildir")
    make_tree(root, hidden_file=True)
    df = list_tree(spark, "file://" + root, 1000)
    assert {r.length <= 1000 for r in df.collect()} == {True} and df.count() == 7
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan mailtree" in plan and "Filter " not in plan
    assert list_tree(spark, "file://" + root, 10).count() == 0


def test_odd_trees(spark, tmp_path):
    """Empty tree, files beside users and folders, names with spaces, marks and non-ASCII letters, many users."""
    root = str(tmp_path / "mail dir é#%")
    os.makedirs(root)
    assert read_maildir(spark, root).count() == 0
    _write(root, "stray", b"x")
    _write(root, "zoë q/stray", b"x")
    _write(root, "zoë q/Sent Items/a b/ü#1%20.", b"Subject: s\n\nb")
    for k in range(20):
        _write(root, f"u{k:02d}/inbox/{k}.", b"Subject: s\n\nb")
    os.makedirs(os.path.join(root, "empty", "inbox"))
    got = read_maildir(spark, root).collect()
    assert len(got) == 21 and {r.user for r in got} == {"zoë q", *(f"u{k:02d}" for k in range(20))}
    assert [r.path for r in got if r.folder == "Sent Items"] == [f"file:{root}/zoë q/Sent Items/a b/ü#1%20."]


def tree_files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if not f.endswith(".crc"))


def test_writer_commits_whole_jobs(spark, tmp_path):
    """Attempts that fail half-way leave nothing behind: neither in a job whose retry succeeds nor in one that fails."""
    import glob

    import pyarrow as pa

    from inkwell.sources.jsonl import write_mail_tree
    from inkwell.sources.mailtree import MailTreeWriter
    root = str(tmp_path / "tree")
    raw = spark.range(40).selectExpr("id AS doc_id", "concat('u', id % 3) AS user", "'inbox' AS folder", "concat('text ', id) AS content")
    write_mail_tree(raw.repartition(4), root)
    want = sorted(f"u{i % 3}/inbox/{i}." for i in range(40))
    assert tree_files(root) == want and not glob.glob(root + "/.staging*")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark makes of the task's error
        write_mail_tree(raw.selectExpr("doc_id + 100 AS doc_id", "user", "folder", "content", "doc_id AS k").where(
            "IF(k = 33, raise_error('task fails'), true)").repartition(1), root)
    assert tree_files(root) == want and not glob.glob(root + "/.staging*")

    writer = MailTreeWriter("file://" + root)
    batch = pa.RecordBatch.from_pydict({"user": ["v", "v"], "folder": ["sent", "sent"], "name": ["1", "2"], "content": ["one", None]})

    def half():
        yield batch
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(half())
    speculative, counted = writer.write(iter([batch])), writer.write(iter([batch]))
    assert speculative.folder != counted.folder and tree_files(root + "/v") == []
    writer.commit([counted, None])
    assert tree_files(root) == sorted([*want, "v/sent/1.", "v/sent/2."]) and not glob.glob(root + "/.staging*")
