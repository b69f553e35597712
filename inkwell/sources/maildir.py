"""Mail-tree source: ``<root>/<user>/<folder>/**/<file>`` -> raw message table.

* The tree is listed and read by tasks (``mailtree``); the driver sees the users' names alone. The folder rule
  picks sent/inbox folders at the listing, so skipped folders are never opened, and hidden names
  (``_sent_mail``) are files like others.
* The size prefilter on ``length`` is pushed into the listing, so oversized files are never read.
* Bytes are decoded as UTF-8 with exactly the undecodable bytes dropped, and ``\\r\\n`` / ``\\r`` become ``\\n``.
* Spark's own file source (``hidden=False``) is kept for stores that only Spark can open.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.sources.mailtree import is_mail_folder, list_tree, read_contents


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_folders(spark: SparkSession, root: str) -> list[tuple[str, str, str]]:
    """(user, folder, folder path) for every immediate folder of every user, users sorted."""
    fs, rootp = _fs(spark, root)
    if not fs.exists(rootp):
        raise FileNotFoundError(f"maildir not found: {root}")
    out = []
    users = sorted((s for s in fs.listStatus(rootp) if s.isDirectory()), key=lambda s: s.getPath().getName())
    for u in users:
        for f in fs.listStatus(u.getPath()):
            if f.isDirectory():
                out.append((u.getPath().getName(), f.getPath().getName(), f.getPath().toString()))
    return out


def uri(path: str) -> str:
    """A Hadoop path as a URI of other file system libraries: three slashes, escaped characters."""
    scheme, colon, rest = path.partition(":/")
    if not colon:
        return path
    return f"{scheme}:///{quote(rest.lstrip('/'))}" if scheme == "file" else f"{scheme}:/{quote(rest)}"


# one or more well-formed UTF-8 sequences, as characters of the bytes' Latin-1 view
WELL_FORMED = (r"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
               r"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}"
               r"|\xf4[\x80-\x8f][\x80-\xbf]{2})")


def decode_text(content) -> F.Column:
    """UTF-8 decode, exactly the undecodable bytes dropped (``errors="ignore"``), universal newlines.

    Bytes outside well-formed sequences go from the Latin-1 view of the bytes, so a genuine U+FFFD stays. Only files
    that are not valid UTF-8 take that way.
    """
    latin = F.decode(content, "ISO-8859-1")
    kept = F.encode(F.regexp_replace(latin, f"({WELL_FORMED})|[\\x80-\\xff]", "$1"), "ISO-8859-1")
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(kept.cast("string"))
    return F.regexp_replace(text, "\r\n?", "\n")


def read_maildir(spark: SparkSession, root: str, max_body_length: int = fixed.MAX_BODY_LENGTH,
                 hidden: bool = True) -> DataFrame:
    """Raw messages of sent and inbox folders: (path, user, folder, length, content).

    ``length`` (bytes) is kept for the size prefilter; apply
    ``prepare_messages(raw, size_col="length")`` next. Files over
    ``max_body_length + 5000`` bytes are left out by the listing. ``hidden=False`` reads through Spark's own file
    source, for file systems that only Spark can open; it leaves out files whose name, or a folder above it, starts
    with _ or . and lists the folders on the driver.
    """
    most = max_body_length + fixed.FILE_SIZE_SLACK
    fs, rootp = _fs(spark, root)
    if not fs.exists(rootp):
        raise FileNotFoundError(f"maildir not found: {root}")
    if hidden:
        tree = uri(fs.makeQualified(rootp).toString())
        seen = read_contents(list_tree(spark, tree, most), tree)
    else:
        seen = _read_plain(spark, root, most)
    return seen.select("path", "user", "folder", "length", decode_text(F.col("bytes")).alias("content"))


def _read_plain(spark: SparkSession, root: str, most: int) -> DataFrame:
    """Files of the selected folders by the ``binaryFile`` source."""
    chosen = [(u, f, p) for u, f, p in list_folders(spark, root) if is_mail_folder(f)]
    if not chosen:
        return spark.createDataFrame([], "path string, user string, folder string, length bigint, bytes binary")
    paths = [p for _, _, p in chosen]
    user_of = spark.createDataFrame([(p.rstrip("/"), u, f) for u, f, p in chosen],
                                    "folder_path string, user string, folder string")
    scan = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
            .where(F.col("length") <= most))
    # Each file belongs to the selected folder whose path prefixes it: derive the
    # folder path from the file path (user dir + immediate folder) and join the
    # small folder table (one row per selected folder, broadcast).
    fs, rootp = _fs(spark, root)
    root_q = fs.makeQualified(rootp).toString().rstrip("/")
    rel = F.substring(F.col("path"), len(root_q) + 2, 1 << 30)
    folder_path = F.concat(F.lit(root_q + "/"), F.substring_index(rel, "/", 2))
    return (scan.select("path", "length", folder_path.alias("folder_path"), F.col("content").alias("bytes"))
            .join(F.broadcast(user_of), "folder_path")
            .select("path", "user", "folder", "length", "bytes"))
