"""Message parsing, cleaning and quality filtering as column expressions.

Input is a table of raw mail files ``(path, user, folder, content)``; every
step is a built-in expression, so a whole parse/clean/filter chain runs inside
one whole-stage-codegen scan stage with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import fixed
from inkwell.functions.text import PY_WS, SPLITLINES, col_, let, lines, py_strip

# fixed values: header keys projected by the parser (output column, header name)
HEADER_FIELDS = (
    ("message_id", "Message-ID"),
    ("date", "Date"),
    ("from_addr", "From"),
    ("to_addr", "To"),
    ("cc", "Cc"),
    ("subject", "Subject"),
    ("x_folder", "X-Folder"),
)

# fixed values: cleaning and subject patterns (Java regex). A "cut at first match" is a replace of the match
# and everything after it; DOTALL + \z makes that one match at most. Possessive runs that start where a run starts
# are read once. A pair is an opening and what must follow it somewhere (``cut_at_pair``).
CUT_ORIGINAL = r"(?isu)(?<!-)-{3,}+" + PY_WS + r"*+Original Message" + PY_WS + r"*+-{3,}.*\z"
CUT_FORWARDED = r"(?isu)(?<!-)-{3,}+" + PY_WS + r"*+Forwarded by" + PY_WS + r".*?-{3,}.*\z"
CUT_WROTE = ("On ", r".+? wrote:")
QUOTED_LINE = r"^" + PY_WS + r"*+>"
DISCLAIMERS = (
    ("(?:This message|This e-?mail|This communication)", ".*?(?:confidential|privileged)"),
    ("ENRON DISCLAIMER", ""),
    (r"\*{3}", ".*?ECONNECTION"),
)
SUBJECT_PREFIX = r"(?iu)^(?:Re|Fw|Fwd)" + PY_WS + r"*:" + PY_WS + r"*"
REPLY_SUBJECT = r"(?iu)^Re" + PY_WS + r"*:"


# ---------------------------------------------------------------- folders (S2)

def normalise_folder(folder) -> Column:
    """lower, strip '_' at both ends, spaces to '_'."""
    return F.replace(F.btrim(F.lower(col_(folder)), F.lit("_")), F.lit(" "), F.lit("_"))


def folder_box(folder) -> Column:
    """'sent', 'inbox' or null (folder skipped)."""
    n = normalise_folder(folder)
    return (F.when(n.isin(*fixed.SENT_FOLDER_NAMES), F.lit("sent"))
            .when(n.isin(*fixed.INBOX_FOLDER_NAMES), F.lit("inbox")))


def select_folders(raw: DataFrame, folder_col: str = "folder") -> DataFrame:
    """Keep files of sent and inbox folders, tagged with ``box``."""
    return raw.withColumn("box", folder_box(folder_col)).where(F.col("box").isNotNull())


# ----------------------------------------------------------- headers (P1-P4)

def _header_fold(header: Column) -> Column:
    """Fold header lines into a struct of the projected fields.

    Exact line-loop semantics: blank lines skipped; a line starting with space or
    tab continues the last valid key (joined by one space, stripped); other lines
    need a ':' and set key -> value (both stripped, last duplicate wins); lines
    without ':' are ignored and do not reset the current key.
    """
    def describe(line):
        colon = F.instr(line, ":")
        return F.struct(
            py_strip(line).alias("s"),
            F.substring(line, 1, 1).isin(" ", "\t").alias("ws"),
            (colon > 0).alias("has_colon"),
            py_strip(F.substring_index(line, ":", 1)).alias("key"),
            py_strip(line.substr(colon + 1, F.length(line))).alias("val"),
        )

    parts = F.transform(F.split(header, SPLITLINES, -1), describe)
    null = F.lit(None).cast("string")
    init = F.struct(null.alias("k"), *[null.alias(f) for f, _ in HEADER_FIELDS])

    def step(acc, ln):
        blank = ln["s"] == F.lit("")
        cont = ln["ws"] & F.coalesce(acc["k"] != F.lit(""), F.lit(False))
        keyed = ln["has_colon"] & ~blank & ~cont
        new_k = F.when(keyed, ln["key"]).otherwise(acc["k"])
        fields = []
        for f, name in HEADER_FIELDS:
            fields.append(
                F.when(blank, acc[f])
                .when(cont & (acc["k"] == F.lit(name)), F.concat(acc[f], F.lit(" "), ln["s"]))
                .when(keyed & (ln["key"] == F.lit(name)), ln["val"])
                .otherwise(acc[f]).alias(f))
        return F.struct(new_k.alias("k"), *fields)

    return F.aggregate(parts, init, step)


def parse_messages(raw: DataFrame, content_col: str = "content") -> DataFrame:
    """Split header/body at the first blank line and project the message fields.

    Files without a blank line are dropped. Missing headers become ''.
    Output keeps all input columns except the content.
    """
    return message_columns(raw.where(F.instr(F.col(content_col), "\n\n") > 0), content_col)


def message_columns(raw: DataFrame, content_col: str = "content") -> DataFrame:
    """The projection of ``parse_messages`` alone; a null content gives empty headers and a null body."""
    c = F.col(content_col)
    pos = F.instr(c, "\n\n")
    keep = [x for x in raw.columns if x != content_col]
    with_parts = raw.select(
        *keep,
        _header_fold(c.substr(F.lit(1), pos - 1)).alias("_h"),
        py_strip(c.substr(pos + 2, F.length(c))).alias("body"),
    )
    return with_parts.select(
        *keep,
        *[F.coalesce(F.col("_h")[f], F.lit("")).alias(f) for f, _ in HEADER_FIELDS if f != "x_folder"],
        "body",
        F.coalesce(F.col("_h")["x_folder"], F.lit("")).alias("x_folder"),
    )


# ---------------------------------------------------------- cleaning (F1-F7)

def drop_quoted_lines(text) -> Column:
    """Remove lines whose stripped text starts with '>'."""
    return F.array_join(F.filter(lines(text), lambda ln: ~ln.rlike(QUOTED_LINE)), "\n")


def cut_at_pair(opening: str, rest: str):
    """Cut a text where ``opening`` and ``rest`` match one after the other, from there to its end (a column function).

    ``rest`` reaches any distance, so if it fails behind the first opening it fails behind every later one: the
    first is tried alone, which takes linear time where a search for both would start again at each opening.
    """
    def cut(t):
        tail = F.regexp_extract(t, f"(?isu){opening}.*\\z", 0)
        return let(tail, lambda x: F.when((x != F.lit("")) & x.rlike(f"(?isu)\\A{opening}{rest}"),
                                          F.left(t, F.length(t) - F.length(x))).otherwise(t))

    return cut


def clean_body(text) -> Column:
    """Cut reply/forward chains, drop quoted lines and disclaimers, collapse whitespace.

    Each pattern runs only where its literal words occur in the case-folded
    original body. Cuts keep prefixes and the quoted-line step deletes whole lines,
    so a word absent from the original cannot appear later; the guards only skip
    work. ``lower(upper(x))`` folds every character that Java's Unicode
    case-insensitive match equates with an ASCII letter. Intermediate texts are
    bound with ``let`` so the expression tree stays linear in the number of steps.
    """
    t0 = col_(text)

    def steps(fold):
        def has(*words):
            # U+0130 matches "i" case-insensitively but folds to "i" + U+0307: such texts
            # always run the pattern.
            cond = F.contains(t0, F.lit("\u0130"))
            for w in words:
                cond = cond | F.contains(fold, F.lit(w))
            return cond

        def rx(pattern):
            return lambda x: F.regexp_replace(x, pattern, "")

        guarded = (
            (has("original message"), rx(CUT_ORIGINAL)),
            (has("forwarded by"), rx(CUT_FORWARDED)),
            (has(" wrote:"), cut_at_pair(*CUT_WROTE)),
            (has(">"), drop_quoted_lines),
            (has("this message", "this email", "this e-mail", "this communication")
             & has("confidential", "privileged"), cut_at_pair(*DISCLAIMERS[0])),
            (has("enron disclaimer"), cut_at_pair(*DISCLAIMERS[1])),
            (has("econnection") & has("***"), cut_at_pair(*DISCLAIMERS[2])),
        )
        def step(guard, fn):
            return lambda x: F.when(guard, fn(x)).otherwise(x)

        t = t0
        for guard, fn in guarded:
            t = let(t, step(guard, fn))
        # Spark's regex replace re-encodes the whole text even without a match: guard
        # the collapses with byte searches for their targets (on the current text).
        t = let(t, lambda x: F.when(F.contains(x, F.lit("\n\n\n")),
                                    F.regexp_replace(x, r"\n{3,}", "\n\n")).otherwise(x))
        t = let(t, lambda x: F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, r" {2,}", " ")).otherwise(x))
        return py_strip(t)

    return let(F.lower(F.upper(t0)), steps)


# ---------------------------------------------------------- validity (F8)

def is_valid_email(body="body", subject="subject", min_body_len: int = fixed.MIN_BODY_LENGTH,
                   max_body_len: int = fixed.MAX_BODY_LENGTH) -> Column:
    b, s = col_(body), col_(subject)
    n = F.length(b)
    low = F.lower(s)
    auto = F.lit(False)
    for kw in fixed.AUTO_SUBJECT_KEYWORDS:
        auto = auto | F.contains(low, F.lit(kw))
    return (n >= min_body_len) & (n <= max_body_len) & (py_strip(s) != F.lit("")) & ~auto


# ---------------------------------------------------------- subjects (F9-F11)

def strip_subject_prefix(subject) -> Column:
    """One leading Re/Fw/Fwd ':' prefix removed from the stripped subject, stripped again."""
    return py_strip(F.regexp_replace(py_strip(subject), SUBJECT_PREFIX, ""))


def normalise_subject(subject) -> Column:
    """Threading key: prefix removed, stripped, lower-cased."""
    return F.lower(strip_subject_prefix(subject))


def is_reply_subject(subject) -> Column:
    return py_strip(subject).rlike(REPLY_SUBJECT)


# ---------------------------------------------------------- whole pass

def prepare_messages(raw: DataFrame, min_body_len: int = fixed.MIN_BODY_LENGTH,
                     max_body_len: int = fixed.MAX_BODY_LENGTH,
                     size_col: str | None = None) -> DataFrame:
    """Folder selection, size prefilter, parse, clean and quality filter (no dedup).

    ``size_col`` names a byte-length column (the file scan's ``length``); without
    it the UTF-8 length of the content is used.
    """
    sel = select_folders(raw)
    size = F.col(size_col) if size_col else F.octet_length("content")
    sel = sel.where(size <= max_body_len + fixed.FILE_SIZE_SLACK)
    if size_col:
        sel = sel.drop(size_col)
    parsed = parse_messages(sel).withColumn("body", clean_body("body"))
    return evaluated_once(parsed).where(is_valid_email("body", "subject", min_body_len, max_body_len))


def evaluated_once(df: DataFrame) -> DataFrame:
    """Evaluate ``df``'s projected expressions once per row before later filters.

    Catalyst pushes a filter below a projection by inlining the projected
    expressions into the condition, so a costly text expression (the header fold,
    the cleaner) would run once per conjunct plus once for the output. Passing the
    row through a one-element ``inline`` (a Generate) keeps filters above it.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
