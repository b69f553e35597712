"""Driver tables and the derived input views.

The views give the generated prose email cues (headers, quoted lines,
disclaimers, greetings). Their SQL is valid in both Spark and DuckDB and feeds
``oracle_sql()``; ``raw_messages`` and ``requests`` run the same text on Spark
(``spark.sql`` with DataFrame arguments, so no session-global view names),
while ``pairs`` is written with the DataFrame API on the Spark side to replace
the SQL's cross join with an explode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# raw_messages: one raw mail file per row (path + full text); bodies are decorated
# by n_chars so exact copies of a document stay exact copies.
RAW_MESSAGES_SQL = """
SELECT doc_id, user_name, folder,
       'maildir/' || user_name || '/' || folder || '/' || CAST(doc_id AS STRING) || '.' AS path,
       'Message-ID: <' || CAST(doc_id AS STRING) || '@x>' || nl ||
       'Date: Mon, 14 May 2001 16:39:00 -0700 (PDT)' || nl ||
       CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'From: ' || user_name || '@x.example' || nl END ||
       'To: a@x.example,' || CASE WHEN doc_id % 3 = 0 THEN nl || chr(9) || ' b@x.example' ELSE ' b@x.example' END || nl ||
       CASE WHEN doc_id % 10 = 0 THEN 'a line without colon' || nl || ' stray continuation' || nl ELSE '' END ||
       CASE WHEN doc_id % 11 = 0 THEN 'Subject: overwritten' || nl ELSE '' END ||
       'Subject: ' || CASE WHEN doc_id % 41 = 0 THEN 'Out of Office: ' || topic
                           WHEN doc_id % 43 = 0 THEN ''
                           ELSE CASE doc_id % 5 WHEN 0 THEN 'Re: ' WHEN 1 THEN 'RE : ' WHEN 2 THEN 'Fwd: ' WHEN 3 THEN 'Re: Re: ' ELSE '' END || topic END || nl ||
       'X-Folder: ' || folder ||
       CASE WHEN doc_id % 97 = 0 THEN '' ELSE nl || nl END || body AS content
FROM (SELECT doc_id, source AS user_name, chr(10) AS nl,
             CASE doc_id % 6 WHEN 0 THEN 'sent' WHEN 1 THEN '_sent_mail' WHEN 2 THEN 'Sent Items'
                             WHEN 3 THEN 'inbox' WHEN 4 THEN 'notes_inbox' ELSE 'all_documents' END AS folder,
             'topic ' || CAST(n_chars % 97 AS STRING) AS topic,
             CASE n_chars % 8
               WHEN 1 THEN 'Dear team,' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'Best regards,' || chr(10) || 'A'
               WHEN 2 THEN text || chr(10) || '-----Original Message-----' || chr(10) || 'old text'
               WHEN 3 THEN text || chr(10) || '---------------------- Forwarded by A on 05/14/2001 ---------------------------' || chr(10) || 'old'
               WHEN 4 THEN text || chr(10) || 'On Mon, B wrote:' || chr(10) || '> old'
               WHEN 5 THEN '> quoted' || chr(10) || text || chr(10) || '  > quoted too'
               WHEN 6 THEN text || chr(10) || chr(10) || chr(10) || chr(10) || 'This message  is confidential.' || chr(10) || 'tail'
               WHEN 7 THEN 'Hi,' || chr(10) || replace(text, ' ', '  ') || chr(10) || 'ENRON DISCLAIMER' || chr(10) || 'tail'
               ELSE text END AS body
      FROM {documents}) d
"""

# pairs: (prediction, reference) per sample and model, from assistant turns that
# answer a user turn.
PAIRS_SQL = """
SELECT sample_id, model_name, CASE WHEN conv_id % 3 = 0 THEN 'reply' ELSE 'compose' END AS task_type,
       prev_text AS prompt,
       CASE WHEN model_name = 'base' THEN prev_text
            ELSE CASE (conv_id + turn) % 6
              WHEN 0 THEN 'Dear team,' || nl || nl || text || nl || nl || 'Best regards,' || nl || 'A'
              WHEN 1 THEN 'Hi,' || nl || prev_text || nl || 'Thanks.'
              WHEN 2 THEN reverse(split_part(reverse(text), nl, 1))
              WHEN 3 THEN prev_text || ' ' || prev_text || ' ' || prev_text
              WHEN 4 THEN text
              ELSE 'History of the matter: ' || coalesce(prev2_text, prev_text) END END AS prediction,
       text AS reference
FROM (SELECT conv_id, turn, role, text, chr(10) AS nl, CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS sample_id,
             lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
             lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_text,
             lag(text, 2) OVER (PARTITION BY conv_id ORDER BY turn) AS prev2_text
      FROM {conversations}) t
CROSS JOIN (SELECT 'base' AS model_name UNION ALL SELECT 'fine_tuned' AS model_name) m
WHERE role = 'assistant' AND prev_role = 'user'
"""

# requests: compose/reply requests of the serving app, one per benchmark item.
REQUESTS_SQL = """
SELECT item_id, CASE item_id % 4 WHEN 0 THEN 'Professional' WHEN 1 THEN 'Formal' WHEN 2 THEN 'Casual' ELSE 'Friendly' END AS tone,
       CASE WHEN item_id % 9 = 0 THEN '  ' ELSE split_part(text, chr(10), 1) END AS subject,
       CASE WHEN item_id % 2 = 0 THEN text ELSE '' END AS context,
       CASE WHEN item_id % 8 = 0 THEN '' ELSE text END AS original_email
FROM {benchmark}
"""

VIEWS = {
    "raw_messages": (RAW_MESSAGES_SQL, ("documents",)),
    "pairs": (PAIRS_SQL, ("conversations",)),
    "requests": (REQUESTS_SQL, ("benchmark",)),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a derived view from the driver tables it reads."""
    sql, inputs = VIEWS[name]
    args = {t: read_table(spark, sf_dir, t) for t in inputs}
    return spark.sql(sql, **args)


def view_sql(name: str) -> str:
    """The view's SQL for DuckDB, reading the pre-registered tables."""
    sql, inputs = VIEWS[name]
    return sql.format(**{t: t for t in inputs})


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_messages as a mail-file table: (path, user, folder, content)."""
    return view(spark, sf_dir, "raw_messages").selectExpr(
        "doc_id", "path", "user_name AS user", "folder", "content")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs view in DataFrame form (same rows as ``PAIRS_SQL``).

    Each assistant turn answering a user turn becomes one pair per model; the
    model rows come from exploding the two names, not from a join, and the lag
    windows are per conversation (a handful of turns). The window's own shuffle keeps the
    session's number of partitions: scoring a pair costs far more than its bytes, by which AQE would merge them.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    conv = read_table(spark, sf_dir, "conversations").repartition(n, "conv_id")
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = conv.select("conv_id", "turn", "role", "text",
                    F.lag("role").over(w).alias("prev_role"), F.lag("text").over(w).alias("prev_text"),
                    F.lag("text", 2).over(w).alias("prev2_text"))
    t = t.where((F.col("role") == "assistant") & (F.col("prev_role") == "user"))
    m = t.select("*", F.explode(F.array(F.lit("base"), F.lit("fine_tuned"))).alias("model_name"))
    nl = F.lit("\n")
    k = (F.col("conv_id") + F.col("turn")) % 6
    tuned = (F.when(k == 0, F.concat(F.lit("Dear team,"), nl, nl, F.col("text"), nl, nl,
                                     F.lit("Best regards,"), nl, F.lit("A")))
             .when(k == 1, F.concat(F.lit("Hi,"), nl, F.col("prev_text"), nl, F.lit("Thanks.")))
             .when(k == 2, F.reverse(F.split_part(F.reverse(F.col("text")), nl, F.lit(1))))
             .when(k == 3, F.concat(F.col("prev_text"), F.lit(" "), F.col("prev_text"), F.lit(" "), F.col("prev_text")))
             .when(k == 4, F.col("text"))
             .otherwise(F.concat(F.lit("History of the matter: "), F.coalesce("prev2_text", "prev_text"))))
    return m.select(
        F.concat_ws(":", "conv_id", "turn").alias("sample_id"), "model_name",
        F.when(F.col("conv_id") % 3 == 0, F.lit("reply")).otherwise(F.lit("compose")).alias("task_type"),
        F.col("prev_text").alias("prompt"),
        F.when(F.col("model_name") == "base", F.col("prev_text")).otherwise(tuned).alias("prediction"),
        F.col("text").alias("reference"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "requests")
