"""The registered queries of the training-data operators, and their SQL where SQL can say it.

Each query applies its operator to the whole table and keeps the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (chat, decontaminate, exact_dedup, license_scan, merkle, ngram_lm, packing, prefix_trie, quality,
                         simhash, suffix_dedup, token_counts, toxicity)
from inkwell.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# lower case A-Z only, as the contracts say
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII string, bit by bit."""
    step = "list_reduce(list_prepend(xor(c, b), [0,0,0,0,0,0,0,0]::UBIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    octets = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {octets}), lambda c, b: {step}), 4294967295::UBIGINT)"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)""")
def op1(spark, sf_dir):
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents")).drop("__rid")


@register("op2_simhash")
def op2(spark, sf_dir):
    return (simhash.near_dedup(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
            .select("doc_id", "fingerprint", "component_id"))


@register("op3_token_counts")
def op3(spark, sf_dir):
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), TOKENIZER, limit=512)


@register("op4_quality")
def op4(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


@register("op5_lm_score")
def op5(spark, sf_dir):
    return ngram_lm.score_documents(read_table(spark, sf_dir, "documents"))


@register("op6_packing")
def op6(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER, size=2048)


@register("op7_toxicity")
def op7(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


@register("op8_suffix_dedup")
def op8(spark, sf_dir):
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), window=400)


@register("op9_chat", r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns,
       string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
       coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
       sum(24 + length(role) + length(text) + len(regexp_extract_all(text,
         '<\\*(?:/?s>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)|\[\\*/?INST\]')))::BIGINT AS formatted_chars
      FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars FROM g""")
def op9(spark, sf_dir):
    both = F.lit("</s>[INST] ok [/INST]")
    two = [F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"),
                    both.alias("text")) for k, role in enumerate(("user", "assistant"))]
    fixed = spark.range(1).select(F.inline(F.array(*two)))
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    return chat.digest(chat.format_paths(chat.reply_paths(chat.chain(turns))))


@register("op10_decontaminate", rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM benchmark),
items AS (SELECT item_id, least(5, len(words)) AS width, unnest(list_distinct(list_transform(
            range(1, greatest(1, len(words) - 4) + 1),
            lambda i: array_to_string(words[i:i + 4], ' ')))) AS gram FROM b WHERE len(words) > 0),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM items GROUP BY item_id),
docs AS (SELECT doc_id, width, unnest(list_distinct(list_transform(range(1, len(words) - width + 2),
            lambda i: array_to_string(words[i:i + width - 1], ' ')))) AS gram
         FROM w, (SELECT DISTINCT width FROM items) WHERE len(words) >= width),
shared AS (SELECT doc_id, item_id, count(*) AS shared_shingles FROM docs JOIN items USING (width, gram)
           GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, shared_shingles, shared_shingles / item_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE shared_shingles >= 0.8 * item_shingles - 1e-9""")
def op10(spark, sf_dir):
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_PART = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_HEAD = " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars"))


def _tree(name: str, leaves: str) -> str:
    """Levels of a forest of ``leaves`` (tree, pos, h), and the digests beside each node of a run."""
    return f"""
{name} AS (
  SELECT tree, 0 AS lvl, pos AS idx, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM {name} WHERE n > 1
  GROUP BY tree, lvl, idx // 3, n),
{name}_sides AS (
  SELECT a.tree, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1
  GROUP BY a.tree, a.lvl, a.idx)"""


@register("op11_merkle", rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce('=' || source, '') AS tree,
         sha256({_HEAD} || {_PART.format("text")}) AS h,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0
              THEN sha256({_HEAD} || {_PART.format("replace(text, chr(10), '')")}) END AS bad FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, rid) - 1 AS pos FROM d),
{_tree("sub", "leaves")},
subroots AS (SELECT '' AS tree, tree AS of, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM sub WHERE n = 1),
{_tree("upper", "subroots")},
walk AS (
  SELECT rid, tree, 0 AS lvl, pos AS idx, coalesce(bad, h) AS cur, '' AS proof FROM leaves
  UNION ALL
  SELECT rid, tree, lvl + 1, idx // 3, sha256(l || cur || r), proof || l || r
  FROM walk JOIN sub_sides USING (tree, lvl, idx)),
climb AS (
  SELECT w.rid, s.tree, 0 AS lvl, s.pos AS idx, w.cur, w.proof, s.h AS subroot
  FROM (SELECT rid, tree, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM walk GROUP BY rid, tree) w
  JOIN subroots s ON s.of = w.tree
  UNION ALL
  SELECT rid, tree, lvl + 1, idx // 3, sha256(l || cur || r), proof || l || r, subroot
  FROM climb JOIN upper_sides USING (tree, lvl, idx)),
done AS (SELECT rid, any_value(subroot) AS subroot, arg_max(cur, lvl) AS folded_root, arg_max(proof, lvl) AS proof
         FROM climb GROUP BY rid)
SELECT doc_id, h AS leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM d JOIN done USING (rid), (SELECT h AS root FROM upper WHERE n = 1)""")
def op11(spark, sf_dir):
    return merkle.verify(read_table(spark, sf_dir, "documents"))


@register("op13_prefix_trie", rf"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
        || coalesce(text, ''))) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d, role, text FROM (
        SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND pos < h
        UNION ALL SELECT conv_id, 1, pos, role, text FROM o JOIN c USING (conv_id) WHERE pos >= h)),
p AS (SELECT conv_id, d, length(text) AS chars, string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '')
             OVER (PARTITION BY conv_id ORDER BY d) AS key FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved
      FROM p GROUP BY d, key),
u AS (SELECT n.*, q.key AS parent FROM n LEFT JOIN p q ON q.conv_id = n.conv_id AND q.d = n.d - 1),
kids AS (SELECT d - 1 AS d, parent AS key, count(*) AS n_children FROM u WHERE d > 0 GROUP BY ALL),
ends AS (SELECT d, key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS s
         FROM p JOIN (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id) USING (conv_id, d) GROUP BY d, key),
sums AS (SELECT p.d, p.key, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved
         FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d LEFT JOIN kids k ON k.d = n.d AND k.key = n.key
         GROUP BY p.d, p.key)
SELECT u.conv_id, u.d::BIGINT AS depth, a.conv_id AS parent_conv_id, u.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       sums.n_leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, coalesce(s, sha256('')) AS ends_sha256
FROM u LEFT JOIN n a ON a.d = u.d - 1 AND a.key = u.parent LEFT JOIN kids k ON k.d = u.d AND k.key = u.key
LEFT JOIN ends e ON e.d = u.d AND e.key = u.key JOIN sums ON sums.d = u.d AND sums.key = u.key""")
def op13(spark, sf_dir):
    return prefix_trie.shared_trie(read_table(spark, sf_dir, "conversations")).drop("key")


def _regex(items: list) -> str:
    """A template as a regular expression over words that each have a space behind them."""
    one = {bytes: lambda x: x.decode() + " ", list: lambda x: f"(?:{_regex(x)})?",
           tuple: lambda x: "(?:[^ ]+ ){%d,%d}" % x}
    return "".join(one[type(x)](x) for x in items)


def _licenses() -> str:
    """(label, words of mandatory wording, expression) of every template as a SQL list."""
    known = [*license_scan.PHRASES, *license_scan.TEMPLATES]
    rows = [(label, license_scan.parse(text)) for label, text in known]
    return ", ".join(f"('{label}', {sum(isinstance(x, bytes) for x in items)}, ' {_regex(items)}')" for label, items in rows)


_PHRASES = ", ".join(f"('{label}', '{phrase}')" for label, phrase in license_scan.PHRASES)


@register("op12_license_scan", rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT label, string_split(phrase, ' ') AS words FROM (VALUES {_PHRASES}) v(label, phrase)),
base AS (SELECT rid, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(words)] = words)) AS place FROM d, p),
b AS (SELECT rid, count(*) AS n, min(place) AS lo, max(place) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM base GROUP BY rid),
t AS (SELECT * FROM (VALUES {_licenses()}) v(label, wording, expression)),
m AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(wording) AS wording
      FROM d, t WHERE regexp_matches(' ' || array_to_string(w, ' ') || ' ', expression) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(m.labels, '') AS labels, coalesce(wording / (wording + 1.0), 0)::DOUBLE AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN m USING (rid)""")
def op12(spark, sf_dir):
    return license_scan.summary(read_table(spark, sf_dir, "documents"))
