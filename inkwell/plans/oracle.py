"""DuckDB spellings of the text primitives, for the oracle SQL.

RE2 has no look-around, an ASCII ``\\b`` and ``\\s``, and ``\\x{....}`` code
point escapes; the oracle formulations are written independently of the Spark
code (windows and unnest instead of folds and aggregates) so that they check
it rather than restate it.
"""

from __future__ import annotations

from inkwell.functions.fixed import AUTO_SUBJECT_KEYWORDS, INBOX_FOLDER_NAMES, SENT_FOLDER_NAMES
from inkwell.functions.text import PY_WS_CHARS
from inkwell.sources.tables import view_sql

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NON_WS = r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPLITLINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
WS_CHARS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WS_CHARS) + ")"
NL = "chr(10)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def ws_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(NON_WS + '+')})"


def ngrams(tokens: str, n: int) -> str:
    return (f"(CASE WHEN len({tokens}) >= {n} THEN list_transform(range(1, len({tokens}) - {n} + 2), "
            f"lambda i: array_to_string({tokens}[i:i + {n - 1}], ' ')) ELSE []::VARCHAR[] END)")


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# ------------------------------------------------------------------ corpus CTEs

def _norm_folder(x: str) -> str:
    return f"replace(trim(lower({x}), '_'), ' ', '_')"


CORPUS_CTES = f"""
raw_messages AS ({view_sql('raw_messages')}),
sel AS (
  SELECT doc_id, path, user_name AS "user", folder, content,
         CASE WHEN {_norm_folder('folder')} IN {in_list(SENT_FOLDER_NAMES)} THEN 'sent'
              WHEN {_norm_folder('folder')} IN {in_list(INBOX_FOLDER_NAMES)} THEN 'inbox' END AS box
  FROM raw_messages),
chosen AS (SELECT * FROM sel WHERE box IS NOT NULL),
sized AS (SELECT *, instr(content, {NL} || {NL}) AS pos FROM chosen WHERE octet_length(encode(content)) <= 7000),
split AS (
  SELECT doc_id, path, "user", box, substr(content, 1, pos - 1) AS header,
         {strip('substr(content, pos + 2)')} AS raw_body
  FROM sized WHERE pos > 0),
hlines AS (
  SELECT doc_id, unnest(regexp_split_to_array(header, {q(SPLITLINES)})) AS line,
         generate_subscripts(regexp_split_to_array(header, {q(SPLITLINES)}), 1) AS ln
  FROM split),
hdesc AS (
  SELECT doc_id, ln, {strip('line')} AS s,
         (left(line, 1) IN (' ', chr(9))) AS ws,
         instr(line, ':') AS colon,
         {strip("split_part(line, ':', 1)")} AS k,
         {strip("substr(line, instr(line, ':') + 1)")} AS v
  FROM hlines),
hkeyed AS (
  SELECT *, (s <> '' AND colon > 0 AND NOT ws) AS is_key,
         (s <> '' AND ws) AS is_cont
  FROM hdesc),
hgroup AS (
  SELECT *, sum(CASE WHEN is_key THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ln
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g
  FROM hkeyed WHERE is_key OR is_cont),
hvalues AS (
  SELECT doc_id, g, max(CASE WHEN is_key THEN k END) AS k,
         max(CASE WHEN is_key THEN v END) || coalesce(string_agg(CASE WHEN is_cont THEN ' ' || s END, '' ORDER BY ln), '') AS v
  FROM hgroup WHERE g > 0 GROUP BY doc_id, g),
headers AS (
  SELECT doc_id,
         coalesce(arg_max(v, g) FILTER (WHERE k = 'Message-ID'), '') AS message_id,
         coalesce(arg_max(v, g) FILTER (WHERE k = 'Date'), '') AS date,
         coalesce(arg_max(v, g) FILTER (WHERE k = 'From'), '') AS from_addr,
         coalesce(arg_max(v, g) FILTER (WHERE k = 'To'), '') AS to_addr,
         coalesce(arg_max(v, g) FILTER (WHERE k = 'Cc'), '') AS cc,
         coalesce(arg_max(v, g) FILTER (WHERE k = 'Subject'), '') AS subject,
         coalesce(arg_max(v, g) FILTER (WHERE k = 'X-Folder'), '') AS x_folder
  FROM hvalues GROUP BY doc_id),
parsed AS (
  SELECT p.doc_id, p.path, p."user", p.box,
         coalesce(h.message_id, '') AS message_id, coalesce(h.date, '') AS date,
         coalesce(h.from_addr, '') AS from_addr, coalesce(h.to_addr, '') AS to_addr,
         coalesce(h.cc, '') AS cc, coalesce(h.subject, '') AS subject, p.raw_body AS body,
         coalesce(h.x_folder, '') AS x_folder
  FROM split p LEFT JOIN headers h ON p.doc_id = h.doc_id),
c1 AS (SELECT *, regexp_replace(body, {q('(?is)-{3,}' + WS + '*Original Message' + WS + '*-{3,}.*' + chr(92) + 'z')}, '') AS t1 FROM parsed),
c2 AS (SELECT *, regexp_replace(t1, {q('(?is)-{3,}' + WS + '*Forwarded by' + WS + '.*?-{3,}.*' + chr(92) + 'z')}, '') AS t2 FROM c1),
c3 AS (SELECT *, regexp_replace(t2, {q('(?is)On .+? wrote:.*' + chr(92) + 'z')}, '') AS t3 FROM c2),
c4 AS (SELECT *, array_to_string(list_filter(string_split(t3, {NL}), lambda l: NOT regexp_matches(l, {q('^' + WS + '*>')})), {NL}) AS t4 FROM c3),
c5 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(t4,
         {q('(?is)(?:This message|This e-?mail|This communication).*?(?:confidential|privileged).*')}, ''),
         {q('(?is)ENRON DISCLAIMER.*')}, ''), {q('(?is)' + chr(92) + '*{3,}.*?ECONNECTION.*')}, '') AS t5 FROM c4),
cleaned AS (
  SELECT doc_id, path, "user", box, message_id, date, from_addr, to_addr, cc, subject,
         {strip("regexp_replace(regexp_replace(t5, chr(10) || '{3,}', chr(10) || chr(10), 'g'), ' {2,}', ' ', 'g')")} AS body,
         x_folder
  FROM c5),
valid AS (
  SELECT * FROM cleaned
  WHERE length(body) >= 50 AND length(body) <= 2000 AND {strip('subject')} <> ''
    AND NOT ({' OR '.join(f"contains(lower(subject), {q(k)})" for k in AUTO_SUBJECT_KEYWORDS)})),
hashed AS (SELECT *, md5(body) AS body_hash,
                  row_number() OVER (PARTITION BY md5(body) ORDER BY "user", path) AS rn FROM valid),
messages AS (SELECT * EXCLUDE (rn) FROM hashed WHERE rn = 1)
"""

SUBJECT_PREFIX = "(?i)^(?:Re|Fw|Fwd)" + WS + "*:" + WS + "*"
REPLY_SUBJECT = "(?i)^Re" + WS + "*:"


def strip_subject_prefix(x: str) -> str:
    return strip(f"regexp_replace({strip(x)}, {q(SUBJECT_PREFIX)}, '')")


def normalise_subject(x: str) -> str:
    return f"lower({strip_subject_prefix(x)})"


# ------------------------------------------------------------------ metric CTEs

GREETING_RE2 = (r"(?im)^(?:(?:dear|hi|hello|hey|good" + WS + r"+(?:morning|afternoon|evening)|greetings)"
                r"(?:[^\pL\pN_]|$)|to whom)")
CLOSING_RE2 = (r"(?im)(?:regards|sincerely|best|thanks|thank you|cheers|warm regards|kind regards|"
               r"respectfully|take care|all the best|cordially)" + WS + r"*[,.]?" + WS + r"*$")


def _grams_union(kind_orders) -> str:
    parts = []
    for kind, col_p, col_r, orders in kind_orders:
        for n in orders:
            for side, col in (("p", col_p), ("r", col_r)):
                parts.append(f"SELECT model_name, sample_id, '{kind}' AS kind, {n} AS n, '{side}' AS side, "
                             f"unnest({ngrams(col, n)}) AS g FROM tok")
    return "\nUNION ALL ".join(parts)


def n_total(tokens: str, n: int) -> str:
    return f"greatest(len({tokens}) - {n - 1}, 0)"


def _pattern(w: str) -> str:
    """Vowels as V and consonants as C; a y is a consonant at the start and after a vowel."""
    x = f"regexp_replace(regexp_replace({w}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    x = f"regexp_replace({x}, '^y', 'C')"
    for _ in range(4):  # runs of y resolve from the left
        x = f"regexp_replace(regexp_replace({x}, 'Vy', 'VC', 'g'), 'Cy', 'CV', 'g')"
    return x


def stem_ctes(words: str) -> str:
    """CTEs from ``words`` (a CTE with a column word) to stems(word, stem): the stemmer as one CASE per step."""
    from inkwell.functions import porter

    head = lambda x, k: f"substr({x}, 1, length(w) - {k})"
    ends = lambda *sufs: "(" + " OR ".join(f"ends_with(w, '{x}')" for x in sufs) + ")"
    m0 = lambda x: f"regexp_matches({x}, 'VC')"
    m1 = lambda x: f"regexp_matches({x}, 'V+C+V+C')"
    cvc = lambda x, q: (f"((length({x}) = 2 AND {q} = 'VC') OR (regexp_matches({q}, 'CVC$') "  # noqa: E731
                        f"AND NOT regexp_matches({x}, '[wxy]$')))")
    double = "(length(w) >= 2 AND w[-1] = w[-2] AND p[-1] = 'C')"
    def rules(table, test):  # noqa: E306
        return " ".join(f"WHEN ends_with(w, '{a}') THEN CASE WHEN {test(head('p', len(a)))} "
                        f"THEN {head('w', len(a))} || '{b}' ELSE w END" for a, b in table)
    step4 = " ".join(
        f"WHEN ends_with(w, '{x}') THEN CASE WHEN {m1(head('p', len(x)))}"
        + (f" AND regexp_matches({head('w', 3)}, '[st]$')" if x == "ion" else "")
        + f" THEN {head('w', len(x))} ELSE w END" for x in porter._STEP4_L)
    steps = [
        (f"CASE WHEN {ends('sses')} THEN {head('w', 2)} "
         f"WHEN {ends('ies')} THEN CASE WHEN length(w) = 4 THEN {head('w', 1)} ELSE {head('w', 2)} END "
         f"WHEN {ends('ss')} THEN w WHEN {ends('s')} THEN {head('w', 1)} ELSE w END", "false"),
        (f"CASE WHEN {ends('ied')} THEN CASE WHEN length(w) = 4 THEN {head('w', 1)} ELSE {head('w', 2)} END "
         f"WHEN {ends('eed')} THEN CASE WHEN {m0(head('p', 3))} THEN {head('w', 1)} ELSE w END "
         f"WHEN {ends('ed')} AND contains({head('p', 2)}, 'V') THEN {head('w', 2)} "
         f"WHEN {ends('ing')} AND contains({head('p', 3)}, 'V') THEN {head('w', 3)} ELSE w END",
         f"NOT {ends('ied', 'eed')} AND (({ends('ed')} AND contains({head('p', 2)}, 'V')) "
         f"OR ({ends('ing')} AND contains({head('p', 3)}, 'V')))"),
        (f"CASE WHEN NOT extra THEN w WHEN {ends('at', 'bl', 'iz')} THEN w || 'e' "
         f"WHEN {double} THEN CASE WHEN w[-1] IN ('l', 's', 'z') THEN w ELSE {head('w', 1)} END "
         f"WHEN {m0('p')} AND NOT {m1('p')} AND {cvc('w', 'p')} THEN w || 'e' ELSE w END", "false"),
        (f"CASE WHEN {ends('y')} AND length(w) > 2 AND p[-2] = 'C' THEN {head('w', 1)} || 'i' ELSE w END", "false"),
        (f"CASE WHEN {ends('alli')} AND {m0(head('p', 4))} THEN {head('w', 2)} "
         f"WHEN {ends('logi')} THEN CASE WHEN {m0(head('p', 3))} THEN {head('w', 1)} ELSE w END "
         f"{rules(porter._STEP2_L, m0)} ELSE w END", "false"),
        (f"CASE {rules(porter._STEP3_L, m0)} ELSE w END", "false"),
        (f"CASE {step4} ELSE w END", "false"),
        (f"CASE WHEN {ends('e')} AND ({m1(head('p', 1))} OR ({m0(head('p', 1))} AND NOT {cvc(head('w', 1), head('p', 1))})) "
         f"THEN {head('w', 1)} ELSE w END", "false"),
        (f"CASE WHEN {m1(head('p', 1))} AND {ends('ll')} THEN {head('w', 1)} ELSE w END", "false"),
    ]
    out = [f"st0 AS (SELECT word, word AS w, {_pattern('word')} AS p, false AS extra "
           f"FROM (SELECT DISTINCT word FROM {words} WHERE length(word) > 3) v)"]
    for i, (w, extra) in enumerate(steps):
        out.append(f"st{i + 1} AS (SELECT word, w, {_pattern('w')} AS p, extra "
                   f"FROM (SELECT word, {w} AS w, {extra} AS extra FROM st{i}) x)")
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in porter.IRREGULAR.items())
    out.append(f"stems AS (SELECT word, CASE word {irregular} ELSE w END AS stem FROM st{len(steps)})")
    return ",\n".join(out)


LCS_CTES = """
lcs AS (
  SELECT model_name, sample_id, CASE WHEN len(pr) <= len(rr) THEN pr ELSE rr END AS a,
         CASE WHEN len(pr) <= len(rr) THEN rr ELSE pr END AS b, 0 AS i,
         list_transform(CASE WHEN len(pr) <= len(rr) THEN rr ELSE pr END, lambda x: 0) AS row
  FROM tok WHERE len(pr) > 0 AND len(rr) > 0
  UNION ALL
  SELECT model_name, sample_id, a, b, i + 1, list_transform(cand, lambda x, j: list_max(cand[1:j]))
  FROM (SELECT *, list_transform(b, lambda y, j: greatest(row[j],
          (CASE WHEN j > 1 THEN row[j - 1] ELSE 0 END) + (CASE WHEN y = a[i + 1] THEN 1 ELSE 0 END))) AS cand
        FROM lcs WHERE i < len(a)) x),
lcs_len AS (SELECT model_name, sample_id, row[-1] AS n FROM lcs WHERE i = len(a))"""


def metric_ctes(stem: bool = True, lcs: bool = True) -> str:
    """pairs -> tok (stemmed if asked) -> per-pair overlap -> pair_metrics (rougeL if asked)."""
    kinds = (("rouge", "pr", "rr", (1, 2)), ("bleu", "pb", "rb", (1, 2, 3, 4)))
    ov_cols = []
    for kind, cp, cr, orders in kinds:
        for n in orders:
            ov_cols.append(f"coalesce(sum(overlap) FILTER (WHERE kind = '{kind}' AND n = {n}), 0) AS {kind}{n}")

    def rouge(n):
        p = f"(o.rouge{n} / greatest({n_total('t.pr', n)}, 1))"
        r = f"(o.rouge{n} / greatest({n_total('t.rr', n)}, 1))"
        return f"CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"

    bleu_terms = " + ".join(
        f"0.25 * ln(CASE WHEN num{n} = 0 THEN 0.1 / den{n} ELSE num{n} / den{n} END)" for n in (1, 2, 3, 4))
    stemming = ""
    if stem:
        stemming = f""",
toks AS (
  SELECT model_name, sample_id, side, unnest(t) AS word, generate_subscripts(t, 1) AS pos
  FROM (SELECT model_name, sample_id, 'p' AS side, pr AS t FROM tok0
        UNION ALL SELECT model_name, sample_id, 'r', rr FROM tok0) x),
{stem_ctes('toks')},
stemmed AS (
  SELECT t.model_name, t.sample_id, list(coalesce(s.stem, t.word) ORDER BY pos) FILTER (WHERE side = 'p') AS pr,
         list(coalesce(s.stem, t.word) ORDER BY pos) FILTER (WHERE side = 'r') AS rr
  FROM toks t LEFT JOIN stems s ON t.word = s.word GROUP BY t.model_name, t.sample_id),
tok AS (
  SELECT t.* REPLACE (coalesce(s.pr, []::VARCHAR[]) AS pr, coalesce(s.rr, []::VARCHAR[]) AS rr)
  FROM tok0 t LEFT JOIN stemmed s ON t.model_name = s.model_name AND t.sample_id = s.sample_id)"""
    p_l, r_l = "(l.n / len(t.pr))", "(l.n / len(t.rr))"
    rouge_l = f", CASE WHEN l.n > 0 THEN 2 * {p_l} * {r_l} / ({p_l} + {r_l}) ELSE 0.0 END AS rougeL" if lcs else ""
    return f"""
pairs AS ({view_sql('pairs')}),
{'tok0' if stem else 'tok'} AS (
  SELECT model_name, sample_id, task_type, prompt, prediction, reference,
         regexp_extract_all(lower(prediction), '[a-z0-9]+') AS pr,
         regexp_extract_all(lower(reference), '[a-z0-9]+') AS rr,
         {ws_tokens('prediction')} AS pb, {ws_tokens('reference')} AS rb,
         {ws_tokens('lower(prediction)')} AS pl
  FROM pairs){stemming},{LCS_CTES + "," if lcs else ""}
grams AS ({_grams_union(kinds)}),
gram_counts AS (SELECT model_name, sample_id, kind, n, side, g, count(*) AS c FROM grams GROUP BY ALL),
gram_overlap AS (
  SELECT p.model_name, p.sample_id, p.kind, p.n, sum(least(p.c, r.c)) AS overlap
  FROM gram_counts p JOIN gram_counts r
    ON p.model_name = r.model_name AND p.sample_id = r.sample_id AND p.kind = r.kind AND p.n = r.n
   AND p.g = r.g AND p.side = 'p' AND r.side = 'r'
  GROUP BY ALL),
ov AS (SELECT model_name, sample_id, {', '.join(ov_cols)} FROM gram_overlap GROUP BY model_name, sample_id),
pair_counts AS (
  SELECT t.model_name, t.sample_id, t.task_type, t.prompt, t.prediction, t.reference,
         {rouge(1)} AS rouge1, {rouge(2)} AS rouge2{rouge_l},
         {', '.join(f"coalesce(o.bleu{n}, 0) AS num{n}, greatest({n_total('t.pb', n)}, 1) AS den{n}" for n in (1, 2, 3, 4))},
         len(t.pb) AS hyp_len, len(t.rb) AS ref_len, t.pl
  FROM tok t LEFT JOIN ov o ON t.model_name = o.model_name AND t.sample_id = o.sample_id
  {"LEFT JOIN lcs_len l ON t.model_name = l.model_name AND t.sample_id = l.sample_id" if lcs else ""}),
pair_metrics AS (
  SELECT *,
         CASE WHEN num1 = 0 THEN 0.0 ELSE
           (CASE WHEN hyp_len > ref_len THEN 1.0 WHEN hyp_len = 0 THEN 0.0 ELSE exp(1.0 - ref_len / hyp_len) END)
           * exp({bleu_terms}) END AS bleu,
         {', '.join(f"CASE WHEN len({ngrams('pl', n)}) > 0 THEN len(list_distinct({ngrams('pl', n)})) / len({ngrams('pl', n)}) ELSE 0.0 END AS distinct_{n}" for n in (1, 2, 3))},
         regexp_matches(prediction, {q(GREETING_RE2)}) AS has_greeting,
         length({strip('prediction')}) >= 20 AS has_body,
         regexp_matches(prediction, {q(CLOSING_RE2)}) AS has_closing,
         len({ws_tokens('prediction')}) AS pred_word_count,
         len(regexp_split_to_array(prediction, '[.!?]+')) AS pred_sentence_count,
         length(prediction) AS pred_char_count,
         len({ws_tokens('reference')}) AS ref_word_count,
         len(regexp_split_to_array(reference, '[.!?]+')) AS ref_sentence_count,
         length(reference) AS ref_char_count
  FROM pair_counts)
"""


def compliance_sql(g="has_greeting", b="has_body", c="has_closing") -> str:
    return (f"(CAST(0.33 AS DOUBLE) * CAST({g} AS DOUBLE) + CAST(0.34 AS DOUBLE) * CAST({b} AS DOUBLE)"
            f" + CAST(0.33 AS DOUBLE) * CAST({c} AS DOUBLE))")
