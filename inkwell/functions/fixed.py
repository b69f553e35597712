"""Fixed values that must equal the reference behaviour for identical results.

Everything here is data (word lists, prompt texts, thresholds), kept together
and in natural order. Regex spellings for the JVM live in ``text.py``; the
DuckDB (RE2) spellings used by the oracle live in ``plans/oracle.py``.
"""

# --- fixed values: folder names (compared after lower, strip "_", " " -> "_") ---
SENT_FOLDER_NAMES = ("sent", "sent_items", "_sent_mail", "sent_mail")
INBOX_FOLDER_NAMES = ("inbox", "notes_inbox")

# --- fixed values: system prompts of the two sample tasks ---
SYSTEM_PROMPT_COMPOSE = (
    "You are a professional email writing assistant. "
    "Write clear, concise, and professional emails based on the given subject and context."
)
SYSTEM_PROMPT_REPLY = (
    "You are a professional email reply assistant. "
    "Write thoughtful and professional replies to the given email."
)

# --- fixed values: prompt templates ---
COMPOSE_PREFIX = "Write a professional email with the subject: "
REPLY_PREFIX = "Reply to this email:"
CONTEXT_PREFIX = "Additional context: "
TONE_DEFAULT = "Professional"
BLANK_SUBJECT_MESSAGE = "⚠️ Please enter a subject line."
BLANK_EMAIL_MESSAGE = "⚠️ Please paste the email you want to reply to."

# --- fixed values: chat rendering markers ---
CHAT_BEGIN = "<|begin_of_text|>"
CHAT_HEADER_START = "<|start_header_id|>"
CHAT_HEADER_END = "<|end_header_id|>"
CHAT_EOT = "<|eot_id|>"

# --- fixed values: automatic-subject keywords (quality filter) ---
AUTO_SUBJECT_KEYWORDS = ("out of office", "undeliverable", "delivery failure")

# --- fixed values: body length bounds and size prefilter slack ---
MIN_BODY_LENGTH = 50
MAX_BODY_LENGTH = 2000
FILE_SIZE_SLACK = 5000

# --- fixed values: sampling defaults ---
MAX_SAMPLES = 10000
VAL_RATIO = 0.1
SEED = 42
EVAL_MAX_SAMPLES = 100

# --- fixed values: format compliance weights ---
GREETING_WEIGHT = 0.33
BODY_WEIGHT = 0.34
CLOSING_WEIGHT = 0.33
BODY_MIN_CHARS = 20

# --- fixed values: error analysis thresholds ---
REPETITION_MIN_WORDS = 10
REPETITION_MIN_REPEATS = 3
TOO_SHORT_WORDS = 10
TOO_LONG_FACTOR = 2
TOO_LONG_MIN_REF_WORDS = 10
OFF_TOPIC_ROUGE1 = 0.1
REPETITION_SCORE_MIN_WORDS = 4
HIGH_REPETITION_SCORE = 0.1
FAILURE_ORDER = ("repetition", "too_short", "too_long", "no_greeting", "no_closing", "off_topic")

# --- fixed values: recommendation rules (failure mode, rate threshold, message) ---
RECOMMENDATION_RULES = (
    ("repetition", 0.05, "High repetition rate — consider increasing repetition penalty during generation"),
    ("no_greeting", 0.3, "Many emails lack greetings — consider adjusting system prompt"),
    ("no_closing", 0.3, "Many emails lack closings — consider adding closing examples to training data"),
    ("too_short", 0.1, "Many short responses — consider increasing min_new_tokens"),
)

# --- fixed values: metric display groups (group, metrics in order) ---
METRIC_GROUPS = (
    ("N-gram Overlap", ("rouge1", "rouge2", "rougeL", "bleu")),
    ("Semantic Similarity", ("bertscore_precision", "bertscore_recall", "bertscore_f1")),
    ("Diversity", ("distinct_1", "distinct_2", "distinct_3")),
    ("Email Format", ("format_compliance", "has_greeting_rate", "has_body_rate", "has_closing_rate")),
    ("Length (Generated)", ("pred_word_count_mean", "pred_sentence_count_mean", "pred_char_count_mean")),
    ("Length (Reference)", ("ref_word_count_mean", "ref_sentence_count_mean", "ref_char_count_mean")),
)

# --- fixed values: comparison table metrics ---
COMPARE_KEYS = ("rouge1", "rouge2", "rougeL", "bleu", "bertscore_f1", "distinct_1", "distinct_2",
                "format_compliance")

# --- fixed values: chart series (chart, metric keys in order) ---
CHART_SERIES = (
    ("overlap", ("rouge1", "rouge2", "rougeL", "bleu")),
    ("embedding", ("bertscore_precision", "bertscore_recall", "bertscore_f1")),
    ("format", ("has_greeting_rate", "has_body_rate", "has_closing_rate", "format_compliance")),
    ("diversity", ("distinct_1", "distinct_2", "distinct_3")),
)

# --- fixed values: task metric columns of the per-task summary ---
TASK_METRICS = ("rouge1", "rouge2", "rougeL", "bleu", "format_compliance")

# --- fixed values: per-sample truncation lengths ---
PROMPT_CHARS = 200
TEXT_CHARS = 500

# --- fixed values: BLEU ---
BLEU_MAX_N = 4
BLEU_EPSILON = 0.1

# --- fixed values: histogram and listing sizes ---
HIST_BINS = 30
WORST_K = 5
REPETITIVE_K = 3
LISTING_K = 5

# --- fixed values: training sequence settings ---
MAX_SEQ_LENGTH = 512
