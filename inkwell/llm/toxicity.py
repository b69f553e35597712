"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses. Each clause is a string of words, and small weighted finite-state transducers
read it: *insult* and *threat* give a word a weight, *target*, *negation* and *reported speech* change it. The insult
transducer's lexicon is learned: words and word beginnings, weighted by how much more often labelled toxic documents of a
bounded sample hold them than clean ones (the fixed lists below keep a prior weight for words the sample
does not show). Composed, they give each match of a clause one weight: a target near it adds, a negation that governs it or a
quotation around it takes nearly all away. A clause scores as its strongest match, so that ten insults in one clause
are one scored clause; a document is judged by its scored clauses, through a logistic function
that is fitted on the same sample, each document with its own words' evidence left out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import doc_crc, drop, small_batches, store, text_or_empty
from inkwell.llm.learn import logistic, sigmoid

SAMPLE = 20_000   # most labelled documents that the lexicon and the weights are fitted on
LEXICON = 5_000   # most learned words and beginnings
SUPPORT = 5       # labelled documents that must hold one
INFORMED = 1.0    # least log-odds of one
BEGINNINGS = range(4, 9)  # letters of a word beginning
PRIOR = 4.0       # weight of a fixed word that the sample does not show
REACH = 4         # words between a target or a negation and what it governs
AIMED, DENIED, SAID = 1.0, 0.1, 0.1  # a target adds, negation and reported speech multiply
THRESHOLD = 0.3
REMEMBERED = 300_000  # words whose weight a worker keeps

# fixed values: lexicons of the transducers (English, German, French, Spanish)
INSULTS = """
idiot idiots idiotic moron morons moronic stupid scum clown clowns trash loser losers worthless pathetic disgusting
imbecile imbeciles dumb dumbass retard retarded bastard bastards bitch bitches asshole assholes jerk jerks pig filth
filthy vermin parasite parasites subhuman degenerate fool fools foolish ugly creep creeps coward cowards hypocrite
dipshit shithead dickhead douche douchebag twat wanker cunt whore slut garbage lowlife nitwit halfwit dimwit
blödmann dummkopf arschloch vollidiot trottel abschaum versager widerling drecksau schwachkopf
crétin abruti connard connasse salaud salope ordure minable débile imbécile
idiota imbécil estúpido estúpida cabrón gilipollas pendejo basura asqueroso asquerosa inútil escoria
""".split()
THREATS = """
kill hurt destroy murder stab shoot strangle beat burn hang lynch crush slaughter
töten umbringen erschiessen tuer massacrer frapper matar golpear destruir
""".split()
WILL = """
will shall gonna must should could going i'll we'll werde werden vais allons voy vamos
""".split()
TARGETS = """
you your you're yourself yourselves he him she her they them their u ur these those everyone people
du dich dir euch ihr deine tu te toi vous ton tes usted ustedes tú ti tus vosotros
""".split()
NEGATIONS = """
not no never isn't aren't wasn't weren't don't doesn't didn't won't can't cannot nobody without nor neither hardly
nicht kein keine keinen nie niemals ohne pas jamais aucun aucune sans ni nunca jamás sin tampoco
""".split()
REPORTS = """
said says say saying called calls wrote writes claimed claims told tells quoted quotes asked alleged allegedly
sagte sagt nannte nennt behauptete schrieb angeblich dit disait appelé affirme écrit
dijo dice llamó llama afirmó escribió
""".split()

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
CLAUSE = re.compile(r"[.!?;:\n\r|]+|, (?:but|aber|mais|pero) ")
BLANK = re.compile(r"\n[^\S\n]*\n")
MARK = re.compile("[\"“”„«»]")
HEADS = frozenset(INSULTS) | frozenset(THREATS)
CLASS = ({w: "I" for w in INSULTS} | {w: "K" for w in THREATS} | {w: "W" for w in WILL} | {w: "T" for w in TARGETS}
         | {w: "N" for w in NEGATIONS} | {w: "R" for w in REPORTS})


def entries(word: str) -> list[str]:
    """What the lexicon may hold of a word: itself and its beginnings, marked as such."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if n < len(word)]]


def log_odds(toxic: float, held: float, n_toxic: float, n_clean: float) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((held - toxic + 0.5) / (n_clean + 1))


@dataclass
class Lexicon:
    """``seen``: entry -> (labelled documents that hold it, toxic ones of them), of ``size`` documents, ``toxic`` toxic."""

    seen: dict = field(default_factory=dict)
    size: int = 0
    toxic: int = 0
    _known: dict = field(default_factory=dict, repr=False)

    def entry_weight(self, entry: str, without: int | None = None) -> float:
        """An entry's weight; ``without``: leave out a document of this label, which holds it."""
        held, toxic = self.seen.get(entry, (0, 0))
        size, all_toxic = self.size, self.toxic
        if without is not None:
            held, toxic, size, all_toxic = held - 1, toxic - without, size - 1, all_toxic - without
        if held < SUPPORT:
            return PRIOR if entry in HEADS else 0.0
        if toxic < SUPPORT - 1 and entry not in HEADS:
            return 0.0
        w = log_odds(toxic, held, all_toxic, size - all_toxic)
        return w if w >= INFORMED else 0.0

    def weight(self, word: str, without: int | None = None) -> float:
        """The weight that the insult and threat transducers give a word (0: no match)."""
        if without is not None:
            return max(self.entry_weight(e, without) for e in entries(word))
        w = self._known.get(word)
        if w is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            w = self._known[word] = max(self.entry_weight(e) for e in entries(word))
        return w


class Transducer:
    """An automaton over word classes: it opens on ``on`` and stays open for ``reach`` words."""

    def __init__(self, on: str, reach: int):
        self.on, self.reach = on, reach

    def read(self, classes: str) -> list[bool]:
        """For each word, whether the automaton is open after an opening class before it."""
        out, left = [], 0
        for c in classes:
            out.append(left > 0)
            left = self.reach if c == self.on else max(0, left - 1)
        return out


TARGET_BEFORE, NEGATION = Transducer("T", REACH), Transducer("N", REACH)
WILL_BEFORE, REPORT = Transducer("W", REACH), Transducer("R", 1 << 30)


def read_clause(words: list[str], lexicon: Lexicon, quoted: bool = False, without: int | None = None) -> float:
    """The weight of a clause: its strongest match, as the five transducers composed over its words give it."""
    heavy = [(i, w) for i, w in enumerate(lexicon.weight(x, without) for x in words) if w > 0]
    if not heavy:
        return 0.0
    classes = "".join(CLASS.get(w.replace("’", "'"), "-") for w in words)
    target, negated = TARGET_BEFORE.read(classes), NEGATION.read(classes)
    after = TARGET_BEFORE.read(classes[::-1])[::-1]
    will, report = WILL_BEFORE.read(classes), REPORT.read(classes)
    best = 0.0
    for i, w in heavy:
        if classes[i] == "K" and not (will[i] and after[i]):
            continue  # a verb of harm is a threat only with an intent before it and a target behind it
        if target[i] or after[i]:
            w += AIMED
        if negated[i]:
            w *= DENIED
        if quoted or report[i]:
            w *= SAID
        best = max(best, w)
    return best


def quotations(text: str) -> list[tuple[int, int]]:
    """Outermost quotations (first mark, behind the last mark) of any length, in the order of the text.

    One pass over the marks keeps a stack of open ones for "“”„ and one for «». A mark that stands both ways
    (" anywhere, “ in „…“, ”…”, »…«) opens before a word and closes behind one; where its neighbours do not
    tell, it closes what is open. An opening mark that is never closed quotes nothing, a closing one that closes nothing
    neither. A mark at the start of a paragraph goes on with the quotation open in the paragraph before.
    """
    spans, stacks = [], ([], [])
    for m in MARK.finditer(text):
        mark, at = m.group(), m.start()
        stack = stacks[mark in "«»"]
        top = text[stack[-1][0]] if stack else ""
        before = at == 0 or text[at - 1].isspace() or text[at - 1] in "([{-–—/=:"
        behind = at + 1 == len(text) or text[at + 1].isspace() or text[at + 1] in ")]}-–—/.,;:!?"
        opens, closes = before and not behind, behind and not before
        if mark == "„" or mark == "«" and top != "»" or mark == "“" and top != "„" and not (top == "“" and closes):
            closing = False
        elif mark == "«" or mark == "“" or mark == "»" and top == "«" or mark == "”" and top:
            closing = True
        else:  # " anywhere, ” or » with nothing open that it ends
            closing = closes or bool(stack) and not opens
        if closing:
            if stack:
                spans.append((stack.pop()[0], at + 1))
        elif stack and top == mark and _next_paragraph(text, stack[-1][1], at):
            stack[-1][1] = at + 1
        elif mark not in "”»" or opens:
            stack.append([at, at + 1])
    out = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _next_paragraph(text: str, start: int, at: int) -> bool:
    """Whether the paragraph behind the one that ``start`` lies in begins at ``at``."""
    said = text[start:at]
    rest = said.rstrip()
    gap = said[len(rest):].count("\n")
    return gap == 1 and "\n" not in rest or gap > 1 and not BLANK.search(rest)


def clause_weights(text: str | None, lexicon: Lexicon, without: int | None = None) -> tuple[list[float], int]:
    """Weights of the clauses that match, and the number of clauses; the whole text is read."""
    low = (text or "").lower()
    if not any(lexicon.weight(w) > 0 for w in WORD.findall(low)):
        return [], 0
    quotes = quotations(low)
    starts = [a for a, _ in quotes]
    at = clauses = 0
    out = []
    for s, e in [*(m.span() for m in CLAUSE.finditer(low)), (len(low), len(low))]:
        said = list(WORD.finditer(low, at, s))
        if said:
            clauses += 1
            q = bisect_right(starts, said[0].start()) - 1  # the quotation that could hold the first word
            w = read_clause([m.group() for m in said], lexicon, q >= 0 and said[-1].end() <= quotes[q][1], without)
            if w > 0:
                out.append(w)
        at = e
    return out, clauses


def features(text: str | None, lexicon: Lexicon, without: int | None = None) -> list[float]:
    """The composed clause scores of a document: their damped sum, the strongest two, and their mean over all clauses."""
    weights, clauses = clause_weights(text, lexicon, without)
    first, second = (sorted(weights, reverse=True) + [0.0, 0.0])[:2]
    return [math.log1p(sum(weights)), first, second, sum(weights) / max(1, clauses)]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, texts) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(-1, 4)
        return sigmoid(x @ self.weights + self.bias)


def learn_lexicon(taught: DataFrame, size: int, toxic: int) -> Lexicon:
    """Counts of words and beginnings over the labelled documents (y, text); those that tell most go to the driver,
    at most ``LEXICON`` and the fixed words. Each task sums up its documents' entries before they are shuffled."""
    def count(batches):
        held, bad = Counter(), Counter()

        def rows():
            out = pd.DataFrame({"entry": list(held), "n": list(held.values()), "t": [bad[e] for e in held]})
            held.clear()
            bad.clear()
            return out

        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                found = {e for w in set(WORD.findall(text.lower())) for e in entries(w)}
                held.update(found)
                if y:
                    bad.update(found)
                if len(held) > 200_000:
                    yield rows()
        if held:
            yield rows()

    counts = (taught.select("y", text_or_empty("text").alias("text")).mapInPandas(count, "entry string, n long, t long")
              .groupBy("entry").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (size - toxic + 1))
    fixed = F.col("entry").isin(*HEADS)
    found = (counts.where(fixed | (F.col("t") >= SUPPORT) & (odds >= INFORMED))
             .orderBy(fixed.desc(), (F.col("t") * odds).desc(), "entry").limit(LEXICON + len(HEADS)).collect())
    return Lexicon({r.entry: (r.n, r.t) for r in found}, size, toxic)


def fit_default() -> Model:
    """The fixed lists alone, with small fixed weights: for a table without labels of both classes."""
    return Model(Lexicon(), np.array([0.0, 1.2, 0.6, 1.0]), -5.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 4, held: int = 2) -> Model:
    """Lexicon and weights from labelled rows outside the held-out fold, at most ``sample`` of them
    (those of the smallest hash of the doc_id).

    Rows without a doc_id or label teach nothing; of repeated labels and rows of a doc_id one is
    used. Without any labelled row, or without both classes, the lists have their prior and the weights are small fixed ones.
    """
    small_batches(docs.sparkSession)
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
             .where(F.pmod(doc_crc(), F.lit(folds)) != held).groupBy("doc_id").agg(F.max("y").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most ``sample`` documents, stored: read for the lexicon, then for the weights
    taught = store(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
                   .groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text"))
                   .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "taught")
    size, toxic = taught.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)), F.lit(0))).first()
    if toxic in (0, size):
        drop(taught)
        return fit_default()
    lexicon = learn_lexicon(taught, size, toxic)

    @F.pandas_udf("array<double>")
    def read(texts: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([features(t, lexicon, int(y > 0)) for t, y in zip(texts, ys)])

    rows = taught.select("y", read(text_or_empty("text"), F.col("y")).alias("x"), "doc_id").orderBy("doc_id").limit(sample).collect()
    drop(taught)
    w, b = logistic(np.array([r["x"] for r in rows]), np.array([r["y"] > 0 for r in rows], float))
    return Model(lexicon, w, b)


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return score


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, folds: int = 4,
                    held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted per input row.

    Null and empty texts have no match and so the score of a clean text; repeated rows score alike; a row
    without doc_id is scored (held_out by the crc of 0); other columns are ignored.
    """
    small_batches(docs.sparkSession)
    return (docs.select("doc_id", (F.pmod(doc_crc(), F.lit(folds)) == held).alias("held_out"),
                        scorer(model)(text_or_empty("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all its columns, whatever their names) without the rows that score at or above the threshold.

    Rows are judged one by one by their whole text, so repeated rows stay or go together and null ids are no obstacle; a null
    text counts as empty and scores as a text without any match; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    mark = "_".join(["toxicity", *docs.columns])  # no column has this name
    return docs.withColumn(mark, scorer(model)(text_or_empty("text"))).where(F.col(mark) < threshold).drop(mark)
