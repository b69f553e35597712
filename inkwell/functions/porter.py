"""Porter stemmer in the mode that ROUGE tools use.

The published algorithm (M. F. Porter, "An algorithm for suffix stripping", 1980) with the
extensions of the NLTK library's default mode: a short list of irregular words; ``ies``/``ied`` of
four-letter words become ``ie``; a final y becomes i only after a consonant that is not the
word's first letter; a two-letter vowel-consonant stem counts as consonant-vowel-consonant; ``alli`` is
rewritten before step 2 goes on; ``fulli`` becomes ``ful``; and the l of ``logi`` belongs to
the stem. ``rouge_stem`` leaves words of up to three letters as they are, as the ROUGE
tools do.
"""

from __future__ import annotations

_VOWELS = frozenset("aeiou")


def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in _VOWELS:
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _cons(stem, i):
            i += 1
        if i >= n:
            break
        while i < n and _cons(stem, i):
            i += 1
        m += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) == 2:
        return not _cons(w, 0) and _cons(w, 1)
    if len(w) < 3:
        return False
    return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
            and w[-1] not in "wxy")


def _rule_step(w: str, rules, min_m: int) -> str:
    """Apply the first (longest listed) matching suffix rule if the stem's m > min_m."""
    for suf, rep in rules:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            return stem + rep if _measure(stem) > min_m else w
    return w


# fixed values: irregular words
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed",
    "succeed": "succeed",
}

# fixed values: suffix rules of steps 2, 3 and 4 (suffix, replacement), longest first per ending
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
)
_STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _longest_first(rules):
    return tuple(sorted(rules, key=lambda r: -len(r[0] if isinstance(r, tuple) else r)))


_STEP2_L = _longest_first(_STEP2)
_STEP3_L = _longest_first(_STEP3)
_STEP4_L = _longest_first(_STEP4)


def rouge_stem(word: str) -> str:
    """The stem of a ROUGE token; short tokens stand for themselves."""
    return stem(word) if len(word) > 3 else word


def _step2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step2(w[:-2])
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _rule_step(w, _STEP2_L, 0)


def stem(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("ied"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w):
            if w[-1] not in "lsz":
                w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and len(w) > 2 and _cons(w, len(w) - 2):
        w = w[:-1] + "i"
    # steps 2 and 3
    w = _step2(w)
    w = _rule_step(w, _STEP3_L, 0)
    # step 4
    for suf in _STEP4_L:
        if w.endswith(suf):
            stem_ = w[: len(w) - len(suf)]
            if _measure(stem_) > 1 and (suf != "ion" or (stem_ and stem_[-1] in "st")):
                w = stem_
            break
    # step 5a
    if w.endswith("e"):
        s = w[:-1]
        m = _measure(s)
        if m > 1 or (m == 1 and not _cvc(s)):
            w = s
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w
