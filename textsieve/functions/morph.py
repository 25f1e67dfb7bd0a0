"""Term-level morphology: lemmatizing by dictionary join, Porter stemming.

Both work on a DataFrame of *distinct* terms (column ``term``) and return a
mapping ``(term, mapped)``, which callers join back to token positions. Each
distinct term is processed once, however often it occurs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve.functions.text import NOUN_DETACHMENT_RULES


def lemma_map(terms: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Noun lemmas by dictionary join. The candidates of a term are the term
    itself and what each detachment rule makes of it; those found in ``lexicon``
    (column ``term``) are kept and the shortest wins, the term itself first on
    ties. ``exceptions(form, lemma)`` rows take precedence when given.
    Returns ``(term, mapped)`` for terms that have a known form."""
    lex = lexicon.select(F.col("term").alias("cand")).distinct()
    rules = F.array(
        *[F.struct(F.lit(i + 1).alias("ord"), F.lit(end).alias("end"), F.lit(rep).alias("rep"))
          for i, (end, rep) in enumerate(NOUN_DETACHMENT_RULES)]
    )
    term = F.col("term")
    derived = F.transform(
        F.filter(rules, lambda r: term.endswith(r["end"])),
        lambda r: F.struct(
            r["ord"].alias("ord"),
            F.concat(term.substr(F.lit(1), F.length(term) - F.length(r["end"])), r["rep"]).alias("cand"),
        ),
    )
    t = terms.select("term").distinct()
    cands = t.select(
        "term",
        F.explode(F.concat(F.array(F.struct(F.lit(0).alias("ord"), term.alias("cand"))), derived)).alias("c"),
    ).select("term", "c.ord", "c.cand")
    hits = cands.join(lex, "cand", "left_semi")
    # shortest known candidate per term; the aggregate is a partial+final
    # min over one struct, so no window sort is needed
    best = hits.groupBy("term").agg(
        F.min(F.struct(F.length("cand").alias("len"), F.col("ord"), F.col("cand"))).alias("b")
    ).select("term", F.col("b.cand").alias("mapped"))
    if exceptions is not None:
        exc = exceptions.select(F.col("form").alias("term"), F.col("lemma").alias("exc"))
        best = (
            t.join(exc, "term", "left").join(best, "term", "left")
            .select("term", F.coalesce("exc", "mapped").alias("mapped"))
            .where(F.col("mapped").isNotNull())
        )
    return best


# --- Porter stemmer (Porter 1980, "An algorithm for suffix stripping") ------
#
# With the extensions that the reference's stemmer has on by default; ``extended=False`` is the published algorithm.

# Words that the extended stemmer maps as a whole.
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning",
    "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

_VOWELS = set("aeiou")


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        cons = _is_cons(stem, i)
        if cons and prev_vowel:
            m += 1
        prev_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str, extended: bool = False) -> bool:
    if extended and len(w) == 2:
        return not _is_cons(w, 0) and _is_cons(w, 1)
    if len(w) < 3:
        return False
    return (_is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2) and _is_cons(w, len(w) - 1)
            and w[-1] not in "wxy")


def _replace(w: str, rules, cond) -> str:
    for suf, rep in rules:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            return stem + rep if cond(stem) else w
    return w


# The suffix lists of steps 2-4 of the published algorithm.
_STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
          ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
          ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
          "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _plural(w: str, extended: bool) -> str:
    """Step 1a."""
    if extended and len(w) == 4 and w.endswith("ies"):
        return w[:-1]
    for end, cut in (("sses", 2), ("ies", 2), ("ss", 0), ("s", 1)):
        if w.endswith(end):
            return w[:len(w) - cut]
    return w


def _past(w: str, extended: bool) -> str:
    """Step 1b."""
    if extended and w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for end in ("ed", "ing"):
        if w.endswith(end):
            if not _has_vowel(w[:-len(end)]):
                return w
            w = w[:-len(end)]
            if w.endswith(("at", "bl", "iz")):
                return w + "e"
            if _double_cons(w):
                return w if w[-1] in "lsz" else w[:-1]
            return w + "e" if _measure(w) == 1 and _cvc(w, extended) else w
    return w


def _derived(w: str, extended: bool) -> str:
    """Step 2."""
    if extended and w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derived(w[:-2], extended)
    if extended and w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    rules = _STEP2 + [("bli", "ble"), ("fulli", "ful")] if extended else _STEP2 + [("abli", "able")]
    return _replace(w, rules, lambda s: _measure(s) > 0)


def porter_stem(word: str, extended: bool = True) -> str:
    w = word.lower()
    if extended and w in _IRREGULAR:
        return _IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _past(_plural(w, extended), extended)
    # step 1c
    if w.endswith("y"):
        stem = w[:-1]
        if (len(stem) > 1 and _is_cons(stem, len(stem) - 1)) if extended else _has_vowel(stem):
            w = stem + "i"
    w = _derived(w, extended)
    w = _replace(w, _STEP3, lambda s: _measure(s) > 0)
    # step 4
    for suf in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            if _measure(stem) > 1 and (suf != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    # step 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem, extended)):
            w = stem
    # step 5b
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


@F.pandas_udf(T.StringType())
def porter_stem_udf(terms: pd.Series) -> pd.Series:
    return terms.map(lambda s: None if s is None else porter_stem(s))


def stem_map(terms: DataFrame) -> DataFrame:
    """Stem each distinct term once (Arrow-batched pandas UDF)."""
    return terms.select("term").distinct().select("term", porter_stem_udf("term").alias("mapped"))
