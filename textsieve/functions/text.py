"""Text cleaning, tokenizing and surface features as Spark Column expressions.

Everything here is a built-in expression (regexp, translate, higher-order
array functions), so it runs inside whole-stage codegen with no Python UDF.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's behaviour for equal results.
# ---------------------------------------------------------------------------

# ASCII punctuation removed by the cleaner (Python's string.punctuation, 32 chars).
PUNCTUATION = string.punctuation

# Python's Unicode whitespace (str.isspace / re's \s), as one character class body.
# Java's and RE2's \s are ASCII-only, so the class is spelled out for both engines.
WHITESPACE_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# The same characters one by one.
WHITESPACE_CHARS = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
                    + "\u2028\u2029\u202f\u205f\u3000")

# URL pattern of the cleaner and of the url_count feature.
URL_PATTERN = r"https?://\S+|www\.\S+"
# Java's \S is "not ASCII whitespace"; use the Python set instead.
URL_PATTERN_EXACT = rf"https?://[^{WHITESPACE_CLASS}]+|www\.[^{WHITESPACE_CLASS}]+"

# HTML tag pattern <.*?> where '.' does not match a newline (Python default).
TAG_PATTERN = r"<[^\n]*?>"

# Word characters of the vectorizer's default token pattern (?u)\b\w\w+\b.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# English stop words of the word-level filter (NLTK's English list, 179 words).
NLTK_ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how all any "
    "both each few more most other some such no nor not only own same so than too very s t can will "
    "just don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn "
    "didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn "
    "mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()

# Word-tokenizer contraction splits that survive punctuation removal.
CONTRACTION_SPLITS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}

# Typographic quotes, which the word tokenizer makes tokens of their own. They are what is left of punctuation after
# cleaning, which removes the ASCII kind only.
TOKEN_QUOTES = "«“‘„»”’"

# Noun detachment rules of WordNet's morphy (ending, replacement), in order.
NOUN_DETACHMENT_RULES = [
    ("s", ""),
    ("ses", "s"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]

# ---------------------------------------------------------------------------


def _digit_class() -> str:
    """A class of the characters that count as digits beyond the decimal ones: superscripts, circled digits and the like
    (numeric type "digit"), from Python's own character table."""
    import sys

    cps = [c for c in range(0x80, sys.maxunicode + 1) if chr(c).isdigit() and not chr(c).isdecimal()]
    ranges: list[list[int]] = []
    for c in cps:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


DIGIT_PATTERN = rf"[\p{{Nd}}{_digit_class()}]"

# Spark ML's default English stop list (what ``StopWordsRemover`` loads), in its own order.
SPARK_ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
could here's how's let's ought that's there's what's when's where's who's why's would
""".split())


def spark_english_stop_words() -> tuple[str, ...]:
    return SPARK_ENGLISH_STOP_WORDS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Lower, strip URLs, tags, ASCII punctuation, digits; collapse whitespace.
    A null becomes ''. Punctuation goes and whitespace becomes spaces in one pass, so that only runs of two spaces or
    more are left to a pattern: a class of all whitespace, matched at every word, took longer than all other steps."""
    t = F.lower(F.coalesce(_col(c), F.lit("")))
    t = F.regexp_replace(t, URL_PATTERN_EXACT, "")
    t = F.regexp_replace(t, TAG_PATTERN, "")
    t = F.translate(t, WHITESPACE_CHARS + PUNCTUATION, " " * len(WHITESPACE_CHARS))
    t = F.regexp_replace(t, r"\p{Nd}+", "")
    t = F.regexp_replace(t, " {2,}", " ")
    return F.trim(t)


def tokenize(cleaned) -> Column:
    """Word tokens of a cleaned text (single-space separated), with the
    tokenizer's contraction splits; typographic quotes are tokens of their own."""
    spaced = F.regexp_replace(_col(cleaned), f"([{TOKEN_QUOTES}])", " $1 ")
    toks = F.filter(F.split(spaced, " "), lambda t: t != "")
    return F.flatten(F.transform(toks, _split_contraction))


def _split_contraction(t: Column) -> Column:
    expr = None
    for word, parts in CONTRACTION_SPLITS.items():
        arr = F.array(*[F.lit(p) for p in parts])
        expr = F.when(t == word, arr) if expr is None else expr.when(t == word, arr)
    return expr.otherwise(F.array(t))


def remove_stopwords(tokens, words=None) -> Column:
    """Exact, case-sensitive removal (default: NLTK's English list)."""
    words = list(NLTK_ENGLISH_STOP_WORDS if words is None else words)
    if not words:
        return _col(tokens)
    return F.filter(_col(tokens), lambda t: ~t.isin(words))


def join_tokens(tokens) -> Column:
    """T12."""
    return F.array_join(_col(tokens), " ")


def analyzer_terms(c, stop_words=None, lowercase: bool = True) -> Column:
    """V1: the vectorizer's analyzer: lower-case, words of two or more word
    characters, minus the stop list."""
    t = F.coalesce(_col(c), F.lit(""))
    if lowercase:
        t = F.lower(t)
    terms = F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        terms = F.filter(terms, lambda x: ~x.isin(list(stop_words)))
    return terms


# --- surface features (T14-T21) ---------------------------------------------

def _as_text(c) -> Column:
    return F.coalesce(_col(c), F.lit("None"))


def text_length(c) -> Column:
    return F.length(_as_text(c))


def word_count(c) -> Column:
    return F.regexp_count(_as_text(c), F.lit(f"[^{WHITESPACE_CLASS}]+"))


def special_char_count(c) -> Column:
    return F.regexp_count(_as_text(c), F.lit(rf"[^\p{{L}}\p{{N}}_{WHITESPACE_CLASS}]"))


def uppercase_count(c) -> Column:
    return F.regexp_count(_as_text(c), F.lit(r"\p{IsUppercase}"))


def digit_count(c) -> Column:
    return F.regexp_count(_as_text(c), F.lit(DIGIT_PATTERN))


def url_count(c) -> Column:
    return F.regexp_count(_as_text(c), F.lit(URL_PATTERN_EXACT))


def surface_features(df: DataFrame, text_col: str = "message", keep=("row_id",)) -> DataFrame:
    """The seven surface features in one projection (one pass, codegen)."""
    tl = text_length(text_col)
    wc = word_count(text_col)
    return df.select(
        *[F.col(k) for k in keep if k in df.columns],
        tl.cast("bigint").alias("text_length"),
        wc.cast("bigint").alias("word_count"),
        (tl / (wc + 1)).cast("double").alias("char_per_word"),
        special_char_count(text_col).cast("bigint").alias("special_char_count"),
        uppercase_count(text_col).cast("bigint").alias("uppercase_count"),
        digit_count(text_col).cast("bigint").alias("digit_count"),
        url_count(text_col).cast("bigint").alias("url_count"),
    )


# --- composite preprocessing (T13) ------------------------------------------

def preprocess_tokens(c, remove_stop: bool = True, stop_words=None) -> Column:
    toks = tokenize(clean_text(c))
    if remove_stop:
        toks = remove_stopwords(toks, stop_words)
    return toks


def preprocess_text(
    df: DataFrame,
    text_col: str = "message",
    out_col: str = "preprocessed_text",
    id_col: str = "row_id",
    remove_stop: bool = True,
    stemming: bool = False,
    lemmatization: bool = True,
    lexicon: DataFrame | None = None,
    stop_words=None,
) -> DataFrame:
    """Clean -> tokenize -> [stop words] -> [stem, else lemmatize] -> join.

    Stemming and lemmatization work on the distinct terms (one row per term),
    and the per-term result is joined back to the token positions. The tokens
    are made once and written to the checkpoint folder with their rows.
    ``lexicon`` (column ``term``) is the set of known base forms; when absent,
    the distinct terms of ``df`` itself are used.
    """
    toks = preprocess_tokens(text_col, remove_stop, stop_words)
    if not stemming and not lemmatization:
        return df.withColumn(out_col, join_tokens(toks))

    from textsieve.functions.morph import lemma_map, stem_map
    from textsieve.session import write_table

    endings = None if stemming else [end for end, _ in NOUN_DETACHMENT_RULES]
    base = write_table(df.withColumn("_toks", toks))

    def may_change(t):
        """Stems may differ from any word; a lemma only from one with an ending of the rules."""
        return F.lit(True) if endings is None else functools.reduce(lambda a, e: a | t.endswith(e), endings, F.lit(False))

    # one row per document and distinct word that may change, not one per occurrence; only changes come back
    words = base.select(F.col(id_col), F.explode(F.array_distinct(F.filter("_toks", may_change))).alias("term"))
    terms = words.select("term").distinct()
    if stemming:
        mapping = stem_map(terms)
    else:
        lex = lexicon if lexicon is not None else base.select(F.explode(F.array_distinct("_toks")).alias("term")).distinct()
        mapping = lemma_map(terms, lex)
    mapping = mapping.where("mapped <> term")
    changed = words.join(mapping, "term").groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "mapped"))).alias("_map"))
    joined = base.join(changed, id_col, "left")
    out = F.transform("_toks", lambda t: F.coalesce(F.col("_map")[t], t))
    return joined.withColumn(
        out_col, F.when(F.col("_map").isNull(), join_tokens(F.col("_toks"))).otherwise(F.array_join(out, " "))
    ).drop("_toks", "_map")
