"""Quality rules by distribution divergence.

Two histograms of a document, of character classes and of common words, are
compared with language references by Jensen-Shannon distance. The references
are the mean histograms of all documents of a language, summed over the whole
table as integers, so they do not depend on how the rows are dealt. Documents
below a minimum length are not judged by a histogram.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import own, read, text_batches, with_results

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in is that for it with as was on be at by this had are or not but from they which you".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya".split(),
}
LANGUAGES = tuple(COMMON_WORDS)
WORD_BIN = {w: i for i, w in enumerate(sorted({w for ws in COMMON_WORDS.values() for w in ws}))}
OTHER_WORD = len(WORD_BIN)
#: Stripped from a word before it is looked up.
AROUND = ".,;:!?\"'()"

SYMBOLS = b"#*$%&|<>"
#: Character classes, in this order: lower case, upper case, other letters, white space, sentence punctuation, symbols,
#: control and everything else; the last, digits, is counted and left out of the histogram, as numbers have no language.
CLASSES = ("lower", "upper", "letter", "space", "punctuation", "symbol", "other", "digit")
N_CLASSES = len(CLASSES) - 1

#: A histogram entry counts as this many units of the whole when histograms are summed.
UNITS = 1 << 20

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Other and null languages have a reference of their own only where it rests on so many documents.
MIN_OTHER_DOCS = 1_000
#: Guards: a histogram of fewer characters or words is not judged.
MIN_CHARS, MIN_HIST_WORDS = 200, 300
#: Verdicts: the largest Jensen-Shannon distance (0 to 1) to the nearest language reference that is still prose.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.13, 0.27


def _class_table() -> np.ndarray:
    """Class of each code point of the basic plane."""
    table = np.full(0x10000, CLASSES.index("other"), dtype=np.uint8)
    for cp in range(0x10000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        if c.isspace():
            k = "space"
        elif c.islower():
            k = "lower"
        elif c.isupper():
            k = "upper"
        elif c.isalpha():
            k = "letter"
        elif c.isnumeric():
            k = "digit"
        elif c in ".,;:!?\"'()-’‘“”«»…–—¿¡":
            k = "punctuation"
        elif c.isprintable():
            k = "symbol"
        else:
            k = "other"
        table[cp] = CLASSES.index(k)
    return table


_TABLE: list[np.ndarray] = []


def class_counts(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_class_table())
    counts = np.zeros(len(CLASSES), dtype=np.int64)
    for at in range(0, len(text), 1 << 20):
        cps = np.frombuffer(text[at:at + (1 << 20)].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        wide = cps >= 0x10000
        counts += np.bincount(_TABLE[0][np.where(wide, 0xE000, cps)], minlength=len(CLASSES))
        if wide.any():
            beyond = Counter(CLASSES.index("letter" if chr(c).isalpha() else "symbol") for c in cps[wide].tolist())
            for k, n in beyond.items():
                counts[k] += n
            counts[CLASSES.index("other")] -= int(wide.sum())
    return counts[:N_CLASSES]


def word_counts(words: list[bytes]) -> np.ndarray:
    counts = np.zeros(OTHER_WORD + 1, dtype=np.int64)
    for w, n in Counter(words).items():
        counts[WORD_BIN.get(w.decode("utf-8", "surrogatepass").lower().strip(AROUND), OTHER_WORD)] += n
    return counts


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def n_repeated(words: list[bytes], window: int = 3) -> int:
    """Words in windows of ``window`` words that are found twice or more, first ones included."""
    if len(words) <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    if len(seen) == len(words):
        return 0
    key = ids
    for i in range(1, window):
        # fold pairs into small numbers again, so the next product fits in 64 bits
        pair = key[:-1] * len(seen) + ids[i:]
        _, key, counts = np.unique(pair, return_inverse=True, return_counts=True)
    twice = counts[key] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(window):
        covered[i:i + len(twice)] |= twice
    return int(covered.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode("utf-8", "surrogatepass")
    chars = len(text) - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), chars, sum(raw.count(bytes([s])) for s in SYMBOLS), dup, n_repeated(words)


def distance(p: np.ndarray, refs: np.ndarray) -> float:
    """Least Jensen-Shannon distance (base 2) of a histogram to rows of ``refs``."""
    if not p.sum():
        return 1.0
    p = p / p.sum()
    m = (p + refs) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda a: np.where(a > 0, a * np.log2(a / m), 0).sum(axis=1)
        js = (kl(np.broadcast_to(p, refs.shape)) + kl(refs)) / 2
    return float(np.sqrt(np.clip(js, 0, 1)).min())


def plain(classes: np.ndarray) -> bool:
    """Whether a text is ordinary enough to teach a reference: few symbols, mostly lower case."""
    symbols, upper, lower = (classes[CLASSES.index(c)] for c in ("symbol", "upper", "lower"))
    return 100 * symbols <= 3 * classes.sum() and 4 * upper <= upper + lower


def base_fails(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                        languages=LANGUAGES) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean class and word histograms of each language, over all documents that pass the base rule and are plain. Other and
    null languages make one reference of their own, under ``""``, if it rests on ``MIN_OTHER_DOCS`` documents. So the result
    is ``len(languages) + 1`` rows of fixed width at most."""
    @F.pandas_udf("array<long>")
    def units(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            words = words_of(t or "")
            if not words or base_fails(len(words), n_repeated(words)):
                out.append(None)
                continue
            classes = class_counts(t)
            if not plain(classes):
                out.append(None)
                continue
            both = [np.rint(h * (UNITS / max(1, h.sum()))).astype(np.int64) for h in (classes, word_counts(words))]
            out.append(np.concatenate([*both, [1]]))
        return pd.Series(out)

    lang = F.when(F.col(lang_col).isin(*languages), F.col(lang_col)).otherwise(F.lit(""))
    # the sums by bin combine map-side: a few rows leave each task
    # declared nondeterministic, or the filter below would be pushed down and run it a second time
    sums = (text_batches(docs).select(lang.alias("lang"), units.asNondeterministic()(F.col(text_col)).alias("h")).where("h is not null")
            .select("lang", F.posexplode("h").alias("bin", "n")).groupBy("lang", "bin").agg(F.sum("n").alias("n")))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["lang"], np.zeros(N_CLASSES + OTHER_WORD + 2))[r["bin"]] = r["n"]
    if "" in out and out[""][-1] < MIN_OTHER_DOCS:
        del out[""]
    share = lambda v: v / v.sum()
    return {k: (share(v[:N_CLASSES]), share(v[N_CLASSES:-1])) for k, v in sorted(out.items())}


def with_verdict(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", references=None,
                 max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """``docs`` with a struct ``_llm_quality`` of all that ``judged`` tells."""
    refs = language_references(docs, text_col, lang_col) if references is None else references
    # the reference of other languages judges nothing but documents of other languages
    known = [v for k, v in refs.items() if k]
    pools = [[np.array([r[i] for r in pool]) for i in (0, 1)] for pool in (known, [*known, *[refs[k] for k in refs if not k]])]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance",
             "word_distance", "kept"]

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                  "base_failed boolean, class_distance double, word_distance double, kept boolean")
    def judge(texts: pd.Series, other: pd.Series) -> pd.DataFrame:
        rows = []
        for t, o in zip(texts, other):
            t = t or ""
            class_refs, word_refs = pools[int(o)]
            words = words_of(t)
            base = base_counts(t, words)
            failed = base_fails(base[0], base[4])
            cd = distance(class_counts(t), class_refs) if len(class_refs) and len(t) >= MIN_CHARS else None
            wd = distance(word_counts(words), word_refs) if len(word_refs) and len(words) >= MIN_HIST_WORDS else None
            kept = not (failed or (cd or 0) > max_class_distance or (wd or 0) > max_word_distance)
            rows.append((*base, failed, cd, wd, kept))
        return pd.DataFrame(rows, columns=names).astype({"class_distance": float, "word_distance": float})

    # declared nondeterministic, or a caller's filter on the verdict would run it a second time
    other = ~F.coalesce(F.col(lang_col).isin(*LANGUAGES), F.lit(False))
    return text_batches(docs).select("*", judge.asNondeterministic()(F.col(text_col), other).alias(own("quality")))


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``class_distance``, ``word_distance`` and ``kept``.

    ``references`` is what ``language_references`` returns (learned from ``docs`` if not given). A document is
    compared with every language and the nearest counts, so a wrong or null language does no harm; one of another or
    null language also with the reference of these, if there is one. Distances below
    the guards (``MIN_CHARS`` characters, ``MIN_HIST_WORDS`` words) or without any reference are null and reject
    nothing. Null and empty texts have no words and fail the base rule. Rows are judged one by one; an empty table
    gives an empty table.
    """
    df = with_verdict(docs, text_col, lang_col, **options)
    q = F.col(own("quality"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return with_results(df, docs.columns, {
        **{n: q.getField(n) for n in names},
        **{n: F.when(~F.isnan(q.getField(n)), q.getField(n)) for n in ("class_distance", "word_distance")},
        "kept": q.getField("kept")})


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: base counts, base verdict, distances and the final verdict."""
    out = judged(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "class_distance", "word_distance")


QUERIES = {"op4_quality_rules": op4_quality_rules}
ORACLES: dict[str, str] = {}
