import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from textsieve.llm import quality_model as qm
from textsieve.llm import quality_rules as qr

from .data import EDGES, documents, table

SF = "/root/testdata/sf0.01"


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = len(lines) - len(set(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_base_equals_brute_force(spark):
    rng = random.Random(2)
    rows = documents(5, 30, (0, 120)) + EDGES
    rows += [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(80))), "en", "a", 1) for i in range(20)]
    got = qr.judged(table(spark, rows, ["kept", "q", "base_failed", "n_words"])).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in got) == sorted((str(r[0]), *brute_base(r[1])) for r in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert qr.judged(table(spark, [])).collect() == []


def brute_class(c):
    """The class of a character, by its Unicode category."""
    kind = unicodedata.category(c)
    if c.isspace():
        return "space"
    if ord(c) >= 0x10000:
        return "letter" if c.isalpha() else "symbol"
    if c.islower():
        return "lower"
    if c.isupper():
        return "upper"
    if kind[0] == "L":
        return "letter"
    if c.isnumeric():
        return None
    if c in ".,;:!?\"'()-’‘“”«»…–—¿¡":
        return "punctuation"
    return "other" if kind in ("Cc", "Cf", "Cs", "Co", "Cn", "Zl", "Zp", "Zs") else "symbol"


def brute_histograms(text):
    classes = Counter(k for k in map(brute_class, text) if k)
    listed = {w for ws in qr.COMMON_WORDS.values() for w in ws}
    words = Counter(w if w in listed else None for w in
                    (w.lower().strip(".,;:!?\"'()") for w in re.findall(r"[^\x20\x09-\x0D]+", text)))
    return classes, words


def brute_distance(h, ref):
    """Jensen-Shannon distance of two histograms, by the definition."""
    n, m, total = sum(h.values()), sum(ref.values()), 0.0
    for k in {*h, *ref}:
        p, q = h.get(k, 0) / n, ref.get(k, 0) / m
        for x in (p, q):
            if x:
                total += x * math.log2(2 * x / (p + q)) / 2
    return math.sqrt(min(1, max(0, total)))


def brute_verdicts(rows):
    """``doc_id, kept, class distance, word distance`` of each row, learned from all of them."""
    refs, seen = {}, Counter()
    read = [(r, brute_base(r[1]), *brute_histograms(r[1] or "")) for r in rows]
    for (_, _, lang, *_), base, c, w in read:
        if base[-1] or 100 * c["symbol"] > 3 * sum(c.values()) or 4 * c["upper"] > c["upper"] + c["lower"]:
            continue
        lang = lang if lang in qr.LANGUAGES else ""
        seen[lang] += 1
        for own, h in zip(refs.setdefault(lang, (Counter(), Counter())), (c, w)):
            for k, n in h.items():
                own[k] += n / sum(h.values())
    if seen[""] < qr.MIN_OTHER_DOCS:
        refs.pop("", None)
    out = []
    for (i, t, lang, *_), base, c, w in read:
        pool = [v for k, v in refs.items() if k or lang not in qr.LANGUAGES]
        cd = min((brute_distance(c, v[0]) for v in pool), default=0) if len(t or "") >= 200 and c else 0
        wd = min((brute_distance(w, v[1]) for v in pool), default=0) if base[0] >= 300 else 0
        out.append((i, not base[-1] and cd <= qr.MAX_CLASS_DISTANCE and wd <= qr.MAX_WORD_DISTANCE, cd, wd))
    return out


def prose(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]


def junk(lang, n=5):
    rng = random.Random(4)
    say = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(2, 9)))
    return [(10**6 + i, " ".join(say() for _ in range(400)), lang, "s", 1) for i in range(n)]


def same_verdicts(spark, rows):
    got = {r.doc_id: r for r in qr.judged(table(spark, rows)).collect()}
    for i, kept, c, w in brute_verdicts(rows):
        assert got[i].kept == kept
        assert abs((got[i].class_distance or 0) - c) < 2e-4 and abs((got[i].word_distance or 0) - w) < 2e-4
    return got


def test_verdicts_equal_brute_force(spark, monkeypatch):
    rows = [(i, t, lang if i % 9 else ("it" if i % 2 else None), *r) for i, t, lang, *r in prose(spark) if len(t or "") < 6000]
    got = same_verdicts(spark, rows)
    assert any(r.kept for r in got.values()) and any(not r.kept and not r.base_failed for r in got.values())
    # other languages with a reference of their own
    monkeypatch.setattr(qr, "MIN_OTHER_DOCS", 5)
    same_verdicts(spark, rows)


def test_junk_does_not_approve_itself(spark):
    rows = [r for r in prose(spark) if len(r[1] or "") < 6000]
    for lang in ("en", None, "xx"):
        got = same_verdicts(spark, rows + junk(lang))
        assert not any(got[i].kept for i, *_ in junk(lang))
        assert all(got[i].word_distance > qr.MAX_WORD_DISTANCE for i, *_ in junk(lang))


def test_long_text_and_distance():
    words = qr.words_of("long line of words " * 3000)
    assert qr.n_repeated(words) == 12000 == len(words)
    assert qr.n_repeated([b"%d" % i for i in range(1000)]) == 0
    p = np.array([1.0, 3, 0])
    assert qr.distance(p, np.array([[0.25, 0.75, 0]])) == pytest.approx(0)
    assert qr.distance(p, np.array([[0, 0, 1.0]])) == pytest.approx(1)
    assert qr.class_counts("aB9 \U0001F600é!").sum() == 6


def test_verdicts_on_held_labels(spark):
    """No clean document of the given data is rejected by a distance, and no junk is kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = qr.judged(docs).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    passed = [r for r in rows if not r.base_failed]
    assert len(passed) > 200
    assert all(r.kept for r in passed if r.quality == 1)
    assert not any(r.kept for r in passed if r.quality == 0)


def test_model_on_held_out_documents(spark):
    out = qm.op2_quality_model(spark, SF)
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.97 and np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_are_not_used(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    x, y = qm.training_rows(docs, labels, max_rows=50)
    ids = sorted(r.doc_id for r in labels.where(~qm.held_out("doc_id")).collect())
    assert len(x) == len(y) == 50 and len(ids) > 50
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(qm.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    x2, y2 = qm.training_rows(docs, flipped, max_rows=50)
    assert (x == x2).all() and (y == y2).all()


def test_model_edges(spark):
    docs = table(spark, EDGES, ["score", "held_out"])
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = qm.scored(docs, qm.fit(*qm.training_rows(docs, none))).collect()
    assert len(rows) == len(EDGES) and all(r.score == 0.5 for r in rows)
    some = spark.createDataFrame([(1, 1), (2, 1), (5, None), (None, 0), (4, 1), (4, 1)], "doc_id long, quality int")
    model = qm.fit(*qm.training_rows(docs, some))
    assert all(0.5 < r.score < 1 for r in qm.scored(docs, model).collect())
    assert qm.scored(table(spark, []), model).collect() == []


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = qm.fit(x, y, rounds=30, pairs=1)
    assert list(model.pairs) == [(0, 1)]
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def brute_features(text):
    """The features of the additive model, by their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    if not n:
        return dict.fromkeys(qm.FEATURES, 0.0)
    classes, common = brute_histograms(text)
    chars = max(1, sum(classes.values()))
    letters = classes["lower"] + classes["upper"] + classes["letter"]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    sizes = [len(w.encode()) for w in words]
    part = lambda test: sum(1 for w in words if test(w)) / n
    return {
        "log_words": math.log1p(n), "word_length": sum(sizes) / n, "log_longest_word": math.log1p(max(sizes)),
        "lower": classes["lower"] / chars, "upper": classes["upper"] / letters if letters else 0.0,
        "digits": len(re.findall("[0-9]", text)) / len(text), "punctuation": classes["punctuation"] / chars,
        "symbols": classes["symbol"] / chars, "unusual": classes["other"] / chars,
        "words_with_letters": part(lambda w: not w.isascii() or re.search("[A-Za-z]", w)),
        "common_words": 1 - common[None] / n, "log_words_per_line": math.log1p(n / max(1, len(lines))),
        "duplicate_lines": 1 - len(set(lines)) / max(1, len(lines)), "repeated_windows": brute_base(text)[4] / n,
        "distinct_words": len(set(words)) / n, "top_word": max(Counter(words).values()) / n,
        "equal_neighbours": sum(a == b for a, b in zip(words, words[1:])) / n,
        "capitalised": part(lambda w: "A" <= w[0] <= "Z"), "sentence_ends": part(lambda w: w[-1] in ".?"),
        "exclamations": part(lambda w: w[-1] == "!")}


def test_features_equal_brute_force(spark):
    texts = [r[1] for r in prose(spark) if len(r[1] or "") < 6000][:120] + [r[1] for r in EDGES]
    texts += ["Wow! Wow! 12 12 ok? AB éa", "a b c", "a b c a b c", "# $ %\n\n#\n", "日本 日本. 😀 x"]
    for t in texts:
        want = brute_features(t)
        assert np.allclose(qm.features_of(t), [want[f] for f in qm.FEATURES], atol=1e-9), t


def test_score_equals_adding_up_the_tables():
    rng = np.random.default_rng(3)
    x = np.round(rng.random((600, 4)), 2)
    y = (x[:, 0] + (x[:, 1] > 0.5) * (x[:, 2] < 0.3) + 0.2 * rng.random(600) > 0.8).astype(float)
    model = qm.fit(x, y, rounds=20, pairs=3)
    got = model.score(x)
    assert len(model.pairs) == 3
    for row, score in zip(x.tolist(), got):
        at = [sum(e <= v for e in edges) for v, edges in zip(row, model.edges)]
        total = model.intercept + sum(t[k] for k, t in zip(at, model.tables))
        for (i, j), t in model.pairs.items():
            a, b = (at[k] * qm.PAIR_BINS // (len(model.edges[k]) + 1) for k in (i, j))
            total += t[a][b]
        assert score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
