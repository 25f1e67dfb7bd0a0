import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from textsieve.llm import collocations as C

from .data import EDGES, table


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def brute(rows, min_count, longest=5, top=2000):
    f, n = {}, {}
    for _, t, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t or "")):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] = n.get(lang, 0) + len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    key = lang, tuple(ws[i:i + k])
                    f[key] = f.get(key, 0) + 1
    cand = {k: v for k, v in f.items() if v >= min_count and len(k[1]) > 1}
    inside = {}
    for (lang, p), a in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                key = lang, p[i:i + k]
                inside[key] = max(a, inside.get(key, 0))
    out = {}
    for (lang, p), a in cand.items():
        if 100 * inside.get((lang, p), 0) >= 100 * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return [(lang, r, p.decode(), -a, x, y, z, -s) for lang, v in sorted(out.items())
            for r, (s, a, p, x, y, z) in enumerate(sorted(v)[:top], 1)]


def run(spark, rows, **options):
    docs = table(spark, rows, ["phrase", "rank", "unit", "n", "t"])
    got = C.collocations(docs, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def some_rows(n=150, seed=5):
    rng = random.Random(seed)
    phrases = ["New York Times", "the city of light", "straße Été", "a b a b a", "日本 語 の"]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(rng.randrange(40)):
            ws.append(rng.choice(phrases) if rng.random() < .3 else rng.choice(["the", "of", "a", "x", "Y", "é"]))
            ws.append(rng.choice([" ", "  ", "\t", ", ", ". ", "\n", "\r\n", " ; ", "!", "\x0b", "\xa0", ""]))
        rows.append((i, "".join(ws), rng.choice(["en", "en", "de", None, "und", ""]), "s", 1))
    return rows


def test_equals_brute_force(spark):
    rows = some_rows()
    want = brute(rows, 8)
    assert run(spark, rows, min_count=8) == sorted(want) and len(want) > 60
    # many partitions with small summaries, and a short list
    assert run(spark, rows, min_count=8, partition_mass=200, top=5) == sorted(brute(rows, 8, top=5))
    assert run(spark, rows, min_count=3, partition_mass=64, longest=3) == sorted(brute(rows, 3, 3))


def test_edges(spark):
    rows = EDGES + [(20, "a a a a a a a", "en", "s", 1), (21, "A a. a,a", None, "s", 1), (22, ". , ;", "de", "s", 1)]
    assert run(spark, rows, min_count=2) == sorted(brute(rows, 2))
    assert run(spark, [], min_count=1) == []
    assert run(spark, [EDGES[0], EDGES[1]]) == []


def test_scores_beyond_64_bits(spark):
    f = spark.createDataFrame([("en", "a b", 2, 3 * 10**12), ("en", "a", 1, 3 * 10**12 + 7), ("en", "b", 1, 4 * 10**12)],
                              "lang string, phrase string, k int, f long")
    n = 10**15 + 1
    got = C.scored(f, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert got.score == 1000 * 3 * 10**12 * n // ((3 * 10**12 + 7) * 4 * 10**12)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), min_size=1, max_size=30), max_size=12), st.integers(1, 30))
def test_summaries_lose_no_frequent_key(parts, threshold):
    true = {}
    for p in parts:
        for k, c in p:
            true[k] = true.get(k, 0) + c
    mass = sum(true.values())
    whole = C.MisraGries(mass // threshold + 1)
    for p in parts:
        # a summary of each part, merged into one
        own = C.MisraGries(whole.capacity)
        own.merge(np.array([k for k, _ in p], np.uint64), np.array([c for _, c in p], np.int64))
        whole.merge(own.keys, own.counts)
        whole.error += own.error
    assert len(whole.keys) <= whole.capacity and whole.error * whole.capacity <= mass
    kept = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
    assert all(kept.get(k, 0) <= c <= kept.get(k, 0) + whole.error for k, c in true.items())
    assert {k for k, c in true.items() if c >= threshold} <= set(whole.may_reach(threshold).tolist())
