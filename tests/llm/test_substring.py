import re

from textsieve.llm import substring_dedup

from .data import EDGES, documents, table


def brute(rows, window):
    first = {}
    split = [(i if i is not None else 1 << 62, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    for i, ws in split:
        for k in range(len(ws) - window + 1):
            w = tuple(ws[k:k + window])
            first[w] = min(i, first.get(w, i))
    out = []
    for (i, ws), r in zip(split, rows):
        gone = set()
        for k in range(len(ws) - window + 1):
            if first[tuple(ws[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((str(r[0]), len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out)


def run(spark, rows, **options):
    got = substring_dedup.substring_dedup(table(spark, rows, ["src", "block", "data", "n_words"]), **options).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got)


def test_equals_brute_force(spark):
    rows = documents(7, 60)
    got = run(spark, rows)
    assert got == brute(rows, 13) and sum(r[2] for r in got) > 100
    # many small units give the same
    assert run(spark, rows, unit_words=50, window=5) == brute(rows, 5)


def test_edges(spark):
    rows = EDGES + [(30, EDGES[9][1][:2000], "en", "a", 1)]
    assert run(spark, rows) == brute(rows, 13)
    assert run(spark, []) == []
