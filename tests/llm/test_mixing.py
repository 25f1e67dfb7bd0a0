import hashlib

import duckdb
import pytest

from textsieve.llm import mixing

from .data import EDGES, documents, table


def brute(rows, weights=(5, 2, 1), most=3):
    """id -> (size, source_size, target, copies) for rows with distinct ids."""
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in sources}
    weight = {s: weights[i % 3] for i, s in enumerate(sources)}
    target, free, left = {}, set(sources), sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] >= most * total[s]]
        for s in over or free:
            target[s] = most * total[s] if over else level * weight[s]
        left -= sum(target[s] for s in (over or free))
        free -= set(over or free)
    queue = []
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]))
        done = 0
        for c in range(most):
            for r in own:
                done += size[r[0]]
                queue.append(((done / target[s] if target[s] else 0, s is None, s or "", c, hashlib.md5(str(r[0]).encode()).hexdigest()), r[0]))
    copies, sent = dict.fromkeys(size, 0), 0
    for _, i in sorted(queue):
        sent += size[i]
        copies[i] += sent <= sum(total.values())
    return {r[0]: (size[r[0]], total[r[3]], target[r[3]], copies[r[0]]) for r in rows}


def test_equals_brute_force(spark):
    rows = documents(2, 80, (1, 60))
    want = brute(rows)
    got = mixing.mix(table(spark, rows, ["size", "k", "e", "rows"])).collect()
    assert len(got) == len(rows)
    for r in got:
        size, source_size, target, copies = want[r.doc_id]
        assert (r.size, r.source_size, r.copies, r.taken) == (size, source_size, copies, size * copies)
        assert r.target == pytest.approx(target) and r.rows == "mine"
    # near the targets: within a document of each source
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) + 1
    out = mixing.mixed_documents(table(spark, rows, ["copies"]))
    assert out.columns[-1] == "copies"
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, w in want.items() for _ in range(w[3]))


def test_edges(spark):
    got = mixing.mix(table(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    assert all(r.taken == r.size * r.copies and 0 <= r.copies <= 3 for r in got)
    assert sum(r.taken for r in got) <= sum(r.size for r in got)
    same = [r.copies for r in got if r.doc_id == 4]
    assert len(same) == 2 and abs(same[0] - same[1]) <= 1
    again = mixing.mix(table(spark, list(reversed(EDGES)))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(table(spark, [])).collect() == []
    assert mixing.mixed_documents(table(spark, [])).collect() == []
    # only texts without words
    assert all(r.taken == 0 for r in mixing.mix(table(spark, EDGES[:3])).collect())


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.ORACLE})").fetchall()}
    got = mixing.op7_mixing(spark, sf).collect()
    assert len(got) == len(want)
    assert all((r.size, r.source_size, pytest.approx(r.target), r.taken) == want[r.doc_id] for r in got)
