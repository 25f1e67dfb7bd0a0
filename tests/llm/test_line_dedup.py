from textsieve.llm import line_dedup

from .data import EDGES, documents, table

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, least_chars=20, least_docs=3):
    holders = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(i)
    common = {k: max((i for i in h if i is not None), default=None) for k, h in holders.items() if len(h) >= least_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in common or (i is not None and i >= common[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = line_dedup.line_dedup(table(spark, rows, ["n_lines", "gone", "id", "h1", "lines"]), **options)
    assert [c for c in df.columns if c in ("gone", "id", "h1", "lines")] == ["gone", "id", "h1", "lines"]
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    rows = documents(1, 50)
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[2] for r in got) > 5


def test_edges(spark):
    rows = EDGES + [(20 + i, "x\n" + EDGES[4][1], "en", "a", 1) for i in range(3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    # a repeated id is one document
    twice = [(1, "a line that is long enough", "en", "a", 1)] * 3
    assert run(spark, twice) == brute(twice) and run(spark, twice)[0][2] == 0
    # equal hashes of equal keys only: lines of another case and with other white space share a key
    three = [(i, t, "en", "a", 1) for i, t in enumerate(["  Some Shared Line Here\t", "some shared line here", "SOME SHARED LINE HERE\r"])]
    assert [r[2] for r in run(spark, three)] == [1, 1, 0]


def test_rows_of_one_id_lose_their_own_lines(spark):
    shared = "a line that several documents share"
    others = [(i, shared, "en", "a", 1) for i in (8, 9, 10)]
    for i in (5, None):
        rows = [(i, f"{shared}\nown text of one row", "en", "a", 1), (i, f"own text of the other\n{shared}", "en", "a", 1)] + others
        got = run(spark, rows)
        assert got == brute(rows)
        mine = sorted(r[2:] for r in got if r[0] == i)
        assert mine == [(1, "own text of one row"), (1, "own text of the other")]
    # many null ids: one document, each row with its own lines
    rows = [(None, f"row {k}\n" * (k % 3) + shared + f"\nthe end of row number {k}", "en", "a", 1) for k in range(12)] + others
    assert run(spark, rows) == brute(rows)


def test_plan_is_native(spark):
    df = line_dedup.line_dedup(table(spark, documents(1, 5)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
