import itertools
import random
import re

from textsieve.llm import filter_audit as A

from .data import EDGES, table


def brute(rows, labels):
    """Every order run over every row."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    firsts = {}
    for i, t, *_ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    fails = []
    for i, t, _, source, _ in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(ws) < 200:
            f.add("A")
        if 100 * len(set(ws)) < 50 * len(ws):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            f.add("C")
        if re.search(r"[#$%&*|]", t):
            f.add("D")
        if i is not None and firsts[t] < i:
            f.add("E")
        fails.append((i, source or "", f))
    out = {}
    for part in {p for _, p, _ in fails}:
        own = [(i, f) for i, p, f in fails if p == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                here = [(i, f) for i, f in left if x in f]
                stay = [(i, f) for i, f in left if x not in f]
                out[part, "".join(order), step] = [
                    len(stay), len(here), sum(x in f for _, f in own) - len(here), sum(f == {x} for _, f in own),
                    sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
                left = stay
    shapley = {}
    for (part, order, step), v in out.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + v[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(spark, rows, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = table(spark, rows, ["part", "mask", "h1", "n", "steps", "filter"])
    got = A.filter_audit(docs, marks).collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in got}
    assert len(out) == len(got)
    return out


def mixed_rows(n=70):
    rng = random.Random(3)
    texts = []
    for i in range(n):
        words = [f"w{rng.randrange(400 if i % 3 else 20)}" for _ in range(rng.choice([10, 210, 300]))]
        t = " ".join(words)
        if i % 4 == 0:
            t = t.upper()
        if i % 5 == 0:
            t += rng.choice(["#", " $x", "|", "*", "%", "&", " - + @"])
        texts.append(t if i % 6 or not texts else rng.choice(texts))
    return [(rng.randrange(n), t, "en", rng.choice(["a", "b", "", None]), 1) for t in texts]


def test_equals_running_every_order(spark):
    rows = mixed_rows()
    labels = [(i, i % 4 // 2, int(i % 3 == 0)) for i in range(0, 70, 2)]
    got = run(spark, rows, labels)
    assert got == brute(rows, labels)
    assert len(got) == 600 * 3 and any(v[4] for v in got.values()) and any(v[2] for v in got.values())


def test_edges(spark):
    labels = [(4, 1, None), (4, 0, 1), (None, 1, 1), (5, None, None), (99, 1, 1)]
    # copies of one id, of null ids, of the empty text and across parts
    rows = EDGES + [(3, "a null id", "en", "z", 1), (20, "a null id", "en", "c", 1), (0, "", "en", None, 0)]
    assert run(spark, rows, labels) == brute(rows, labels)
    assert run(spark, [], labels) == {}
    assert A.filter_audit(table(spark, EDGES)).where("good_lost > 0 or toxic_lost > 0").count() == 0


def test_the_plan_is_native(spark):
    plan = A.filter_audit(table(spark, EDGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
