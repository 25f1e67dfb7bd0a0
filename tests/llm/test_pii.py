import re

from textsieve.llm import pii

from .data import EDGES, documents, table

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for n, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), n, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


TEXTS = [
    "é🙂 mail a.b+c%d@x-y.co.uk, then a@b.c_d@e.f.. and bad@host and @x.y", "a@b.c.d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.004 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 and 4111111111111111 5 5", "+1 (212) 555-0123 and +44 20 7946 0958. +123 ++49 30 1234567890",
    "x" * 5000 + "@" + "y" * 3000 + ".com", "1 " * 4000, "." * 3000 + "@a.b", "9.9.9.9." * 2000, "+1" + "(" * 5000, "a.b" * 3000,
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x', "call 212-555-0187 now", "write to jane [at] example [dot] com", "SSN 123-45-6789",
    "DE89 3704 0044 0532 0130 00 is an account", "999999999999999999999999999.1.1.1", "+1 234 567 890\n+1 234 567 8901",
]


def test_base_equals_brute_force(spark):
    rows = EDGES + documents(6, 10) + [(100 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    out = pii.find_personal_data(table(spark, rows, ["spans", "found", "b"]))
    from pyspark.sql import functions as F

    got = out.select("doc_id", pii.written(F.filter("spans", lambda c: c["base"])).alias("base"), pii.written(F.col("spans")).alias("all")).collect()
    assert sorted((str(r.doc_id), r.base) for r in got) == sorted((str(i), brute(t)) for i, t, *_ in rows)
    for r in got:  # base spans stay
        assert set(filter(None, r.base.split(","))) <= set(r["all"].split(","))
    by = {r.doc_id: r["all"] for r in got if r.doc_id and r.doc_id >= 100}
    assert by[111] == "secret:0:50" and by[113].startswith("masked_email:9:")
    assert pii.find_personal_data(table(spark, [])).collect() == []


def test_clean_prose_has_no_spans(spark):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate([
        "The year 2024 had 366 days, and 12 of 30 people came.", "Chapter 3.2.1 says so; see pages 100-200.", "at the dot of the line, mail was late"])]
    assert all(r.spans == [] for r in pii.find_personal_data(table(spark, rows)).collect())


def test_labelers_and_classifier_learn_from_votes():
    right = lambda *v: sum((x + 1) * 3 ** (2 - i) for i, x in enumerate(v))
    counts = [(4, right(1, 1, 0), 1, 1, 500.0), (4, right(-1, -1, 0), 0, 0, 500.0), (4, right(1, 0, -1), 1, 1, 20.0), (4, right(0, -1, 0), 0, 1, 50.0)]
    model = pii.fit_labelers(counts)
    assert model["posterior"][4, right(1, 1, 0)] > 0.9 > 0.1 > model["posterior"][4, right(-1, -1, 0)]
    w = pii.fit_classifier(counts, model["posterior"])
    assert w @ pii._features(4, right(1, 1, 0), 1, 1) > 0 > w @ pii._features(4, right(-1, -1, 0), 0, 0)
    assert pii.fit_labelers([])["posterior"] == {} and not pii.fit_classifier([], {}).any()


def test_plan_is_native(spark):
    df = pii.find_personal_data(table(spark, documents(1, 5)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
