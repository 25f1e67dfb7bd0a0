"""Personal data by weak supervision. Built-in functions only.

Base spans come from fixed patterns and checks and always stay. Wider patterns
propose further candidates. Labelers - pattern shape, gazetteers and the words
in front - vote on every candidate; expectation-maximisation estimates each
labeler's reliability from the counts of vote combinations over all documents;
the resulting probabilities train the final span classifier, a logistic
regression over the candidates' features, whose weights become one column
expression. Vote and feature combinations are a fixed, small set, so only
their counts reach the driver.

Positions: splitting a text at a pattern and extracting its matches give the
gaps and the matches in turn; their lengths in code points add up to offsets.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import read, write_table

# The base patterns. Loops are possessive (they never give back what they took, which changes no match
# here), so long runs need neither stack nor repeated scans; a match starts only where a run starts, or where the last
# match ended, because no start within a run can do better than the run's first.
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]",
         "masked_email": r"[\[(](?:at|AT)[\])]", "local_phone": r"[0-9]{3}[ .-][0-9]{4}", "national_id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         "iban": r"[A-Z]{2}[0-9]{2}[ A-Z0-9]{11}", "secret": r"[=:] *[\"'][0-9A-Za-z_-]{16}"}
#: Wider candidates, found after the base kinds; none contains an unbounded nested loop.
WIDE = {
    "masked_email": r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]{1,63}){1,4}",
    "local_phone": r"(?<![0-9+().-])(?<![0-9+)] )\(?[0-9]{3}[) .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z_]{3,24} ?[=:] ?[\"'][0-9A-Za-z_-]{16,128}[\"']",
}
KINDS = (*BASE, *WIDE)

# Gazetteers.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "ch", "it", "nl")
COUNTRY_CODES = ("1", "7", "33", "34", "39", "41", "43", "44", "49", "52", "55", "61", "81", "86", "91")
IBAN_COUNTRIES = ("AT", "BE", "CH", "DE", "ES", "FR", "GB", "IE", "IT", "LU", "NL", "PL", "PT", "SE")
SECRET_NAMES = ("token", "secret", "key", "apikey", "api_key", "password", "passwd", "access_token", "auth")
#: Words in front of a candidate that speak for its kind.
CONTEXT = {
    "email": "mail|e-mail|email|contact|write|correo|courriel", "masked_email": "mail|e-mail|email|contact|write|correo|courriel",
    "ip": "ip|host|server|address|addr", "card": "card|visa|mastercard|amex|credit|tarjeta|carte|karte",
    "phone": "phone|tel|call|fax|mobile|cell|telefon|teléfono|téléphone",
    "local_phone": "phone|tel|call|fax|mobile|cell|telefon|teléfono|téléphone",
    "national_id": "ssn|social|security|id|identity", "iban": "iban|account|konto|compte|cuenta",
    "secret": "token|secret|key|password|login|auth",
}

LABELERS = ("shape", "gazetteer", "context")
#: The classifier accepts a candidate from this probability on.
ACCEPT = 0.5


def _find(text: Column, pattern: str, need: str, before: int = 24) -> Column:
    """``array<struct<s, e, m, left>>`` of the leftmost matches of ``pattern``, with up to ``before`` characters that
    stand in front of each."""
    p = F.lit(pattern)
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, p, F.lit(0))
    item = "struct<s:int,e:int,m:string,left:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{item}>").alias("out"))

    def step(acc, x):
        s = acc["at"] + F.length(x["0"])
        e = s + F.length(x["1"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(
            s.alias("s"), e.alias("e"), x["1"].alias("m"), F.right(x["0"], F.lit(before)).alias("left")))).alias("out"))

    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("0"), matches.alias("1"))
    seen = F.contains(text, F.lit(need)) if need == "@" else text.rlike(need)
    return F.when(seen, F.aggregate(zipped, start, step, lambda a: a["out"])).otherwise(F.array().cast(f"array<{item}>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(d, i, F.lit(1)).cast("int") + 1)))
    return F.when(F.length(d).between(14, 19), total % 10 == 0).otherwise(F.lit(False))


def _valid(kind: str, m: Column) -> Column:
    """The check that makes a match of a base kind a base span."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)
    if kind == "card":
        return _luhn(m)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def _votes(kind: str, c: Column) -> list[Column]:
    """-1, 0 or 1 of each labeler: no, abstains, yes."""
    m, left = c["m"], c["left"]
    sign = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    n = F.length(_digits(m))
    if kind in BASE:
        shape = sign(c["ok"], ~c["ok"])
    elif kind == "masked_email":
        shape = sign(m.rlike(r"[\[(](?:dot|DOT)[\])]|\."))
    elif kind == "local_phone":
        shape = sign((n == 10) & ~m.rlike(r"^\(?[01]"), n != 10)
    elif kind == "national_id":
        shape = sign(~m.rlike(r"^(?:000|666|9)|-00-|-0000$"), m.rlike(r"^(?:000|666|9)|-00-|-0000$"))
    elif kind == "iban":
        shape = sign(F.length(F.regexp_replace(m, " ", "")).between(15, 34))
    else:
        body = F.regexp_extract(m, r"[\"']([^\"']+)[\"']", 1)
        shape = sign(body.rlike("[0-9]") & body.rlike("[A-Za-z]"), ~body.rlike("[0-9]"))
    if kind in ("email", "masked_email"):
        known = sign(F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1)).isin(*TOP_LEVEL))
    elif kind == "ip":
        known = sign(~m.rlike(r"^(?:0|255)\."), m.rlike(r"^0+\."))
    elif kind == "card":
        known = sign(m.rlike("^[3-6]"), ~m.rlike("^[2-6]"))
    elif kind == "phone":
        known = sign(m.rlike(r"^\+(?:" + "|".join(COUNTRY_CODES) + ")"))
    elif kind == "iban":
        known = sign(F.substring(m, 1, 2).isin(*IBAN_COUNTRIES), ~F.substring(m, 1, 2).isin(*IBAN_COUNTRIES))
    elif kind == "secret":
        known = sign(F.lower(F.regexp_extract(m, "^([A-Za-z_]+)", 1)).isin(*SECRET_NAMES),
                     ~F.lower(m).rlike("token|secret|key|pass|auth"))
    else:
        known = F.lit(0)
    near = sign(F.lower(left).rlike(rf"(?:^|[^\p{{L}}])(?:{CONTEXT[kind]})[ :=\-.#]*(?:\p{{L}}{{1,6}} ?)?[:= ]*$"))
    return [shape, known, near]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, found``: an array of ``struct<s, e, kind, base, votes, long, edge>`` for each row of ``docs``; ``kind`` is the
    position in ``KINDS``, ``votes`` one number for the combination of votes, ``long`` and ``edge`` features."""
    text = F.col("t")
    spans = {k: _find(text, p, NEEDS[k]) for k, p in {**BASE, **WIDE}.items()}
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # materialised before the votes read them
    df = df.select("id", *[spans[k].alias(k) for k in KINDS])

    def of(kind: str) -> Column:
        checked = F.transform(F.col(kind), lambda c: c.withField("ok", _valid(kind, c["m"]) if kind in BASE else F.lit(False)))

        def described(c):
            code = F.lit(0)
            for v in _votes(kind, c):
                code = code * 3 + v + 1
            return F.struct(c["s"].alias("s"), F.lit(KINDS.index(kind)).alias("kind"), c["e"].alias("e"), c["ok"].alias("base"),
                            code.alias("votes"), (F.length(c["m"]) >= 16).cast("int").alias("long"),
                            c["left"].rlike(r"(?:^|[\s\"'(\[<:;,=])$").cast("int").alias("edge"))
        return F.transform(checked, described)

    return df.select("id", F.concat(*[of(k) for k in KINDS]).alias("found"))


def fit_labelers(counts: list[tuple[int, int, int, int, float]], rounds: int = 100) -> dict:
    """Expectation-maximisation over counts of ``(kind, votes, long, edge, n)``.

    Returns ``posterior`` of each (kind, votes), the ``prior`` of each kind and, of each labeler, ``rate[y][vote]``: how
    often it casts each vote on true (1) and false (0) candidates. Labelers are independent given the truth.
    """
    keys = sorted({(k, v) for k, v, *_ in counts})
    n = np.array([sum(c[4] for c in counts if c[:2] == key) for key in keys], dtype=float)
    votes = np.array([[(v // 3 ** (len(LABELERS) - 1 - i)) % 3 for i in range(len(LABELERS))] for _, v in keys],
                     dtype=int).reshape(-1, len(LABELERS))
    kinds = np.array([k for k, _ in keys], dtype=int)
    post = 1 / (1 + np.exp(-2.0 * (votes - 1).sum(axis=1)))  # majority vote to start with
    prior, rate = {}, np.full((len(LABELERS), 2, 3), 1 / 3)
    for _ in range(rounds):
        for i in range(len(LABELERS)):
            for y, w in ((0, 1 - post), (1, post)):
                for v in range(3):
                    rate[i, y, v] = (n * w * (votes[:, i] == v)).sum() + 1
                rate[i, y] /= rate[i, y].sum()
        prior = {k: ((n * post)[kinds == k].sum() + 1) / (n[kinds == k].sum() + 2) for k in set(kinds.tolist())}
        p = np.array([prior[k] for k in kinds.tolist()])
        like = [np.prod([rate[i, y, votes[:, i]] for i in range(len(LABELERS))], axis=0) for y in (0, 1)]
        new = p * like[1] / (p * like[1] + (1 - p) * like[0]) if len(keys) else post
        if len(keys) == 0 or np.abs(new - post).max() < 1e-9:
            post = new
            break
        post = new
    return {"posterior": {key: float(x) for key, x in zip(keys, post)}, "prior": prior, "rate": rate}


def _features(kind: int, votes: int, long: int, edge: int) -> list[float]:
    """One indicator per kind, two per labeler, length and edge."""
    v = [(votes // 3 ** (len(LABELERS) - 1 - i)) % 3 for i in range(len(LABELERS))]
    return ([float(kind == k) for k in range(len(KINDS))] + [float(x == 2) for x in v] + [float(x == 0) for x in v]
            + [float(long), float(edge)])


def fit_classifier(counts: list[tuple[int, int, int, int, float]], posterior: dict, rounds: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps on feature combinations, weighted by count, with the labelers'
    probabilities as soft targets."""
    x = np.array([_features(*c[:4]) for c in counts]).reshape(len(counts), len(_features(0, 0, 0, 0)))
    y = np.array([posterior[c[:2]] for c in counts])
    n = np.array([c[4] for c in counts], dtype=float)
    w = np.zeros(len(_features(0, 0, 0, 0)))
    for _ in range(rounds if len(counts) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (y - p)) - ridge * w
        hess = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _score(c: Column, w: np.ndarray) -> Column:
    """Log odds of a candidate as an expression."""
    total = F.element_at(F.array(*[F.lit(float(x)) for x in w[:len(KINDS)]]), c["kind"] + 1)
    for i in range(len(LABELERS)):
        v = F.floor(c["votes"] / 3 ** (len(LABELERS) - 1 - i)) % 3
        total = total + F.when(v == 2, float(w[len(KINDS) + i])).when(v == 0, float(w[len(KINDS) + len(LABELERS) + i])).otherwise(0.0)
    return total + c["long"] * float(w[-2]) + c["edge"] * float(w[-1])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``id, spans, n_candidates``: ``spans`` is an array of ``struct<s, kind, e, base>``, sorted, of each row's base spans and
    of the wider candidates that the classifier accepts; positions are code points, end exclusive.

    Null and empty texts have no spans. Rows are treated one by one, repeated ids or not. The classifier learns from
    the candidates of all rows; with none at all, nothing is accepted beyond the base. A wider candidate that overlaps
    a base span is not added.
    """
    rows = write_table(candidates(docs, id_col, text_col))
    c = rows.select(F.explode("found").alias("c"))
    counts = [tuple(r) for r in c.groupBy("c.kind", "c.votes", "c.long", "c.edge").agg(F.count("*").cast("double")).collect()]
    model = fit_labelers(counts)
    w = fit_classifier(counts, model["posterior"])
    cut = math.log(accept / (1 - accept))
    base = F.filter("found", lambda c: c["base"])
    more = F.filter("found", lambda c: (c["kind"] >= len(BASE)) & (_score(c, w) >= cut))
    free = F.filter(F.col("more"), lambda c: ~F.exists(F.col("b"), lambda x: (x["s"] < c["e"]) & (c["s"] < x["e"])))
    return (rows.select("id", "found", base.alias("b"), more.alias("more"))
            .select(F.col("id").alias(id_col), F.array_sort(F.transform(F.concat(F.col("b"), free), lambda c: F.struct(
                c["s"].alias("s"), c["kind"].alias("kind"), c["e"].alias("e"), c["base"].alias("base")))).alias("spans"),
                F.size("found").alias("n_candidates")))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda c: F.concat_ws(
        ":", F.element_at(names, c["kind"] + 1), c["s"].cast("string"), c["e"].cast("string"))))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: base spans by kind, their digest, and all spans."""
    out = find_personal_data(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda c: c["base"] & (c["kind"] == KINDS.index(k)))).cast("long")
    return out.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                      F.sha2(written(F.filter("spans", lambda c: c["base"])), 256).alias("base_sha256"),
                      written(F.col("spans")).alias("spans"))


QUERIES = {"op10_pii": op10_pii}
ORACLES: dict[str, str] = {}
