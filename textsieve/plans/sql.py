"""ANSI-ish SQL (DuckDB dialect) for the oracle side of every exact query.

Each helper mirrors one Spark expression of the library, built from the same
fixed patterns and lists, so the two engines compute the same thing
independently.
"""

from __future__ import annotations

from textsieve.config import Options
from textsieve.functions.text import (
    CONTRACTION_SPLITS,
    NLTK_ENGLISH_STOP_WORDS,
    NOUN_DETACHMENT_RULES,
    TAG_PATTERN,
    TOKEN_PATTERN,
    TOKEN_QUOTES,
    URL_PATTERN_EXACT,
    WHITESPACE_CLASS,
    spark_english_stop_words,
)

PUNCT_CLASS = r"[!-/:-@\[-`{-~]"  # the 32 ASCII punctuation characters

BASE = (
    "SELECT d.doc_id AS row_id, d.text AS message, l.toxic AS label "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def clean(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    t = f"regexp_replace({t}, {q(URL_PATTERN_EXACT)}, '', 'g')"
    t = f"regexp_replace({t}, {q(TAG_PATTERN)}, '', 'g')"
    t = f"regexp_replace({t}, {q(PUNCT_CLASS)}, '', 'g')"
    t = f"regexp_replace({t}, {q(chr(92) + 'p{Nd}+')}, '', 'g')"
    t = f"regexp_replace({t}, {q('[' + WHITESPACE_CLASS + ']+')}, ' ', 'g')"
    return f"trim({t})"


def tokenize(cleaned: str) -> str:
    cases = " ".join(f"WHEN {q(w)} THEN {str_list(p)}" for w, p in CONTRACTION_SPLITS.items())
    spaced = f"regexp_replace({cleaned}, {q('([' + TOKEN_QUOTES + '])')}, ' \\1 ', 'g')"
    return (f"flatten(list_transform(list_filter(string_split({spaced}, ' '), lambda t: t <> ''), "
            f"lambda t: CASE t {cases} ELSE [t] END))")


def remove_stop(tokens: str, words=None) -> str:
    words = NLTK_ENGLISH_STOP_WORDS if words is None else words
    return f"list_filter({tokens}, lambda t: NOT list_contains({str_list(words)}, t))"


def analyzer(x: str, stop_words=None) -> str:
    sw = spark_english_stop_words() if stop_words is None else stop_words
    terms = f"regexp_extract_all(lower(coalesce({x}, '')), {q(TOKEN_PATTERN)})"
    if sw:
        terms = f"list_filter({terms}, lambda t: NOT list_contains({str_list(sw)}, t))"
    return terms


def ws_count(x: str, cls: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {q(cls)})) AS BIGINT)"


def md5_key(*parts: str, seed: int = 42) -> str:
    inner = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5({inner} || ':{seed}')"


def md5_int(*parts: str, seed: int = 42) -> str:
    return f"('0x' || substr({md5_key(*parts, seed=seed)}, 1, 8))::BIGINT"


def lemma_rules_sql(term: str) -> str:
    """Candidate list (ord, cand) of the noun detachment rules."""
    items = [f"{{'ord': 0, 'cand': {term}}}"]
    for i, (end, rep) in enumerate(NOUN_DETACHMENT_RULES):
        items.append(
            f"CASE WHEN suffix({term}, {q(end)}) THEN {{'ord': {i + 1}, 'cand': "
            f"substr({term}, 1, length({term}) - {len(end)}) || {q(rep)}}} END"
        )
    return f"list_filter([{', '.join(items)}], lambda c: c IS NOT NULL)"


def quota_ctes(test_size: float, source: str = "base") -> str:
    """``quotas(label, n_test_c)``: test rows per class (see
    ``sampling.test_quotas``)."""
    return f"""
qc AS (SELECT label, count(*) AS n_c FROM {source} GROUP BY label),
qn AS (SELECT sum(n_c) AS n, sum(n_c) - CAST(ceil(CAST({test_size} AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_train FROM qc),
qf AS (SELECT qc.label, qc.n_c, (qn.n_train * qc.n_c) // qn.n AS fl, (qn.n_train * qc.n_c) % qn.n AS rem,
              qn.n_train - sum((qn.n_train * qc.n_c) // qn.n) OVER () AS need FROM qc, qn),
quotas AS (SELECT label, n_c - fl - CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= need THEN 1 ELSE 0 END
                  AS n_test_c FROM qf)"""


def training_ctes(opts: Options = Options(), stop_words=None) -> str:
    """CTEs ``split, counts, vocab, weights, ftr, fte, test_docs`` of the
    default training plan (split -> vocabulary -> upsample -> features)."""
    text = clean("message") if opts.preprocess else "message"
    limit = f"LIMIT {int(opts.max_features)}" if opts.max_features is not None else ""
    if opts.method == "tfidf":
        value_tr = "x / sqrt(sum(x * x) OVER (PARTITION BY row_id))"
        x_expr = "c.tf * v.idf"
    else:
        value_tr = "x"
        x_expr = "CAST(c.tf AS DOUBLE)"
    if opts.upsample:
        weights = f"""
cls AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM tr),
role AS (SELECT CASE WHEN n0 > n1 THEN 0 ELSE 1 END AS maj, CASE WHEN n0 > n1 THEN 1 ELSE 0 END AS mino,
                CASE WHEN n0 > n1 THEN n0 ELSE n1 END AS n_maj FROM cls),
minority AS (SELECT tr.row_id, row_number() OVER (ORDER BY {md5_key('tr.row_id', seed=opts.seed)}, tr.row_id) - 1 AS idx
             FROM tr JOIN role ON tr.label = role.mino),
draws AS (SELECT i AS copy_no, {md5_int('i', seed=opts.seed)} % (SELECT count(*) FROM minority) AS pick
          FROM (SELECT unnest(range((SELECT n_maj FROM role))) AS i)),
balanced AS (SELECT tr.row_id, tr.label, -1 AS copy_no FROM tr JOIN role ON tr.label = role.maj
             UNION ALL
             SELECT m.row_id, (SELECT mino FROM role) AS label, d.copy_no FROM draws d JOIN minority m ON d.pick = m.idx),
weights AS (SELECT row_id, label, CAST(count(*) AS DOUBLE) AS weight FROM balanced GROUP BY row_id, label),"""
    else:
        weights = "\nweights AS (SELECT row_id, label, 1.0::DOUBLE AS weight FROM tr),"
    return f"""
base AS ({BASE}),
ranked AS (SELECT row_id, message, label,
                  row_number() OVER (PARTITION BY label ORDER BY {md5_key('row_id', seed=opts.seed)}, row_id) AS r,
                  count(*) OVER (PARTITION BY label) AS n_c FROM base),
{quota_ctes(opts.test_size)},
split AS (SELECT r.row_id, r.message, r.label, r.r <= q.n_test_c AS is_test FROM ranked r JOIN quotas q ON r.label = q.label),
toks AS (SELECT row_id, label, is_test, unnest({analyzer(text, stop_words)}) AS term FROM split),
counts AS (SELECT row_id, label, is_test, term, count(*) AS tf FROM toks GROUP BY row_id, label, is_test, term),
tr AS (SELECT row_id, label FROM split WHERE NOT is_test),
test_docs AS (SELECT row_id, label FROM split WHERE is_test),
ntr AS (SELECT count(*) AS n FROM tr),
dfs AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM counts WHERE NOT is_test GROUP BY term
        HAVING count(*) >= {int(opts.min_df)}),
topk AS (SELECT * FROM dfs ORDER BY ctf DESC, term {limit}),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id, df, ctf,
                 ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM topk, ntr),{weights}
ftr_x AS (SELECT c.row_id, c.label, w.weight, v.term, v.term_id, {x_expr} AS x
          FROM counts c JOIN weights w ON c.row_id = w.row_id JOIN vocab v ON c.term = v.term WHERE NOT c.is_test),
ftr AS (SELECT row_id, label, weight, term, term_id, {value_tr} AS value FROM ftr_x),
fte_x AS (SELECT c.row_id, c.label, v.term, v.term_id, {x_expr} AS x
          FROM counts c JOIN vocab v ON c.term = v.term WHERE c.is_test),
fte AS (SELECT row_id, label, term, term_id, {value_tr} AS value FROM fte_x),
cc AS (SELECT sum(CASE WHEN label = 0 THEN weight ELSE 0 END) AS c0,
              sum(CASE WHEN label = 1 THEN weight ELSE 0 END) AS c1 FROM weights)"""


def nb_ctes(kind: str, alpha: float = 1.0, var_smoothing: float = 1e-9, name: str = "nb") -> str:
    """``{name}_params(term, w0, w1, q0, q1)``, ``{name}_const(k0, k1)`` and
    ``{name}_scored`` over the test documents. Needs ``training_ctes``."""
    if kind == "multinomial":
        params = f"""
{name}_fc AS (SELECT v.term,
      coalesce(sum(CASE WHEN f.label = 0 THEN f.weight * f.value END), 0) AS fc0,
      coalesce(sum(CASE WHEN f.label = 1 THEN f.weight * f.value END), 0) AS fc1
    FROM vocab v LEFT JOIN ftr f ON v.term = f.term GROUP BY v.term),
{name}_tot AS (SELECT sum(fc0) AS t0, sum(fc1) AS t1, count(*) AS nv FROM {name}_fc),
{name}_params AS (SELECT term, ln(fc0 + {alpha}) - ln(t0 + {alpha} * nv) AS w0,
      ln(fc1 + {alpha}) - ln(t1 + {alpha} * nv) AS w1, 0.0 AS q0, 0.0 AS q1, 0.0 AS k0, 0.0 AS k1
    FROM {name}_fc, {name}_tot),"""
        fx = "f.value"
    elif kind == "bernoulli":
        params = f"""
{name}_fc AS (SELECT v.term,
      coalesce(sum(CASE WHEN f.label = 0 AND f.value > 0 THEN f.weight END), 0) AS dc0,
      coalesce(sum(CASE WHEN f.label = 1 AND f.value > 0 THEN f.weight END), 0) AS dc1
    FROM vocab v LEFT JOIN ftr f ON v.term = f.term GROUP BY v.term),
{name}_lp AS (SELECT term, ln(dc0 + {alpha}) - ln(c0 + 2 * {alpha}) AS lp0, ln(dc1 + {alpha}) - ln(c1 + 2 * {alpha}) AS lp1
    FROM {name}_fc, cc),
{name}_params AS (SELECT term, lp0 - ln(1 - exp(lp0)) AS w0, lp1 - ln(1 - exp(lp1)) AS w1, 0.0 AS q0, 0.0 AS q1,
      ln(1 - exp(lp0)) AS k0, ln(1 - exp(lp1)) AS k1 FROM {name}_lp),"""
        fx = "CASE WHEN f.value > 0 THEN 1.0 ELSE 0.0 END"
    else:
        params = f"""
{name}_fc AS (SELECT v.term,
      coalesce(sum(CASE WHEN f.label = 0 THEN f.weight * f.value END), 0) AS sx0,
      coalesce(sum(CASE WHEN f.label = 1 THEN f.weight * f.value END), 0) AS sx1,
      coalesce(sum(CASE WHEN f.label = 0 THEN f.weight * f.value * f.value END), 0) AS sxx0,
      coalesce(sum(CASE WHEN f.label = 1 THEN f.weight * f.value * f.value END), 0) AS sxx1
    FROM vocab v LEFT JOIN ftr f ON v.term = f.term GROUP BY v.term),
{name}_mv AS (SELECT term, sx0 / c0 AS m0, sx1 / c1 AS m1,
      greatest(sxx0 / c0 - (sx0 / c0) * (sx0 / c0), 0.0) AS v0,
      greatest(sxx1 / c1 - (sx1 / c1) * (sx1 / c1), 0.0) AS v1,
      greatest((sxx0 + sxx1) / (c0 + c1) - ((sx0 + sx1) / (c0 + c1)) * ((sx0 + sx1) / (c0 + c1)), 0.0) AS va
    FROM {name}_fc, cc),
{name}_eps AS (SELECT {var_smoothing} * max(va) AS eps FROM {name}_mv),
{name}_params AS (SELECT term, m0 / (v0 + eps) AS w0, m1 / (v1 + eps) AS w1,
      -0.5 / (v0 + eps) AS q0, -0.5 / (v1 + eps) AS q1,
      -0.5 * ln(2 * pi() * (v0 + eps)) - 0.5 * m0 * m0 / (v0 + eps) AS k0,
      -0.5 * ln(2 * pi() * (v1 + eps)) - 0.5 * m1 * m1 / (v1 + eps) AS k1
    FROM {name}_mv, {name}_eps),"""
        fx = "f.value"
    return params + f"""
{name}_const AS (SELECT ln(c0 / (c0 + c1)) + (SELECT sum(k0) FROM {name}_params) AS k0,
                        ln(c1 / (c0 + c1)) + (SELECT sum(k1) FROM {name}_params) AS k1 FROM cc),
{name}_sums AS (SELECT f.row_id, sum(p.w0 * {fx} + p.q0 * f.value * f.value) AS s0,
                       sum(p.w1 * {fx} + p.q1 * f.value * f.value) AS s1
    FROM fte f JOIN {name}_params p ON f.term = p.term GROUP BY f.row_id),
{name}_raw AS (SELECT t.row_id, t.label, k.k0 + coalesce(s.s0, 0) AS score0, k.k1 + coalesce(s.s1, 0) AS score1
    FROM test_docs t LEFT JOIN {name}_sums s ON t.row_id = s.row_id, {name}_const k),
{name}_scored AS (SELECT row_id, label, score0, score1,
      CASE WHEN score1 > score0 THEN 1 ELSE 0 END AS prediction,
      exp(score1 - greatest(score0, score1)) / (exp(score0 - greatest(score0, score1)) + exp(score1 - greatest(score0, score1))) AS probability
    FROM {name}_raw)"""


def scored_eval_sql(scored: str, what: str) -> str:
    """Evaluation SELECTs over a CTE with (label, prediction, probability)."""
    cells = (f"(SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, "
             f"count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
             f"count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
             f"count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM {scored})")

    def div(a, b):
        return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"

    if what == "confusion_matrix":
        return (f"SELECT CAST(y AS INTEGER) AS label, CAST(p AS INTEGER) AS prediction, CAST(count(s.row_id) AS BIGINT) AS n "
                f"FROM (VALUES (0,0),(0,1),(1,0),(1,1)) g(y,p) LEFT JOIN {scored} s ON s.label = g.y AND s.prediction = g.p "
                f"GROUP BY y, p")
    if what == "binary_metrics":
        return (f"SELECT round({div('tp + tn', 'tp + fp + tn + fn')}, 6) AS accuracy, round({div('tp', 'tp + fp')}, 6) AS precision, "
                f"round({div('tp', 'tp + fn')}, 6) AS recall, round({div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM {cells}")
    if what == "classification_report":
        p1, r1, f1 = div("tp", "tp + fp"), div("tp", "tp + fn"), div("2 * tp", "2 * tp + fp + fn")
        p0, r0, f0 = div("tn", "tn + fn"), div("tn", "tn + fp"), div("2 * tn", "2 * tn + fn + fp")
        s1, s0 = "(tp + fn)", "(tn + fp)"
        n = f"({s0} + {s1})"
        acc = div("tp + tn", n)
        rows = [
            ("'0'", p0, r0, f0, s0), ("'1'", p1, r1, f1, s1), ("'accuracy'", acc, acc, acc, n),
            ("'macro avg'", f"({p0} + {p1}) / 2", f"({r0} + {r1}) / 2", f"({f0} + {f1}) / 2", n),
            ("'weighted avg'", div(f"{p0} * {s0} + {p1} * {s1}", n), div(f"{r0} * {s0} + {r1} * {s1}", n),
             div(f"{f0} * {s0} + {f1} * {s1}", n), n),
        ]
        return " UNION ALL ".join(
            f"SELECT {c} AS class, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1_score, "
            f"CAST({s} AS BIGINT) AS support FROM {cells}" for c, p, r, f, s in rows)
    st = (f"(SELECT score, pos, neg, row_number() OVER (ORDER BY score DESC) AS rn, "
          f"sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg "
          f"FROM (SELECT probability AS score, count(*) FILTER (WHERE label = 1) AS pos, "
          f"count(*) FILTER (WHERE label <> 1) AS neg FROM {scored} GROUP BY probability))")
    tot = f"(SELECT count(*) FILTER (WHERE label = 1) AS P, count(*) FILTER (WHERE label <> 1) AS N FROM {scored})"
    if what == "roc_auc":
        return (f"SELECT round({div('sum(neg * (2 * cum_pos - pos))', '2.0 * sum(pos) * sum(neg)')}, 6) AS roc_auc FROM {st}")
    if what == "average_precision":
        return (f"SELECT round({div('sum(pos * cum_pos / (cum_pos + cum_neg))', 'sum(pos)')}, 6) AS average_precision FROM {st}")
    if what == "roc_points":
        return (f"SELECT CAST(0 AS BIGINT) AS point, CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr "
                f"UNION ALL SELECT rn AS point, round(score, 6) AS threshold, round({div('cum_neg', 'N')}, 6) AS fpr, "
                f"round({div('cum_pos', 'P')}, 6) AS tpr FROM (SELECT *, lead(pos) OVER (ORDER BY rn) AS n_pos, "
                f"lead(neg) OVER (ORDER BY rn) AS n_neg FROM {st}), {tot} "
                f"WHERE rn = 1 OR n_pos IS NULL OR n_pos <> pos OR n_neg <> neg")
    if what == "pr_points":
        return (f"SELECT rn AS point, round(score, 6) AS threshold, round({div('cum_pos', 'cum_pos + cum_neg')}, 6) AS precision, "
                f"round(CASE WHEN P = 0 THEN 1.0 ELSE {div('cum_pos', 'P')} END, 6) AS recall FROM {st}, {tot} "
                f"UNION ALL SELECT CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE")
    raise KeyError(what)


def training_ctes_leaky(opts: Options, stop_words=None) -> str:
    """The reference's order: vocabulary on all rows, upsample all rows, split
    the rows with their copies; ``weights`` and ``test_docs`` carry copies as
    weights. Same CTE names as ``training_ctes``."""
    text = clean("message") if opts.preprocess else "message"
    limit = f"LIMIT {int(opts.max_features)}" if opts.max_features is not None else ""
    key = md5_key("row_id", "copy_no", seed=opts.seed)
    return f"""
base AS ({BASE}),
toks AS (SELECT row_id, label, unnest({analyzer(text, stop_words)}) AS term FROM base),
counts AS (SELECT row_id, label, term, count(*) AS tf FROM toks GROUP BY row_id, label, term),
nall AS (SELECT count(*) AS n FROM base),
dfs AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM counts GROUP BY term HAVING count(*) >= {int(opts.min_df)}),
topk AS (SELECT * FROM dfs ORDER BY ctf DESC, term {limit}),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id, df, ctf,
                 ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM topk, nall),
tr AS (SELECT row_id, label FROM base),
cls AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM tr),
role AS (SELECT CASE WHEN n0 > n1 THEN 0 ELSE 1 END AS maj, CASE WHEN n0 > n1 THEN 1 ELSE 0 END AS mino,
                CASE WHEN n0 > n1 THEN n0 ELSE n1 END AS n_maj FROM cls),
minority AS (SELECT tr.row_id, row_number() OVER (ORDER BY {md5_key('tr.row_id', seed=opts.seed)}, tr.row_id) - 1 AS idx
             FROM tr JOIN role ON tr.label = role.mino),
draws AS (SELECT i AS copy_no, {md5_int('i', seed=opts.seed)} % (SELECT count(*) FROM minority) AS pick
          FROM (SELECT unnest(range((SELECT n_maj FROM role))) AS i)),
balanced AS (SELECT tr.row_id, tr.label, CAST(-1 AS BIGINT) AS copy_no FROM tr JOIN role ON tr.label = role.maj
             UNION ALL
             SELECT m.row_id, (SELECT mino FROM role) AS label, d.copy_no FROM draws d JOIN minority m ON d.pick = m.idx),
ranked AS (SELECT row_id, label, copy_no,
                  row_number() OVER (PARTITION BY label ORDER BY {key}, row_id) AS r FROM balanced),{quota_ctes(opts.test_size, "balanced")},
sp AS (SELECT r.row_id, r.label, r.r <= q.n_test_c AS is_test FROM ranked r JOIN quotas q ON r.label = q.label),
weights AS (SELECT row_id, label, CAST(count(*) AS DOUBLE) AS weight FROM sp WHERE NOT is_test GROUP BY row_id, label),
test_docs AS (SELECT row_id, label, CAST(count(*) AS DOUBLE) AS weight FROM sp WHERE is_test GROUP BY row_id, label),
ftr_x AS (SELECT c.row_id, c.label, w.weight, v.term, v.term_id, c.tf * v.idf AS x
          FROM counts c JOIN weights w ON c.row_id = w.row_id JOIN vocab v ON c.term = v.term),
ftr AS (SELECT row_id, label, weight, term, term_id, x / sqrt(sum(x * x) OVER (PARTITION BY row_id)) AS value FROM ftr_x),
fte_x AS (SELECT c.row_id, c.label, v.term, v.term_id, c.tf * v.idf AS x
          FROM counts c SEMI JOIN test_docs t ON c.row_id = t.row_id JOIN vocab v ON c.term = v.term),
fte AS (SELECT row_id, label, term, term_id, x / sqrt(sum(x * x) OVER (PARTITION BY row_id)) AS value FROM fte_x),
cc AS (SELECT sum(CASE WHEN label = 0 THEN weight ELSE 0 END) AS c0,
              sum(CASE WHEN label = 1 THEN weight ELSE 0 END) AS c1 FROM weights)"""


def tree_ctes(criterion: str = "gini", bins: int = 32, max_depth: int | None = None, min_samples_split: int = 2,
              min_samples_leaf: int = 1) -> str:
    """``tree_nodes(path, term, bin, n, w0, w1, gain, leaf)`` of one decision tree, grown whole by recursion, and
    ``tree_scored`` over the test documents. Needs ``training_ctes`` after ``WITH RECURSIVE``."""
    def impurity(a, b):
        if criterion == "gini":
            return f"(CASE WHEN {a} + {b} > 0 THEN 2 * {a} * {b} / ({a} + {b}) ELSE 0 END)"
        part = lambda x: f"(CASE WHEN {x} > 0 THEN -{x} * log2({x} / ({a} + {b})) ELSE 0 END)"
        return f"({part(a)} + {part(b)})"

    depth = f"AND length(path) < {int(max_depth)}" if max_depth is not None else ""
    place = f"CASE WHEN e.hi > e.lo THEN least(greatest(floor(round((f.value - e.lo) / (e.hi - e.lo) * {bins}, 6)), 0), {bins - 1}) + 1 ELSE 1 END"
    binned = lambda rows: (f"SELECT f.row_id, f.term, CAST({place} AS INTEGER) AS b "  # noqa: E731
                           f"FROM {rows} f JOIN edges e ON f.term = e.term WHERE f.value > 0")
    gain = f"{impurity('w0', 'w1')} - {impurity('ra', 'rb')} - {impurity('(w0 - ra)', '(w1 - rb)')}"
    return f"""
edges AS (SELECT term, min(value) AS lo, max(value) AS hi FROM ftr WHERE value > 0 GROUP BY term),
btr AS MATERIALIZED ({binned('ftr')}),
bte AS MATERIALIZED ({binned('fte')}),
grown AS (
  SELECT row_id, label, weight AS k, '' AS path, CAST(NULL AS VARCHAR) AS term, CAST(NULL AS INTEGER) AS bin,
         CAST(NULL AS DOUBLE) AS gain FROM weights
  UNION ALL
  SELECT s.row_id, s.label, s.k, s.path || CASE WHEN coalesce(f.b, 0) >= best.b THEN '1' ELSE '0' END, best.term, best.b, best.gain
  FROM grown s JOIN (
    SELECT path, term, b, g * (w0 + w1) AS gain FROM (
      SELECT *, row_number() OVER (PARTITION BY path ORDER BY g DESC, term, b) AS rk FROM (
        SELECT *, round(({gain}) / (w0 + w1), 12) AS g FROM (
          SELECT h.path, h.term, h.b, o.n, o.w0, o.w1, sum(h.n) OVER up AS rn, sum(h.a) OVER up AS ra, sum(h.c) OVER up AS rb
          FROM (SELECT s.path, f.term, f.b, sum(s.k) AS n, sum(CASE WHEN s.label = 0 THEN s.k ELSE 0 END) AS a,
                       sum(CASE WHEN s.label = 1 THEN s.k ELSE 0 END) AS c
                FROM grown s JOIN btr f ON s.row_id = f.row_id GROUP BY s.path, f.term, f.b) h
          JOIN (SELECT path, sum(k) AS n, sum(CASE WHEN label = 0 THEN k ELSE 0 END) AS w0,
                       sum(CASE WHEN label = 1 THEN k ELSE 0 END) AS w1 FROM grown GROUP BY path) o ON h.path = o.path
          WHERE o.w0 > 0 AND o.w1 > 0 AND o.n >= {int(min_samples_split)} {depth.replace('path', 'o.path')}
          WINDOW up AS (PARTITION BY h.path, h.term ORDER BY h.b DESC))
        WHERE rn >= {int(min_samples_leaf)} AND n - rn >= {int(min_samples_leaf)}))
    WHERE rk = 1) best ON s.path = best.path
  LEFT JOIN btr f ON f.row_id = s.row_id AND f.term = best.term),
totals AS (SELECT path, sum(k) AS n, sum(CASE WHEN label = 0 THEN k ELSE 0 END) AS w0, sum(CASE WHEN label = 1 THEN k ELSE 0 END) AS w1
           FROM grown GROUP BY path),
splits AS (SELECT substr(path, 1, length(path) - 1) AS path, any_value(term) AS term, any_value(bin) AS bin, any_value(gain) AS gain
           FROM grown WHERE path <> '' GROUP BY substr(path, 1, length(path) - 1)),
tree_nodes AS (SELECT t.path, s.term, s.bin, t.n, t.w0, t.w1, coalesce(s.gain, 0) AS gain, s.path IS NULL AS leaf
               FROM totals t LEFT JOIN splits s ON t.path = s.path),
walked AS (
  SELECT row_id, label, '' AS path FROM test_docs
  UNION ALL
  SELECT s.row_id, s.label, s.path || CASE WHEN coalesce(f.b, 0) >= n.bin THEN '1' ELSE '0' END
  FROM walked s JOIN tree_nodes n ON s.path = n.path AND NOT n.leaf LEFT JOIN bte f ON f.row_id = s.row_id AND f.term = n.term),
tree_scored AS (SELECT s.row_id, s.label, CASE WHEN round(n.w1 / (n.w0 + n.w1), 12) > 0.5 THEN 1 ELSE 0 END AS prediction,
                       n.w1 / (n.w0 + n.w1) AS probability
                FROM walked s JOIN tree_nodes n ON s.path = n.path AND n.leaf)"""
