"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the given
tables, with a matching DuckDB SQL text where SQL can express it.

Doubles are rounded to 6 decimals on both sides (G12); every computed column
has the same alias in both.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.config import Options
from textsieve.functions import text as T
from textsieve.operators import evaluate, prepare, sampling, trees, vectorize
from textsieve.plans import sql as S
from textsieve.plans import train

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        (F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in df.dtypes
    ])


def r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def tbl(spark, sf_dir, name):
    return train.read_table(spark, sf_dir, name)


# --- shared fitted state (one fit per session, data dir and options) --------

_FITS: dict = {}


def training(spark: SparkSession, sf_dir: str, opts: Options = Options()) -> train.TrainingData:
    key = (id(spark), sf_dir, opts)
    if key not in _FITS:
        _FITS[key] = train.prepare(train.labelled_messages(spark, sf_dir), opts)
    return _FITS[key]


def nb_model(spark, sf_dir, kind="multinomial", opts: Options = Options(), **params):
    key = (id(spark), sf_dir, opts, kind, tuple(sorted(params.items())))
    if key not in _FITS:
        _FITS[key] = train.fit_naive_bayes(training(spark, sf_dir, opts), kind, **params)
    return _FITS[key]


def nb_scored(spark, sf_dir, kind="multinomial", opts: Options = Options()) -> DataFrame:
    td = training(spark, sf_dir, opts)
    return train.score_test(td, nb_model(spark, sf_dir, kind, opts))


# --- raw messages (documents left join labels) ------------------------------

RAW_SQL = ("SELECT d.doc_id AS row_id, CASE l.toxic WHEN 1 THEN 'spam' WHEN 0 THEN 'ham' END AS v1, d.text AS v2 "
           "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


def raw_messages(spark, sf_dir) -> DataFrame:
    d = tbl(spark, sf_dir, "documents").select("doc_id", "text")
    lab = tbl(spark, sf_dir, "labels").select("doc_id", "toxic")
    v1 = F.when(F.col("toxic") == 1, F.lit("spam")).when(F.col("toxic") == 0, F.lit("ham"))
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").cast("bigint").alias("row_id"), v1.alias("v1"), F.col("text").alias("v2"))


def encoded(spark, sf_dir) -> DataFrame:
    return raw_messages(spark, sf_dir).transform(prepare.drop_junk_columns).transform(
        prepare.rename_columns).transform(prepare.encode_labels)


ENC_SQL = ("SELECT row_id, CAST(CASE v1 WHEN 'spam' THEN 1 WHEN 'ham' THEN 0 END AS INTEGER) AS label, v2 AS message "
           f"FROM ({RAW_SQL})")


@register("label_encode", f"SELECT row_id, label FROM ({ENC_SQL})")
def q_label_encode(spark, sf_dir):
    return encoded(spark, sf_dir).select("row_id", "label")


@register("null_profile", f"""
SELECT * FROM (
  SELECT 'row_id' AS column_name, count(*) FILTER (WHERE row_id IS NULL) AS n_null FROM ({ENC_SQL})
  UNION ALL SELECT 'label', count(*) FILTER (WHERE label IS NULL) FROM ({ENC_SQL})
  UNION ALL SELECT 'message', count(*) FILTER (WHERE message IS NULL) FROM ({ENC_SQL})
) WHERE n_null > 0""")
def q_null_profile(spark, sf_dir):
    return prepare.null_profile(encoded(spark, sf_dir)).withColumnRenamed("column", "column_name")


@register("drop_nulls", f"SELECT row_id, label FROM ({ENC_SQL}) WHERE label IS NOT NULL AND message IS NOT NULL")
def q_drop_nulls(spark, sf_dir):
    return prepare.drop_null_rows(encoded(spark, sf_dir)).select("row_id", "label")


@register("class_distribution", f"""
SELECT label, count(*) AS n, {r6('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct
FROM ({ENC_SQL}) WHERE label IS NOT NULL AND message IS NOT NULL GROUP BY label""")
def q_class_distribution(spark, sf_dir):
    return round_doubles(prepare.class_distribution(prepare.drop_null_rows(encoded(spark, sf_dir))))


@register("dataset_info", f"""
SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns, count(*) FILTER (WHERE label = 1) AS n_spam,
       count(*) FILTER (WHERE label = 0) AS n_ham
FROM ({ENC_SQL}) WHERE label IS NOT NULL AND message IS NOT NULL""")
def q_dataset_info(spark, sf_dir):
    return prepare.dataset_info(prepare.drop_null_rows(encoded(spark, sf_dir)))


# --- text functions ---------------------------------------------------------

@register("clean_text", f"SELECT doc_id, {S.clean('text')} AS cleaned FROM documents")
def q_clean_text(spark, sf_dir):
    return tbl(spark, sf_dir, "documents").select("doc_id", T.clean_text("text").alias("cleaned"))


@register("tokenize", f"""
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM (SELECT doc_id, {S.tokenize(S.clean('text'))} AS toks FROM documents)""")
def q_tokenize(spark, sf_dir):
    toks = T.tokenize(T.clean_text("text"))
    return tbl(spark, sf_dir, "documents").select(
        "doc_id", F.size(toks).alias("n_tokens"), T.join_tokens(toks).alias("tokens"))


@register("remove_stopwords", f"""
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM (SELECT doc_id, {S.remove_stop(S.tokenize(S.clean('text')))} AS toks FROM documents)""")
def q_remove_stopwords(spark, sf_dir):
    toks = T.remove_stopwords(T.tokenize(T.clean_text("text")))
    return tbl(spark, sf_dir, "documents").select(
        "doc_id", F.size(toks).alias("n_tokens"), T.join_tokens(toks).alias("tokens"))


_WS = T.WHITESPACE_CLASS
_TXT = "coalesce(text, 'None')"
_WC = S.ws_count(_TXT, f"[^{_WS}]+")
_FEATURES_SQL = f"""
SELECT doc_id, CAST(length({_TXT}) AS BIGINT) AS text_length, {_WC} AS word_count,
  {r6(f"length({_TXT}) / ({_WC} + 1)")} AS char_per_word,
  {S.ws_count(_TXT, "[^" + chr(92) + "p{L}" + chr(92) + "p{N}_" + _WS + "]")} AS special_char_count,
  {S.ws_count(_TXT, chr(92) + "p{Lu}")} AS uppercase_count,
  {S.ws_count(_TXT, chr(92) + "p{Nd}")} AS digit_count,
  {S.ws_count(_TXT, T.URL_PATTERN_EXACT)} AS url_count
FROM documents"""


@register("text_features", _FEATURES_SQL)
def q_text_features(spark, sf_dir):
    return round_doubles(T.surface_features(tbl(spark, sf_dir, "documents"), "text", keep=("doc_id",)))


@register("url_count_pages", f"""
SELECT page_id, {S.ws_count('html', T.URL_PATTERN_EXACT)} AS url_count, {S.clean('html')} AS cleaned FROM pages""")
def q_url_count_pages(spark, sf_dir):
    return tbl(spark, sf_dir, "pages").select(
        "page_id", T.url_count("html").cast("bigint").alias("url_count"), T.clean_text("html").alias("cleaned"))


# --- vectorizing over all labelled documents --------------------------------

_TOKS_SQL = f"SELECT row_id, unnest({S.analyzer('message')}) AS term FROM ({S.BASE})"
_COUNTS_SQL = f"SELECT row_id, term, count(*) AS tf FROM ({_TOKS_SQL}) GROUP BY row_id, term"
_VOCAB_SQL = f"""
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, df, ctf,
       ln((1.0 + (SELECT count(*) FROM ({S.BASE}))) / (1.0 + df)) + 1.0 AS idf
FROM (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM ({_COUNTS_SQL}) GROUP BY term
      HAVING count(*) >= 5 ORDER BY ctf DESC, term LIMIT 5000)"""


def _all_counts(spark, sf_dir):
    return vectorize.term_counts(train.labelled_messages(spark, sf_dir))


def _all_vocab(spark, sf_dir):
    key = (id(spark), sf_dir, "all_vocab")
    if key not in _FITS:
        base = train.labelled_messages(spark, sf_dir)
        _FITS[key] = vectorize.vocabulary(vectorize.term_stats(base), base.count(), 5, 5000)
    return _FITS[key]


@register("term_counts", _COUNTS_SQL)
def q_term_counts(spark, sf_dir):
    return _all_counts(spark, sf_dir)


@register("vocab_topk", f"SELECT term, term_id, df, ctf FROM ({_VOCAB_SQL})")
def q_vocab_topk(spark, sf_dir):
    return _all_vocab(spark, sf_dir).select("term", "term_id", "df", "ctf")


@register("idf", f"SELECT term, {r6('idf')} AS idf FROM ({_VOCAB_SQL})")
def q_idf(spark, sf_dir):
    return round_doubles(_all_vocab(spark, sf_dir).select("term", "idf"))


@register("tfidf_l2", f"""
SELECT row_id, term, {r6('x / sqrt(sum(x * x) OVER (PARTITION BY row_id))')} AS value
FROM (SELECT c.row_id, c.term, c.tf * v.idf AS x FROM ({_COUNTS_SQL}) c JOIN ({_VOCAB_SQL}) v ON c.term = v.term)""")
def q_tfidf_l2(spark, sf_dir):
    return round_doubles(
        vectorize.tfidf_vectors(_all_counts(spark, sf_dir), _all_vocab(spark, sf_dir)).select("row_id", "term", "value"))


# --- sampling ---------------------------------------------------------------

@register("class_majority", f"""
SELECT CAST(g.label AS INTEGER) AS label, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
  CASE WHEN g.label = (SELECT CASE WHEN count(*) FILTER (WHERE label = 0) > count(*) FILTER (WHERE label = 1)
                              THEN 0 ELSE 1 END FROM ({S.BASE})) THEN 'majority' ELSE 'minority' END AS role
FROM (VALUES (0), (1)) g(label) LEFT JOIN (SELECT label, count(*) AS n FROM ({S.BASE}) GROUP BY label) c
  ON g.label = c.label""")
def q_class_majority(spark, sf_dir):
    return sampling.class_majority(train.labelled_messages(spark, sf_dir))


def _upsample_sql(minority_rule: str, seed: int = 42) -> str:
    return f"""
WITH tr AS (SELECT row_id, label FROM ({S.BASE})),
cls AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM tr),
role AS (SELECT {minority_rule} FROM cls),
minority AS (SELECT tr.row_id, row_number() OVER (ORDER BY {S.md5_key('tr.row_id', seed=seed)}, tr.row_id) - 1 AS idx
             FROM tr JOIN role ON tr.label = role.mino),
draws AS (SELECT i AS copy_no, {S.md5_int('i', seed=seed)} % (SELECT count(*) FROM minority) AS pick
          FROM (SELECT unnest(range((SELECT n_maj FROM role))) AS i))
SELECT CAST(tr.row_id AS BIGINT) AS row_id, CAST(tr.label AS INTEGER) AS label, CAST(-1 AS BIGINT) AS copy_no
FROM tr JOIN role ON tr.label = role.maj
UNION ALL
SELECT CAST(m.row_id AS BIGINT), CAST((SELECT mino FROM role) AS INTEGER), CAST(d.copy_no AS BIGINT)
FROM draws d JOIN minority m ON d.pick = m.idx"""


@register("upsample", _upsample_sql(
    "CASE WHEN n0 > n1 THEN 0 ELSE 1 END AS maj, CASE WHEN n0 > n1 THEN 1 ELSE 0 END AS mino, "
    "CASE WHEN n0 > n1 THEN n0 ELSE n1 END AS n_maj"))
def q_upsample(spark, sf_dir):
    return sampling.balance_classes(train.labelled_messages(spark, sf_dir))


@register("legacy_upsample", _upsample_sql("0 AS maj, 1 AS mino, n0 AS n_maj"))
def q_legacy_upsample(spark, sf_dir):
    return sampling.legacy_upsample(train.labelled_messages(spark, sf_dir))


@register("stratified_split", f"""
WITH base AS ({S.BASE}),{S.quota_ctes(0.3)}
SELECT row_id, r.label, r <= q.n_test_c AS is_test
FROM (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY {S.md5_key('row_id')}, row_id) AS r
      FROM base) r JOIN quotas q ON r.label = q.label""")
def q_stratified_split(spark, sf_dir):
    return sampling.stratified_split(train.labelled_messages(spark, sf_dir)).select("row_id", "label", "is_test")


@register("random_split", f"""
SELECT row_id, r <= ceil(CAST(0.3 AS DOUBLE) * n) AS is_test
FROM (SELECT row_id, row_number() OVER (ORDER BY {S.md5_key('row_id', seed=0)}, row_id) AS r,
             count(*) OVER () AS n FROM ({S.BASE}))""")
def q_random_split(spark, sf_dir):
    return sampling.stratified_split(train.labelled_messages(spark, sf_dir), 0.3, None, seed=0).select(
        "row_id", "is_test")


@register("kfold_assign", f"""
SELECT row_id, label, CAST(floor((r - 1) * 5 / n_c) AS INTEGER) AS fold
FROM (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY {S.md5_key('row_id')}, row_id) AS r,
             count(*) OVER (PARTITION BY label) AS n_c FROM ({S.BASE}))""")
def q_kfold_assign(spark, sf_dir):
    return sampling.kfold_assign(train.labelled_messages(spark, sf_dir), 5).select("row_id", "label", "fold")


# --- Naive Bayes over the default training plan -----------------------------

_TRAIN = S.training_ctes(Options())


def _nb_sql(kind: str, select: str) -> str:
    return f"WITH {_TRAIN},\n{S.nb_ctes(kind)}\n{select}"


def sci(c: str):
    """10 significant digits as text: for values whose magnitude leaves no
    room for fixed decimals (gaussian log likelihoods reach 1e10)."""
    return F.format_string("%.9e", F.col(c)).alias(c)


def sci_sql(x: str) -> str:
    return f"printf('%.9e', {x})"


for _kind, _short in (("multinomial", "mnb"), ("bernoulli", "bnb"), ("gaussian", "gnb")):
    _big = _kind == "gaussian"

    def _fit(spark, sf_dir, _k=_kind, _b=_big):
        p = nb_model(spark, sf_dir, _k).params.select("term", "w0", "w1", "q0", "q1")
        return p.select("term", *[sci(c) for c in ("w0", "w1", "q0", "q1")]) if _b else round_doubles(p)

    def _score(spark, sf_dir, _k=_kind, _b=_big):
        sc = nb_scored(spark, sf_dir, _k).select("row_id", "label", "score0", "score1", "prediction", "probability")
        if _b:
            sc = sc.select("row_id", "label", sci("score0"), sci("score1"), "prediction", "probability")
        return round_doubles(sc)

    _f = sci_sql if _big else r6
    register(f"{_short}_fit", _nb_sql(_kind, f"SELECT term, {_f('w0')} AS w0, {_f('w1')} AS w1, "
                                             f"{_f('q0')} AS q0, {_f('q1')} AS q1 FROM nb_params"))(_fit)
    register(f"{_short}_score", _nb_sql(_kind, f"SELECT row_id, label, {_f('score0')} AS score0, {_f('score1')} AS score1, "
                                               f"prediction, {r6('probability')} AS probability FROM nb_scored"))(_score)


@register("scale_std", f"""WITH {_TRAIN},
st AS (SELECT v.term, coalesce(sum(f.weight * f.value), 0) AS sx, coalesce(sum(f.weight * f.value * f.value), 0) AS sxx
       FROM vocab v LEFT JOIN ftr f ON v.term = f.term GROUP BY v.term),
n AS (SELECT sum(weight) AS n FROM weights)
SELECT term, {r6('CASE WHEN sqrt(greatest(sxx / n - (sx / n) * (sx / n), 0.0)) > 0 THEN sqrt(greatest(sxx / n - (sx / n) * (sx / n), 0.0)) ELSE 1.0 END')} AS std
FROM st, n""")
def q_scale_std(spark, sf_dir):
    from textsieve.operators import bayes

    td = training(spark, sf_dir)
    return round_doubles(bayes.scale_std(td.feats_train, td.docs_train, td.vocab))


# --- evaluation of the multinomial model on the test rows -------------------

# Curves group rows by score; sums in two engines can differ in the last bit,
# so scores are rounded to 10 decimals first on both sides.
SCORE_DIGITS = 10

for _what in ("confusion_matrix", "binary_metrics", "classification_report", "roc_points", "roc_auc",
              "pr_points", "average_precision"):
    def _ev(spark, sf_dir, _w=_what):
        fn = getattr(evaluate, _w)
        sc = nb_scored(spark, sf_dir, "multinomial").withColumn(
            "probability", F.round("probability", SCORE_DIGITS))
        return round_doubles(fn(sc))

    register(_what, f"WITH {_TRAIN},\n{S.nb_ctes('multinomial')},\n"
                    f"nb_eval AS (SELECT row_id, label, prediction, round(probability, {SCORE_DIGITS}) AS probability "
                    f"FROM nb_scored)\n{S.scored_eval_sql('nb_eval', _what)}")(_ev)


def reset_state(spark: SparkSession | None = None):
    """Drop cached fits (and their persisted tables)."""
    for v in list(_FITS.values()):
        for attr in ("release",):
            if hasattr(v, attr):
                getattr(v, attr)()
        if hasattr(v, "params"):
            v.params.unpersist()
        if isinstance(v, DataFrame):
            v.unpersist()
    _FITS.clear()


# --- cross-validation, grid search, model choice ----------------------------

GRID_ALPHA = [0.1, 0.5, 1.0, 2.0]


def _cv_scores(spark, sf_dir, kind="multinomial", grid=(1.0,)):
    from textsieve.operators import bayes

    td = training(spark, sf_dir)
    folds = sampling.kfold_assign(td.docs_train, 5).select("row_id", "fold")
    return bayes.cv_grid(td.feats_train, td.docs_train, td.vocab, folds, kind, list(grid), 5)


def _cv_sql(kind: str, grid) -> str:
    g = ", ".join(f"CAST({a} AS DOUBLE)" for a in grid)
    if kind == "multinomial":
        stat = "ff.weight * ff.value"
        prm = """SELECT g.param, tt.fold, tt.term, ln(t0 + greatest(g.param, 1e-10)) - ln(s0_all + greatest(g.param, 1e-10) * V) AS w0,
                 ln(t1 + greatest(g.param, 1e-10)) - ln(s1_all + greatest(g.param, 1e-10) * V) AS w1, 0.0 AS k0, 0.0 AS k1
          FROM tt JOIN tf ON tt.fold = tf.fold, grid g"""
        fx = "ff.value"
    else:
        stat = "CASE WHEN ff.value > 0 THEN ff.weight ELSE 0.0 END"
        prm = """SELECT param, fold, term, lp0 - ln(1 - exp(lp0)) AS w0, lp1 - ln(1 - exp(lp1)) AS w1,
                 ln(1 - exp(lp0)) AS k0, ln(1 - exp(lp1)) AS k1
          FROM (SELECT g.param, tt.fold, tt.term,
                       ln(t0 + greatest(g.param, 1e-10)) - ln(c.c0 + 2 * greatest(g.param, 1e-10)) AS lp0,
                       ln(t1 + greatest(g.param, 1e-10)) - ln(c.c1 + 2 * greatest(g.param, 1e-10)) AS lp1
                FROM tt JOIN cct c ON tt.fold = c.fold, grid g)"""
        fx = "CASE WHEN ff.value > 0 THEN 1.0 ELSE 0.0 END"
    return f"""WITH {_TRAIN},
folds AS (SELECT row_id, label, weight, CAST(floor((r - 1) * 5 / n_c) AS INTEGER) AS fold
          FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {S.md5_key('row_id')}, row_id) AS r,
                       count(*) OVER (PARTITION BY label) AS n_c FROM weights)),
ff AS (SELECT f.row_id, f.label, f.weight, f.term, f.value, d.fold FROM ftr f JOIN folds d ON f.row_id = d.row_id),
grid AS (SELECT unnest([{g}]) AS param),
ft AS (SELECT v.term, fo.fold,
              coalesce(sum(CASE WHEN ff.label = 0 THEN {stat} END), 0) AS f0,
              coalesce(sum(CASE WHEN ff.label = 1 THEN {stat} END), 0) AS f1
       FROM vocab v CROSS JOIN (SELECT unnest(range(5)) AS fold) fo
       LEFT JOIN ff ON ff.term = v.term AND ff.fold = fo.fold GROUP BY v.term, fo.fold),
tt AS (SELECT term, fold, sum(f0) OVER (PARTITION BY term) - f0 AS t0, sum(f1) OVER (PARTITION BY term) - f1 AS t1 FROM ft),
tf AS (SELECT fold, sum(t0) AS s0_all, sum(t1) AS s1_all, count(*) AS V FROM tt GROUP BY fold),
ccf AS (SELECT fold, sum(CASE WHEN label = 0 THEN weight ELSE 0 END) AS h0,
               sum(CASE WHEN label = 1 THEN weight ELSE 0 END) AS h1 FROM folds GROUP BY fold),
cct AS (SELECT fold, (SELECT c0 FROM cc) - h0 AS c0, (SELECT c1 FROM cc) - h1 AS c1 FROM ccf),
prm AS ({prm}),
kst AS (SELECT p.param, p.fold, ln(c.c0 / (c.c0 + c.c1)) + sum(p.k0) AS k0, ln(c.c1 / (c.c0 + c.c1)) + sum(p.k1) AS k1
        FROM prm p JOIN cct c ON p.fold = c.fold GROUP BY p.param, p.fold, c.c0, c.c1),
sums AS (SELECT p.param, ff.fold, ff.row_id, sum({fx} * p.w0) AS s0, sum({fx} * p.w1) AS s1
         FROM ff JOIN prm p ON ff.fold = p.fold AND ff.term = p.term GROUP BY p.param, ff.fold, ff.row_id),
sc AS (SELECT g.param, d.fold, d.row_id, d.label, d.weight,
              CASE WHEN k.k1 + coalesce(s.s1, 0) > k.k0 + coalesce(s.s0, 0) THEN 1 ELSE 0 END AS pred
       FROM folds d CROSS JOIN grid g JOIN kst k ON k.param = g.param AND k.fold = d.fold
       LEFT JOIN sums s ON s.param = g.param AND s.fold = d.fold AND s.row_id = d.row_id),
res AS (SELECT param, fold, coalesce(sum(CASE WHEN label = 1 AND pred = 1 THEN weight END), 0) AS tp,
               coalesce(sum(CASE WHEN label = 0 AND pred = 1 THEN weight END), 0) AS fp,
               coalesce(sum(CASE WHEN label = 1 AND pred = 0 THEN weight END), 0) AS fn FROM sc GROUP BY param, fold),
scores AS (SELECT param, fold, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM res)"""


def _rank_sql(scores: str) -> str:
    return (f"SELECT {r6('param')} AS param, {r6('avg(f1)')} AS mean_score, {r6('stddev_pop(f1)')} AS std_score, "
            f"{r6('min(f1)')} AS min_score, {r6('max(f1)')} AS max_score, "
            f"CAST(rank() OVER (ORDER BY avg(f1) DESC) AS INTEGER) AS rank FROM {scores} GROUP BY param")


@register("cv_scores_mnb", _cv_sql("multinomial", (1.0,)) + f"\nSELECT {r6('param')} AS param, fold, {r6('f1')} AS f1 FROM scores")
def q_cv_scores_mnb(spark, sf_dir):
    return round_doubles(_cv_scores(spark, sf_dir))


@register("cv_stats", _cv_sql("multinomial", (1.0,)) + "\n" + _rank_sql("scores"))
def q_cv_stats(spark, sf_dir):
    from textsieve.operators import bayes

    return round_doubles(bayes.grid_ranking(_cv_scores(spark, sf_dir)))


@register("grid_mnb", _cv_sql("multinomial", GRID_ALPHA) + "\n" + _rank_sql("scores"))
def q_grid_mnb(spark, sf_dir):
    from textsieve.operators import bayes

    return round_doubles(bayes.grid_ranking(_cv_scores(spark, sf_dir, "multinomial", GRID_ALPHA)))


@register("grid_bnb", _cv_sql("bernoulli", GRID_ALPHA) + "\n" + _rank_sql("scores"))
def q_grid_bnb(spark, sf_dir):
    from textsieve.operators import bayes

    return round_doubles(bayes.grid_ranking(_cv_scores(spark, sf_dir, "bernoulli", GRID_ALPHA)))


NB_MODELS = [("Multinomial Naive Bayes", "multinomial", "mnb"), ("Bernoulli Naive Bayes", "bernoulli", "bnb"),
             ("Gaussian Naive Bayes", "gaussian", "gnb")]


def nb_results(spark, sf_dir) -> DataFrame:
    """One row per model: ``(model, ord, error, accuracy, precision, recall, f1)``."""
    out = None
    for i, (name, kind, _) in enumerate(NB_MODELS):
        m = evaluate.binary_metrics(nb_scored(spark, sf_dir, kind)).select(
            F.lit(name).alias("model"), F.lit(i).alias("ord"), F.lit(None).cast("string").alias("error"), "*")
        out = m if out is None else out.unionByName(m)
    return out


_RESULTS_SQL = f"WITH {_TRAIN},\n" + ",\n".join(S.nb_ctes(k, name=s) for _, k, s in NB_MODELS) + ",\nresults AS (" + \
    " UNION ALL ".join(
        f"SELECT '{n}' AS model, {i} AS ord, "
        f"coalesce(CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) / nullif(count(*), 0), 0.0) AS accuracy, "
        f"coalesce(CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE prediction = 1), 0), 0.0) AS precision, "
        f"coalesce(CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE label = 1), 0), 0.0) AS recall, "
        f"coalesce(2.0 * count(*) FILTER (WHERE label = 1 AND prediction = 1) / nullif(2 * count(*) FILTER (WHERE label = 1 AND prediction = 1) "
        f"+ count(*) FILTER (WHERE label = 0 AND prediction = 1) + count(*) FILTER (WHERE label = 1 AND prediction = 0), 0), 0.0) AS f1 "
        f"FROM {s}_scored" for i, (n, _, s) in enumerate(NB_MODELS)) + ")\n"


@register("best_model", _RESULTS_SQL + f"SELECT model, {r6('f1')} AS f1 FROM results ORDER BY f1 DESC, ord LIMIT 1")
def q_best_model(spark, sf_dir):
    from textsieve.operators import rank

    return round_doubles(rank.best_model(nb_results(spark, sf_dir), "f1").select("model", "f1"))


@register("model_comparison", _RESULTS_SQL + f"SELECT model, {r6('f1')} AS value FROM results")
def q_model_comparison(spark, sf_dir):
    from textsieve.operators import rank

    return round_doubles(rank.model_comparison(nb_results(spark, sf_dir), "f1"))


@register("top_coefficients", f"""WITH {_TRAIN},
{S.nb_ctes('multinomial')},
wt AS (SELECT term, w1 - w0 AS weight FROM nb_params),
sp AS (SELECT 'spam' AS side, row_number() OVER (ORDER BY weight DESC, term) AS rank, term AS feature, weight FROM wt),
hm AS (SELECT 'ham' AS side, row_number() OVER (ORDER BY weight ASC, term) AS rank, term AS feature, weight FROM wt)
SELECT side, CAST(rank AS INTEGER) AS rank, feature, {r6('weight')} AS weight FROM sp WHERE rank <= 20
UNION ALL SELECT side, CAST(rank AS INTEGER), feature, {r6('weight')} FROM hm WHERE rank <= 20""")
def q_top_coefficients(spark, sf_dir):
    from textsieve.operators import rank

    return round_doubles(rank.top_weights(nb_model(spark, sf_dir).term_weights(), 20))


_WORDS = S.remove_stop(S.tokenize(S.clean("message")))


@register("top_terms_by_class", f"""
WITH cnt AS (SELECT label, term, count(*) AS n FROM (SELECT label, unnest({_WORDS}) AS term FROM ({S.BASE}))
             GROUP BY label, term),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, term) AS rank FROM cnt)
SELECT label, CAST(rank AS INTEGER) AS rank, term, n, {r6('CAST(n AS DOUBLE) / max(n) OVER (PARTITION BY label)')} AS weight
FROM rk WHERE rank <= 200""")
def q_top_terms_by_class(spark, sf_dir):
    from textsieve.operators import rank

    return round_doubles(rank.term_frequency_by_class(train.labelled_messages(spark, sf_dir), "message", "label", 200))


def _ll_sql(k, n, x):
    k, n, x = f"({k})", f"({n})", f"({x})"
    return f"(CASE WHEN {k} > 0 THEN {k} * ln({x}) ELSE 0.0 END + CASE WHEN {n} - {k} > 0 THEN ({n} - {k}) * ln(1 - {x}) ELSE 0.0 END)"


_G2 = ("2.0 * (" + _ll_sql("n12", "n1", "n12 / n1") + " + " + _ll_sql("n2 - n12", "N - n1", "(n2 - n12) / (N - n1)")
       + " - " + _ll_sql("n12", "n1", "n2 / N") + " - " + _ll_sql("n2 - n12", "N - n1", "n2 / N") + ")")


@register("bigram_collocations", f"""
WITH docs AS (SELECT label, {_WORDS} AS t FROM ({S.BASE})),
pairs AS (SELECT label, t[i] AS w1, t[i + 1] AS w2 FROM (SELECT label, t, unnest(range(1, len(t))) AS i FROM docs)),
bi AS (SELECT label, w1, w2, count(*) AS n12 FROM pairs GROUP BY label, w1, w2 HAVING count(*) >= 2),
uni AS (SELECT label, term, count(*) AS n FROM (SELECT label, unnest(t) AS term FROM docs) GROUP BY label, term),
tot AS (SELECT label, sum(n) AS N FROM uni GROUP BY label),
j AS (SELECT b.label, b.w1, b.w2, CAST(b.n12 AS DOUBLE) AS n12, CAST(u1.n AS DOUBLE) AS n1, CAST(u2.n AS DOUBLE) AS n2,
             CAST(t.N AS DOUBLE) AS N
      FROM bi b JOIN uni u1 ON b.label = u1.label AND b.w1 = u1.term JOIN uni u2 ON b.label = u2.label AND b.w2 = u2.term
      JOIN tot t ON b.label = t.label),
sc AS (SELECT label, w1, w2, CAST(n12 AS BIGINT) AS n12, {_G2} AS g2 FROM j),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(g2, 9) DESC, w1, w2) AS rank FROM sc)
SELECT label, CAST(rank AS INTEGER) AS rank, w1, w2, n12, {r6('g2')} AS g2 FROM rk WHERE rank <= 50""")
def q_bigram_collocations(spark, sf_dir):
    from textsieve.operators import rank

    return round_doubles(rank.bigram_collocations(train.labelled_messages(spark, sf_dir), "message", "label", 50, 2))


# --- scoring conversations with the multinomial bundle ----------------------

def predictor(spark, sf_dir):
    from textsieve.plans.predict import Predictor

    td = training(spark, sf_dir)
    return Predictor(nb_model(spark, sf_dir), td.vocab, td.options)


def conversation_predictions(spark, sf_dir) -> DataFrame:
    conv = tbl(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return predictor(spark, sf_dir).transform(conv, "text", ("conv_id", "turn"))


_PRED_SQL = f"""WITH {_TRAIN},
{S.nb_ctes('multinomial')},
cv AS (SELECT conv_id, turn, text FROM conversations),
cv_counts AS (SELECT conv_id, turn, term, count(*) AS tf
              FROM (SELECT conv_id, turn, unnest({S.analyzer(S.clean('text'))}) AS term FROM cv) GROUP BY conv_id, turn, term),
cv_x AS (SELECT c.conv_id, c.turn, v.term, c.tf * v.idf AS x FROM cv_counts c JOIN vocab v ON c.term = v.term),
cv_f AS (SELECT conv_id, turn, term, x / sqrt(sum(x * x) OVER (PARTITION BY conv_id, turn)) AS value FROM cv_x),
cv_s AS (SELECT f.conv_id, f.turn, sum(f.value * p.w0) AS s0, sum(f.value * p.w1) AS s1
         FROM cv_f f JOIN nb_params p ON f.term = p.term GROUP BY f.conv_id, f.turn),
cv_raw AS (SELECT c.conv_id, c.turn, c.text, k.k0 + coalesce(s.s0, 0) AS score0, k.k1 + coalesce(s.s1, 0) AS score1
           FROM cv c LEFT JOIN cv_s s ON c.conv_id = s.conv_id AND c.turn = s.turn, nb_const k),
preds AS (SELECT conv_id, turn, text, CASE WHEN score1 > score0 THEN 1 ELSE 0 END AS prediction,
                 CASE WHEN score1 > score0 THEN 'spam' ELSE 'ham' END AS label,
                 exp(score1 - greatest(score0, score1)) / (exp(score0 - greatest(score0, score1))
                   + exp(score1 - greatest(score0, score1))) AS probability FROM cv_raw),
preds2 AS (SELECT *, greatest(probability, 1 - probability) AS confidence FROM preds)
"""


@register("predict_batch", _PRED_SQL + f"""SELECT conv_id, turn, {S.clean('text')} AS preprocessed_text, prediction,
  label, {r6('probability')} AS probability, {r6('confidence')} AS confidence FROM preds2""")
def q_predict_batch(spark, sf_dir):
    return round_doubles(conversation_predictions(spark, sf_dir).select(
        "conv_id", "turn", "preprocessed_text", "prediction", "label", "probability", "confidence"))


@register("prediction_counts", _PRED_SQL + "SELECT label, count(*) AS n FROM preds2 GROUP BY label")
def q_prediction_counts(spark, sf_dir):
    from textsieve.plans.predict import prediction_counts

    return prediction_counts(conversation_predictions(spark, sf_dir))


@register("format_result", _PRED_SQL + """SELECT conv_id, turn,
  'Classification: ' || upper(label) || ' (Confidence: ' || printf('%.2f', confidence) || ')' || chr(10) || 'Text: ' ||
  CASE WHEN length(coalesce(text, '')) > 100 THEN substr(coalesce(text, ''), 1, 97) || '...' ELSE coalesce(text, '') END
  AS formatted FROM preds2""")
def q_format_result(spark, sf_dir):
    from textsieve.plans.predict import format_result

    p = conversation_predictions(spark, sf_dir)
    return p.select("conv_id", "turn", format_result(p, "text").alias("formatted"))


_EDGE = f"^[{T.WHITESPACE_CLASS}]+|[{T.WHITESPACE_CLASS}]+$"


@register("message_lines", f"""
SELECT conv_id, turn, CAST(line_no AS INTEGER) AS line_no, line FROM (
  SELECT conv_id, turn, line_no, regexp_replace(raw, {S.q(_EDGE)}, '', 'g') AS line FROM (
    SELECT conv_id, turn, unnest(parts) AS raw, generate_subscripts(parts, 1) AS line_no
    FROM (SELECT conv_id, turn, regexp_split_to_array(text, {S.q(chr(13) + chr(10) + '|' + chr(13) + '|' + chr(10))}) AS parts
          FROM conversations)))
WHERE line <> ''""")
def q_message_lines(spark, sf_dir):
    from textsieve.sources.io import message_lines

    return message_lines(tbl(spark, sf_dir, "conversations"), "text", keep=("conv_id", "turn"))


# --- lemmatizing by dictionary join (lexicon = the corpus's own words) ------

def _word_terms_sql() -> str:
    return f"SELECT DISTINCT term FROM (SELECT unnest({S.remove_stop(S.tokenize(S.clean('text')))}) AS term FROM documents)"


_LEMMA_SQL = f"""
terms AS ({_word_terms_sql()}),
cands AS (SELECT term, c.ord AS ord, c.cand AS cand FROM (SELECT term, unnest({S.lemma_rules_sql('term')}) AS c FROM terms)),
hits AS (SELECT c.* FROM cands c SEMI JOIN terms t ON c.cand = t.term),
lemmas AS (SELECT term, cand AS lemma FROM (
  SELECT *, row_number() OVER (PARTITION BY term ORDER BY length(cand), ord) AS rn FROM hits) WHERE rn = 1)"""


@register("lemma_join", f"WITH {_LEMMA_SQL}\nSELECT t.term, coalesce(l.lemma, t.term) AS lemma FROM terms t LEFT JOIN lemmas l ON t.term = l.term")
def q_lemma_join(spark, sf_dir):
    from textsieve.functions.morph import lemma_map

    docs = tbl(spark, sf_dir, "documents")
    terms = docs.select(F.explode(T.preprocess_tokens("text")).alias("term")).distinct()
    m = lemma_map(terms, terms)
    return terms.join(m, "term", "left").select("term", F.coalesce("mapped", "term").alias("lemma"))


@register("preprocess_text", f"""WITH {_LEMMA_SQL},
toks AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos
         FROM (SELECT doc_id, {S.remove_stop(S.tokenize(S.clean('text')))} AS t FROM documents))
SELECT d.doc_id, coalesce(p.txt, '') AS preprocessed_text FROM documents d LEFT JOIN (
  SELECT k.doc_id, string_agg(coalesce(l.lemma, k.term), ' ' ORDER BY k.pos) AS txt
  FROM toks k LEFT JOIN lemmas l ON k.term = l.term GROUP BY k.doc_id) p ON d.doc_id = p.doc_id""")
def q_preprocess_text(spark, sf_dir):
    docs = tbl(spark, sf_dir, "documents").select("doc_id", "text")
    return T.preprocess_text(docs, "text", "preprocessed_text", "doc_id").select("doc_id", "preprocessed_text")


@register("stem_vocab")
def q_stem_vocab(spark, sf_dir):
    """Porter stems of the distinct words (rows only: no SQL stemmer)."""
    from textsieve.functions.morph import stem_map

    docs = tbl(spark, sf_dir, "documents")
    terms = docs.select(F.explode(T.preprocess_tokens("text")).alias("term")).distinct()
    return stem_map(terms).select("term", F.col("mapped").alias("stem"))


# --- pyspark.ml models (rows-only checks: iterative fits) -------------------

def fitted(spark, sf_dir, name: str, params: dict | None = None):
    """A model of the registry fitted on the shared training data."""
    key = (id(spark), sf_dir, "model", name, str(params))
    if key not in _FITS:
        from textsieve.plans import models

        _FITS[key] = models.create_model(name, params).fit(training(spark, sf_dir))
    return _FITS[key]


def _ml_query(name: str, params: dict | None = None):
    def q(spark, sf_dir):
        from textsieve.plans import models

        return round_doubles(models.scored(fitted(spark, sf_dir, name, params), training(spark, sf_dir)))

    return q


# Each with the registry's own defaults.
for _q, _name in (("logistic_regression", "Logistic Regression"), ("linear_svc_platt", "Support Vector Machine"),
                  ("random_forest", "Random Forest"), ("gbt", "Gradient Boosting"), ("mlp", "Neural Network")):
    register(_q)(_ml_query(_name))


# --- decision trees (F7): whole trees, equal to a recursive query ---------------

def _tree_sql(select: str, **params) -> str:
    return f"WITH RECURSIVE {_TRAIN},\n{S.tree_ctes(bins=trees.BINS, **params)}\n{select}"


_TREE_SCORES = f"SELECT row_id, label, CAST(prediction AS INTEGER) AS prediction, {r6('probability')} AS probability FROM tree_scored"
_ENTROPY = {"criterion": "entropy", "min_samples_split": 5, "min_samples_leaf": 2, "max_depth": 10}

register("decision_tree", _tree_sql(_TREE_SCORES))(_ml_query("Decision Tree"))
register("decision_tree_entropy", _tree_sql(_TREE_SCORES, **_ENTROPY))(_ml_query("Decision Tree", _ENTROPY))


@register("tree_nodes", _tree_sql(f"""SELECT path, term, bin, CAST(n AS BIGINT) AS n, {r6('w0')} AS w0, {r6('w1')} AS w1,
       {r6('gain')} AS gain FROM tree_nodes"""))
def q_tree_nodes(spark, sf_dir):
    """every node of the tree with its term, its least bin to the right, counts and impurity decrease."""
    td = training(spark, sf_dir)
    nodes = fitted(spark, sf_dir, "Decision Tree").nodes.join(F.broadcast(td.vocab.select("term_id", "term")), "term_id", "left")
    return round_doubles(nodes.select("path", "term", "bin", F.col("n").cast("bigint").alias("n"), "w0", "w1", "gain"))


@register("grid_search_trees")
def q_grid_search_trees(spark, sf_dir):
    """the whole grid of decision trees, 180 points by five folds, one growth a fold."""
    from textsieve.plans import models

    res, _ = models.grid_search("Decision Tree", training(spark, sf_dir), models.REGISTRY["Decision Tree"].grid)
    return round_doubles(res)


@register("tree_importances")
def q_tree_importances(spark, sf_dir):
    from textsieve.operators import rank

    model = fitted(spark, sf_dir, "Random Forest")
    return round_doubles(rank.top_importances(model.importances(training(spark, sf_dir).vocab), 20))


@register("lr_coefficients")
def q_lr_coefficients(spark, sf_dir):
    """W6 of a linear model."""
    from textsieve.plans.predict import Predictor

    td = training(spark, sf_dir)
    return round_doubles(Predictor(fitted(spark, sf_dir, "Logistic Regression"), td.vocab, td.options).top_features(20))


@register("grid_search_ml")
def q_grid_search_ml(spark, sf_dir):
    """the whole grid of logistic regression, 32 points."""
    from textsieve.plans import models

    res, _ = models.grid_search("Logistic Regression", training(spark, sf_dir), models.REGISTRY["Logistic Regression"].grid)
    return round_doubles(res)


for _q, _kernel in (("svm_rbf", "rbf"), ("svm_poly", "poly")):
    register(_q)(_ml_query("Support Vector Machine", {"kernel": _kernel}))


_GRID_GNB = (1e-9, 1e-8, 1e-7, 1e-6, 1e-5)


def _cv_gnb_sql(grid) -> str:
    """Held-out F1 of Gaussian Naive Bayes by (param, fold): sums and sums of squares of the other folds' rows."""
    g = ", ".join(f"CAST({a} AS DOUBLE)" for a in grid)
    head = _cv_sql("multinomial", grid).split("ft AS (")[0]
    x, q = "ff.weight * ff.value", "ff.weight * ff.value * ff.value"
    sums = ", ".join(f"coalesce(sum(CASE WHEN ff.label = {c} THEN {e} END), 0) AS {n}{c}" for n, e in (("x", x), ("q", q)) for c in (0, 1))
    rest = ", ".join(f"sum({n}) OVER (PARTITION BY term) - {n} AS {n}" for n in ("x0", "x1", "q0", "q1"))
    tail = _cv_sql("multinomial", grid).split("sc AS (", 1)[1]
    return head + f"""
ft AS (SELECT v.term, fo.fold, {sums}
       FROM vocab v CROSS JOIN (SELECT unnest(range(5)) AS fold) fo
       LEFT JOIN ff ON ff.term = v.term AND ff.fold = fo.fold GROUP BY v.term, fo.fold),
tt AS (SELECT term, fold, {rest} FROM ft),
ccf AS (SELECT fold, sum(CASE WHEN label = 0 THEN weight ELSE 0 END) AS h0,
               sum(CASE WHEN label = 1 THEN weight ELSE 0 END) AS h1 FROM folds GROUP BY fold),
cct AS (SELECT fold, (SELECT c0 FROM cc) - h0 AS c0, (SELECT c1 FROM cc) - h1 AS c1 FROM ccf),
mv AS (SELECT tt.fold, term, x0 / c0 AS m0, x1 / c1 AS m1, greatest(q0 / c0 - (x0 / c0) * (x0 / c0), 0) AS v0,
              greatest(q1 / c1 - (x1 / c1) * (x1 / c1), 0) AS v1,
              greatest((q0 + q1) / (c0 + c1) - ((x0 + x1) / (c0 + c1)) * ((x0 + x1) / (c0 + c1)), 0) AS va
       FROM tt JOIN cct ON tt.fold = cct.fold),
ev AS (SELECT g.param, mv.fold, g.param * max(va) AS eps FROM mv, grid g GROUP BY g.param, mv.fold),
prm AS (SELECT ev.param, mv.fold, term, m0 / (v0 + eps) AS w0, m1 / (v1 + eps) AS w1, -0.5 / (v0 + eps) AS u0, -0.5 / (v1 + eps) AS u1,
               -0.5 * ln(2 * pi() * (v0 + eps)) - 0.5 * m0 * m0 / (v0 + eps) AS k0,
               -0.5 * ln(2 * pi() * (v1 + eps)) - 0.5 * m1 * m1 / (v1 + eps) AS k1
        FROM mv JOIN ev ON mv.fold = ev.fold),
kst AS (SELECT p.param, p.fold, ln(c.c0 / (c.c0 + c.c1)) + sum(p.k0) AS k0, ln(c.c1 / (c.c0 + c.c1)) + sum(p.k1) AS k1
        FROM prm p JOIN cct c ON p.fold = c.fold GROUP BY p.param, p.fold, c.c0, c.c1),
sums AS (SELECT p.param, ff.fold, ff.row_id, sum(ff.value * p.w0 + ff.value * ff.value * p.u0) AS s0,
                sum(ff.value * p.w1 + ff.value * ff.value * p.u1) AS s1
         FROM ff JOIN prm p ON ff.fold = p.fold AND ff.term = p.term GROUP BY p.param, ff.fold, ff.row_id),
sc AS ({tail}"""


@register("grid_gnb", _cv_gnb_sql(_GRID_GNB) + f"""
SELECT CAST(round(log10(param)) AS INTEGER) AS log_smoothing, {r6('avg(f1)')} AS mean_score, {r6('stddev_pop(f1)')} AS std_score,
       {r6('min(f1)')} AS min_score, {r6('max(f1)')} AS max_score FROM scores GROUP BY param""")
def q_grid_gnb(spark, sf_dir):
    """F17/F18 of Gaussian Naive Bayes over its whole grid; ``log_smoothing`` is the decimal logarithm of the parameter."""
    from textsieve.plans import models

    res, _ = models.grid_search("Gaussian Naive Bayes", training(spark, sf_dir), {"var_smoothing": list(_GRID_GNB)})
    smoothing = F.regexp_extract("params", ": ([^}]+)", 1).cast("double")
    return round_doubles(res.select(F.round(F.log10(smoothing)).cast("int").alias("log_smoothing"), "mean_score", "std_score",
                                    "min_score", "max_score"))


def _scaled_long(td) -> tuple[DataFrame, DataFrame]:
    """Training and test features divided by the training rows' standard deviations: every SVM is fitted on these."""
    from textsieve.operators import bayes

    std = F.broadcast(bayes.scale_std(td.feats_train, td.docs_train, td.vocab))
    div = lambda df: df.join(std, "term").withColumn("value", F.col("value") / F.col("std")).drop("std")
    return div(td.feats_train), div(td.feats_test)


@register("kernel_features", f"""WITH {_TRAIN},
u AS (SELECT term, j, ({S.md5_int('term', 'j', "'u'")} + 0.5) / 4294967296.0 AS u1,
             ({S.md5_int('term', 'j', "'v'")} + 0.5) / 4294967296.0 AS u2
      FROM vocab, (SELECT unnest(range(0, 100)) AS j)),
g AS (SELECT 1.0 / (v * (ss / (n * v) - (s / (n * v)) * (s / (n * v)))) AS gamma FROM (
        SELECT sum(value) AS s, sum(value * value) AS ss, (SELECT count(*) FROM weights) AS n, (SELECT count(*) FROM vocab) AS v FROM ftr)),
w AS (SELECT term, j, sqrt(-2.0 * ln(u1)) * cos(2.0 * pi() * u2) * sqrt(2.0 * gamma) AS w FROM u, g),
p AS (SELECT f.row_id, w.j, sum(f.value * w.w) AS p FROM ftr f JOIN w ON f.term = w.term GROUP BY f.row_id, w.j)
SELECT t.row_id, CAST(b.j AS INTEGER) AS j,
       {r6("sqrt(2.0 / 100) * cos(coalesce(p.p, 0.0) + 2.0 * pi() * (" + S.md5_int('b.j', "'b'") + " + 0.5) / 4294967296.0)")} AS value
FROM weights t CROSS JOIN (SELECT unnest(range(0, 100)) AS j) b LEFT JOIN p ON p.row_id = t.row_id AND p.j = b.j""")
def q_kernel_features(spark, sf_dir):
    from textsieve.plans import kernels

    td = training(spark, sf_dir)
    g = kernels.gamma_value("scale", td.feats_train, td.docs_train.count(), td.vocab.count())
    return round_doubles(kernels.rff_features(td.feats_train, td.docs_train, td.vocab, 100, g))


@register("kernel_svc")
def q_kernel_svc(spark, sf_dir):
    from textsieve.plans import kernels

    td = training(spark, sf_dir)
    tr, te = _scaled_long(td)
    svc, g = kernels.fit_kernel_svc(tr, td.docs_train, td.vocab, 1.0, "scale")
    te = kernels.rff_vectors(te, td.docs_test, td.vocab, 100, g).join(td.docs_test, "row_id")
    return svc.transform(te).select("row_id", "label", F.col("prediction").cast("int").alias("prediction"))


# --- k nearest neighbours (F9, J5) -------------------------------------------

def _knn_ctes(k: int, p: int) -> str:
    """Distances of all pairs of test and training rows, and the nearest ``k`` copies of each test row."""
    norm, part = ("sum(v)", "least(a.v, b.v)") if p == 1 else ("sum(v * v)", "a.v * b.v")
    std = "sqrt(greatest(sxx / n - (sx / n) * (sx / n), 0.0))"
    return f"""{_TRAIN},
st AS (SELECT term, sum(weight * value) AS sx, sum(weight * value * value) AS sxx FROM ftr GROUP BY term),
sd AS (SELECT term, CASE WHEN {std} > 0 THEN {std} ELSE 1.0 END AS std FROM st, (SELECT sum(weight) AS n FROM weights)),
zx AS (SELECT row_id, term, value / std AS v FROM ftr JOIN sd USING (term)),
zq AS (SELECT row_id, term, value / std AS v FROM fte JOIN sd USING (term)),
nx AS (SELECT row_id, {norm} AS n FROM zx GROUP BY row_id),
nq AS (SELECT row_id, {norm} AS n FROM zq GROUP BY row_id),
met AS (SELECT a.row_id AS q, b.row_id AS x, sum({part}) AS s FROM zq a JOIN zx b ON a.term = b.term GROUP BY a.row_id, b.row_id),
far AS (SELECT t.row_id AS q, w.row_id AS x, w.label, w.weight,
               round(greatest(coalesce(nq.n, 0) + coalesce(nx.n, 0) - 2 * coalesce(met.s, 0), 0.0), 6) AS far
        FROM test_docs t CROSS JOIN weights w LEFT JOIN nq ON nq.row_id = t.row_id LEFT JOIN nx ON nx.row_id = w.row_id
        LEFT JOIN met ON met.q = t.row_id AND met.x = w.row_id),
seen AS (SELECT *, sum(weight) OVER o - weight AS before, row_number() OVER o AS rank FROM far
         WINDOW o AS (PARTITION BY q ORDER BY far, x ROWS UNBOUNDED PRECEDING)),
near AS (SELECT q, x, label, {"far" if p == 1 else "sqrt(far)"} AS distance, least(weight, {k} - before) AS copies, rank
         FROM seen WHERE before < {k})"""


def _knn_score_sql(k: int, weights: str, p: int) -> str:
    vote = "copies" if weights == "uniform" else (
        "CASE WHEN min(distance) OVER (PARTITION BY q) > 0 THEN copies / distance WHEN distance = 0 THEN copies ELSE 0 END")
    return f"""WITH {_knn_ctes(k, p)},
votes AS (SELECT q, label, {vote} AS vote FROM near),
prob AS (SELECT q, sum(CASE WHEN label = 1 THEN vote ELSE 0 END) / sum(vote) AS probability FROM votes GROUP BY q)
SELECT t.row_id, t.label, CAST(CASE WHEN round(probability, 12) > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
       {r6('probability')} AS probability
FROM test_docs t JOIN prob ON prob.q = t.row_id"""


@register("knn_neighbours", f"""WITH {_knn_ctes(5, 2)}
SELECT q AS row_id, x AS neighbour, label, {r6('distance')} AS distance, copies, CAST(rank AS INTEGER) AS rank FROM near""")
def q_knn_neighbours(spark, sf_dir):
    """The five nearest training copies of every test row."""
    td = training(spark, sf_dir)
    return round_doubles(fitted(spark, sf_dir, "K-Nearest Neighbors").neighbours(td.docs_test, td.feats_test))


def _knn_query(**params):
    def q(spark, sf_dir):
        from textsieve.plans import models

        return round_doubles(models.scored(fitted(spark, sf_dir, "K-Nearest Neighbors", params or None), training(spark, sf_dir)))

    return q


register("knn_score", _knn_score_sql(5, "uniform", 2))(_knn_query())
register("knn_score_manhattan", _knn_score_sql(7, "distance", 1))(_knn_query(n_neighbors=7, weights="distance", p=1))


def recommended_run(spark, sf_dir):
    """The default run's models, fitted once."""
    key = (id(spark), sf_dir, "run")
    if key not in _FITS:
        from textsieve.plans import run

        _FITS[key] = run.train_models(None, td=training(spark, sf_dir))
    return _FITS[key]


@register("model_results")
def q_model_results(spark, sf_dir):
    """F15 + A12: the four recommended models fitted and evaluated in turn, with training time and AUC."""
    return round_doubles(recommended_run(spark, sf_dir).results)


@register("nb_results", _RESULTS_SQL + f"""SELECT model, CAST(ord AS INTEGER) AS ord, {r6('accuracy')} AS accuracy,
  {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1 FROM results WHERE ord < 2""")
def q_nb_results(spark, sf_dir):
    """The Naive Bayes rows of ``model_results``, through the same estimators."""
    from textsieve.plans import models, run

    names = [n for n in models.RECOMMENDED if n.endswith("Naive Bayes")]
    return round_doubles(run.train_models(None, names, td=training(spark, sf_dir)).results.select(
        "model", "ord", "accuracy", "precision", "recall", "f1"))


LEAKY_RESULTS_SQL = f"""WITH {S.training_ctes_leaky(Options(leaky_order=True))},
""" + ",\n".join(S.nb_ctes(k, name=s) for _, k, s in NB_MODELS[:2]) + ",\nresults AS (" + " UNION ALL ".join(
    f"""SELECT '{n}' AS model, {i} AS ord, sum(CASE WHEN s.label = s.prediction THEN t.weight ELSE 0 END) / sum(t.weight) AS accuracy,
  sum(CASE WHEN s.label = 1 AND s.prediction = 1 THEN t.weight ELSE 0 END) AS tp,
  sum(CASE WHEN s.prediction = 1 THEN t.weight ELSE 0 END) AS pp, sum(CASE WHEN s.label = 1 THEN t.weight ELSE 0 END) AS p
  FROM {s}_scored s JOIN test_docs t ON s.row_id = t.row_id""" for i, (n, _, s) in enumerate(NB_MODELS[:2])) + ")"


@register("nb_results_leaky", LEAKY_RESULTS_SQL + f"""
SELECT model, CAST(ord AS INTEGER) AS ord, {r6('accuracy')} AS accuracy, {r6('coalesce(tp / nullif(pp, 0), 0.0)')} AS precision,
       {r6('coalesce(tp / nullif(p, 0), 0.0)')} AS recall, {r6('coalesce(2 * tp / nullif(pp + p, 0), 0.0)')} AS f1 FROM results""")
def q_nb_results_leaky(spark, sf_dir):
    """F15/F16 in the reference's order: held-out copies count in every metric."""
    from textsieve.plans import models, run

    names = [n for n in models.RECOMMENDED if n.endswith("Naive Bayes")]
    return round_doubles(run.train_models(None, names, td=training(spark, sf_dir, Options(leaky_order=True))).results.select(
        "model", "ord", "accuracy", "precision", "recall", "f1"))


@register("curves_by_model")
def q_curves_by_model(spark, sf_dir):
    """The ROC curve of a model of the run, by its name."""
    return round_doubles(recommended_run(spark, sf_dir).curves("Logistic Regression")["roc_curve"])


@register("default_run")
def q_default_run(spark, sf_dir):
    """The whole default run: results, the saved best model, its registry entry and the run summary read back."""
    from textsieve.plans import predict, run

    path = _scratch(spark, "run")
    base = train.labelled_messages(spark, sf_dir)
    run.default_run(base, path, run=recommended_run(spark, sf_dir))
    entry = predict.latest_model(spark.read.parquet(f"{path}/registry"))
    saved = spark.read.json(f"{path}/summary/models").where("is_best").select("model", "f1", "training_time")
    info = spark.read.json(f"{path}/summary/dataset").select("n_rows", "n_spam", "n_ham")
    return round_doubles(entry.select("name").join(saved, F.col("name") == F.col("model")).join(F.broadcast(info)).select(
        "model", "f1", (F.col("training_time") > 0).alias("was_timed"), "n_rows", "n_spam", "n_ham"))


# --- streaming: the stream of conversation turns scored as it arrives -------

def _stream_scored(spark, sf_dir) -> str:
    """Run ST1 over the conversation turns (read as a file stream) and return
    the folder of scored rows."""
    import uuid

    from textsieve.streaming import score as st

    src = st.stream_table(spark, sf_dir, "conversations", tbl(spark, sf_dir, "conversations").schema)
    base = st.stream_checkpoint(spark, f"score-{uuid.uuid4().hex[:8]}")
    st.score_stream(src.select("conv_id", "turn", "text"), predictor(spark, sf_dir), f"{base}/out", f"{base}/ckpt",
                    "text", ("conv_id", "turn"))
    return f"{base}/out"


@register("stream_score", ORACLE["predict_batch"])
def q_stream_score(spark, sf_dir):
    """ST1: equals ``predict_batch``."""
    out = _stream_scored(spark, sf_dir)
    return round_doubles(spark.read.parquet(out).select("conv_id", "turn", "preprocessed_text", "prediction",
                                                        "label", "probability", "confidence"))


@register("stream_append", ORACLE["predict_batch"])
def q_stream_append(spark, sf_dir):
    """ST1 in append mode: the same rows again."""
    from textsieve.streaming import score as st

    src = st.stream_table(spark, sf_dir, "conversations", tbl(spark, sf_dir, "conversations").schema)
    base = st.stream_checkpoint(spark, "append")
    st.append_stream(src.select("conv_id", "turn", "text"), predictor(spark, sf_dir), f"{base}/out", f"{base}/ckpt", "text",
                     ("conv_id", "turn"))
    return round_doubles(spark.read.parquet(f"{base}/out").select(
        "conv_id", "turn", "preprocessed_text", "prediction", "label", "probability", "confidence"))


@register("stream_counts", ORACLE["prediction_counts"])
def q_stream_counts(spark, sf_dir):
    """ST2: running prediction counts; at the end of the input they equal the batch counts."""
    import uuid

    from textsieve.streaming import score as st

    out = _stream_scored(spark, sf_dir)
    schema = spark.read.parquet(out).schema
    state = st.stream_checkpoint(spark, f"counts-{uuid.uuid4().hex[:8]}")
    st.scored_stream_counts(spark, out, schema, f"{state}/counts", f"{state}/ckpt")
    return st.running_counts(spark, f"{state}/counts")


# --- round trips through sinks and sources (rows only) ----------------------

def _scratch(spark, name: str) -> str:
    import uuid

    from textsieve.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_scan_roundtrip", f"""SELECT label, regexp_replace(message, chr(13), '', 'g') AS message
FROM ({ENC_SQL}) WHERE label IS NOT NULL AND message IS NOT NULL""")
def q_csv_scan_roundtrip(spark, sf_dir):
    """S1 -> P5: the raw message table written as a header CSV (quoted,
    multi-line texts, junk columns), read back with an explicit schema and
    preprocessed: ``(label, message)``."""
    from textsieve.sources import io

    raw = raw_messages(spark, sf_dir).select("v1", "v2", F.lit(None).cast("string").alias("_c2"),
                                             F.lit(None).cast("string").alias("_c3"))
    path = _scratch(spark, "csv")
    # the older files are ISO-8859-1, which cannot hold all characters of these texts
    raw.write.option("header", True).option("escape", '"').option("quote", '"').option("encoding", "UTF-8") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "") \
        .mode("overwrite").csv(path)
    out = io.load_and_preprocess(spark, path, encoding="UTF-8")
    return out.withColumn("message", F.regexp_replace("message", "\r", ""))


@register("strict_scan", f"""SELECT v1, regexp_replace(v2, chr(13), '', 'g') AS v2
FROM ({RAW_SQL}) WHERE v1 IS NOT NULL AND v2 IS NOT NULL""")
def q_strict_scan(spark, sf_dir):
    """The older scan of a CSV with exactly the named columns and three junk ones."""
    from textsieve.sources import io

    junk = [F.lit(None).cast("string").alias(f"_c{i}") for i in (2, 3, 4)]
    path = _scratch(spark, "strict")
    raw_messages(spark, sf_dir).select("v1", "v2", *junk).write.options(
        header=True, escape='"', quote='"', encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        emptyValue="").csv(path)
    out = io.load_csv_strict(spark, path, encoding="UTF-8").where("v1 is not null and v2 is not null")
    return out.select("v1", F.regexp_replace("v2", "\r", "").alias("v2"))


@register("sparse_vectors", f"WITH {_TRAIN}\nSELECT row_id, term, {r6('value')} AS value FROM ftr")
def q_sparse_vectors(spark, sf_dir):
    """The vectors that ``pyspark.ml`` models are fitted on, taken apart, their places named by the vocabulary."""
    from textsieve.plans import models

    td = training(spark, sf_dir)
    rows = models.vectors(td.docs_train.select("row_id"), td.feats_train, td.vocab.count())
    stored = F.from_json(F.to_json(F.struct("features")), "features struct<indices: array<int>, values: array<double>>")
    long = rows.select("row_id", stored["features"].alias("f")).select("row_id", F.explode(F.arrays_zip("f.indices", "f.values")).alias("e"))
    long = long.select("row_id", F.col("e.indices").cast("long").alias("term_id"), F.col("e.values").alias("value"))
    return round_doubles(long.join(F.broadcast(td.vocab.select("term_id", "term")), "term_id").select("row_id", "term", "value"))


@register("bundle_roundtrip", _PRED_SQL + f"""SELECT conv_id, turn, prediction, label, {r6('probability')} AS probability,
  {r6('confidence')} AS confidence FROM preds2""")
def q_bundle_roundtrip(spark, sf_dir):
    """Save the fitted bundle, load it, score the conversations."""
    from textsieve.plans.predict import Predictor

    path = _scratch(spark, "bundle")
    predictor(spark, sf_dir).save(path)
    p = Predictor.load(spark, path)
    conv = tbl(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return round_doubles(p.transform(conv, "text", ("conv_id", "turn")).select(
        "conv_id", "turn", "prediction", "label", "probability", "confidence"))


@register("bundle_roundtrip_lr")
def q_bundle_roundtrip_lr(spark, sf_dir):
    """S8/S9/S10 for a ``pyspark.ml`` model."""
    from textsieve.plans.predict import Predictor

    path = _scratch(spark, "bundle")
    td = training(spark, sf_dir)
    Predictor(fitted(spark, sf_dir, "Logistic Regression"), td.vocab, td.options).save(path)
    conv = tbl(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return round_doubles(Predictor.load(spark, path).transform(conv, "text", ("conv_id", "turn")).select(
        "conv_id", "turn", "prediction", "label", "probability", "confidence"))


@register("json_sink_roundtrip", _PRED_SQL + f"""SELECT text, {S.clean('text')} AS preprocessed_text, prediction,
  label, {r6('probability')} AS probability, {r6('confidence')} AS confidence FROM preds2""")
def q_json_sink_roundtrip(spark, sf_dir):
    """Predictions written as JSON lines and read back."""
    from textsieve.sources import io

    path = _scratch(spark, "json")
    io.write_predictions_json(conversation_predictions(spark, sf_dir), path)
    schema = "text string, preprocessed_text string, prediction int, label string, probability double, confidence double"
    return round_doubles(spark.read.schema(schema).json(path))


@register("text_sink_roundtrip", f"SELECT regexp_replace(formatted, '\\n+$', '') AS formatted FROM ({ORACLE['format_result']})")
def q_text_sink_roundtrip(spark, sf_dir):
    """Formatted records written as text files, each read back whole and cut at the blank lines between records."""
    from textsieve.sources import io

    path = _scratch(spark, "text")
    io.write_predictions_text(conversation_predictions(spark, sf_dir), path)
    # a record begins with its classification line
    parts = F.split(F.col("text"), "(?:^|\n\n)(?=Classification: (?:SPAM|HAM) \\(Confidence)")
    rows = io.read_whole_file(spark, path).select(F.explode(parts).alias("formatted")).where("formatted <> ''")
    return rows.select(F.regexp_replace("formatted", "\n+$", "").alias("formatted"))


@register("features_and_target", f"SELECT message, label FROM ({ENC_SQL}) WHERE label IS NOT NULL AND message IS NOT NULL")
def q_features_and_target(spark, sf_dir):
    """The message and its label."""
    return prepare.split_features_target(prepare.drop_null_rows(encoded(spark, sf_dir)))


@register("filter_class", f"SELECT row_id, label FROM ({ENC_SQL}) WHERE label = 1 AND message IS NOT NULL")
def q_filter_class(spark, sf_dir):
    """The messages of class 1."""
    return prepare.filter_class(prepare.drop_null_rows(encoded(spark, sf_dir)), 1).select("row_id", "label")


# --- legacy script path: S2 -> M6 -> V11 -> M8 -> F3 -> A9 -------------------

def _legacy_vocab(spark, sf_dir):
    key = (id(spark), sf_dir, "legacy_vocab")
    if key not in _FITS:
        base = train.labelled_messages(spark, sf_dir)
        counts = vectorize.term_counts(base)
        _FITS[key] = (counts, vectorize.fit_vocabulary(counts, base.count(), min_df=1, max_features=None))
    return _FITS[key]


@register("legacy_count_vectors", f"""
WITH c AS ({_COUNTS_SQL}),
v AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id FROM (SELECT DISTINCT term FROM c))
SELECT c.row_id, v.term_id, CAST(c.tf AS DOUBLE) AS value FROM c JOIN v ON c.term = v.term""")
def q_legacy_count_vectors(spark, sf_dir):
    """Count vectors with the English stop list, no min_df, no feature
    limit (the vocabulary is unbounded, so it is numbered by the distributed
    rank and joined without a broadcast hint)."""
    counts, vocab = _legacy_vocab(spark, sf_dir)
    return vectorize.count_vectors(counts, vocab, None).select("row_id", "term_id", "value")


@register("legacy_accuracy")
def q_legacy_accuracy(spark, sf_dir):
    """A9 on the legacy path (rows only): upsample class 1 to the size of class
    0 (M6), count vectors over the upsampled documents (V11), a plain 30 %
    split of the rows *with* their copies (M8, seed 0), Gaussian Naive Bayes
    (F3), accuracy. Copies become weights on each side of the split."""
    from textsieve.operators import bayes

    base = train.labelled_messages(spark, sf_dir)
    bal = sampling.legacy_upsample(base)
    sp = sampling.stratified_split(bal, 0.3, None, "row_id", seed=0, copy_col="copy_no")
    side = {t: sp.where(F.col("is_test") == t).groupBy("row_id", "label").agg(
        F.count(F.lit(1)).cast("double").alias("weight")) for t in (False, True)}
    used = bal.select("row_id").distinct()
    counts = vectorize.term_counts(base.join(used, "row_id", "left_semi"))
    vocab = vectorize.fit_vocabulary(counts, used.count(), min_df=1, max_features=None)
    feats = {t: vectorize.count_vectors(counts.join(side[t].drop("label"), "row_id"), vocab, None,
                                        keep=("weight",)).join(side[t].select("row_id", "label"), "row_id")
             for t in (False, True)}
    model = bayes.fit_gaussian(feats[False], side[False], vocab)
    sc = model.score(side[True], feats[True])
    return sc.agg(
        F.sum("weight").cast("bigint").alias("n_test"),
        (F.sum(F.when(F.col("prediction") == F.col("label"), F.col("weight")).otherwise(0.0)) /
         F.sum("weight")).alias("accuracy"))


@register("transform_oov", f"""WITH {_TRAIN}
SELECT t.row_id, CAST(count(f.term) AS BIGINT) AS n_known, {r6('coalesce(sum(f.value * f.value), 0.0)')} AS sq_norm
FROM test_docs t LEFT JOIN fte f ON t.row_id = f.row_id GROUP BY t.row_id""")
def q_transform_oov(spark, sf_dir):
    """Test documents through the training vocabulary: known terms per
    document and the squared L2 norm (1, or 0 for a document with no known
    term, which keeps its row)."""
    td = training(spark, sf_dir)
    per = td.feats_test.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_known"),
                                              F.sum(F.col("value") * F.col("value")).alias("sq_norm"))
    out = td.docs_test.join(per, "row_id", "left").select(
        "row_id", F.coalesce("n_known", F.lit(0)).cast("bigint").alias("n_known"),
        F.coalesce("sq_norm", F.lit(0.0)).alias("sq_norm"))
    return round_doubles(out)


# --- the reference's own order (Q2): fit and upsample before the split -----

LEAKY = Options(leaky_order=True)


@register("leaky_confusion_matrix", f"""WITH {S.training_ctes_leaky(LEAKY)},
{S.nb_ctes('multinomial')}
SELECT CAST(g.y AS INTEGER) AS label, CAST(g.p AS INTEGER) AS prediction,
       {r6('coalesce(sum(t.weight), 0.0)')} AS n
FROM (VALUES (0,0),(0,1),(1,0),(1,1)) g(y, p)
LEFT JOIN (nb_scored s JOIN test_docs t ON s.row_id = t.row_id) ON s.label = g.y AND s.prediction = g.p
GROUP BY g.y, g.p""")
def q_leaky_confusion_matrix(spark, sf_dir):
    """A6 under the reference's order: multinomial NB, test copies weighted."""
    sc = nb_scored(spark, sf_dir, "multinomial", LEAKY)
    return round_doubles(evaluate.confusion_matrix(sc, weight_col="weight"))


@register("poly_kernel_svc")
def q_poly_kernel_svc(spark, sf_dir):
    """F6, polynomial kernel (degree 3, coef0 0, gamma 'scale'): linear SVM on
    TensorSketch features of scaled values (rows only)."""
    from textsieve.plans import kernels

    td = training(spark, sf_dir)
    tr, te = _scaled_long(td)
    svc, g = kernels.fit_poly_svc(tr, td.docs_train, td.vocab)
    te = kernels.tensor_sketch(te, td.docs_test, td.vocab, 3, g).join(td.docs_test, "row_id")
    return svc.transform(te).select("row_id", "label", F.col("prediction").cast("int").alias("prediction"))
