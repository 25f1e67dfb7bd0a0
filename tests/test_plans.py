"""Round trips and cross-checks of the composed plans (sf0.001)."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textsieve.plans import catalog


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_entry_runs(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.columns == ["label", "prediction", "n"] and out.count() == 4


def test_stream_equals_batch(spark):
    cols = ["conv_id", "turn", "prediction", "label", "probability"]
    batch = catalog.QUERIES["predict_batch"](spark, SF_SMALL)
    stream = catalog.QUERIES["stream_score"](spark, SF_SMALL)
    assert _rows(batch, cols) == _rows(stream, cols)
    counts = {r["label"]: r["n"] for r in catalog.QUERIES["stream_counts"](spark, SF_SMALL).collect()}
    bc = {r["label"]: r["n"] for r in catalog.QUERIES["prediction_counts"](spark, SF_SMALL).collect()}
    assert counts == bc


def test_bundle_roundtrip_equals_batch(spark):
    cols = ["conv_id", "turn", "prediction", "probability"]
    assert _rows(catalog.QUERIES["bundle_roundtrip"](spark, SF_SMALL), cols) == \
        _rows(catalog.QUERIES["predict_batch"](spark, SF_SMALL), cols)


def test_csv_roundtrip(spark):
    a = catalog.QUERIES["csv_scan_roundtrip"](spark, SF_SMALL)
    b = catalog.QUERIES["features_and_target"](spark, SF_SMALL)
    assert sorted((r.label, r.message) for r in a.collect()) == sorted((r.label, r.message.replace("\r", "")) for r in b.collect())


def test_tfidf_long_equals_vectors(spark):
    """V8 (long table) equals V13 (sparse vectors); a document without a known term has an empty vector."""
    from textsieve.plans.models import vectors

    td = catalog.training(spark, SF_SMALL)
    n = td.vocab.count()
    docs = td.docs_train.select("row_id").unionByName(spark.createDataFrame([(-1,)], "row_id bigint"))
    long = {(r["row_id"], r["term_id"]): r["value"] for r in td.feats_train.collect()}
    got = {}
    for r in vectors(docs, td.feats_train, n).collect():
        assert r["features"].size == n
        got |= {(r["row_id"], int(i)): x for i, x in zip(r["features"].indices, r["features"].values)}
    assert got == long and len(long) > 100


def test_model_results_have_no_errors(spark):
    rows = catalog.QUERIES["model_results"](spark, SF_SMALL).collect()
    from textsieve.plans.models import RECOMMENDED

    assert [r.model for r in sorted(rows, key=lambda r: r.ord)] == RECOMMENDED
    assert all(r.error is None and r.training_time > 0 and 0 <= r.f1 <= 1 and 0 <= r.roc_auc <= 1 for r in rows)


def test_failed_model_is_a_row_and_curves_need_a_name(spark):
    import pytest

    from textsieve.plans import run

    td = catalog.training(spark, SF_SMALL)
    r = run.train_models(None, ["K-Nearest Neighbors", "Multinomial Naive Bayes"], {"K-Nearest Neighbors": {"p": 3}}, td=td)
    rows = {x.model: x for x in r.results.collect()}
    assert "p=3" in rows["K-Nearest Neighbors"].error and rows["Multinomial Naive Bayes"].error is None
    assert "roc_curve" in r.curves("Multinomial Naive Bayes")
    for name in ("K-Nearest Neighbors", "nobody"):
        with pytest.raises(ValueError):
            r.curves(name)


def test_bundle_of_a_vector_model(spark):
    from textsieve.plans.predict import Predictor

    td = catalog.training(spark, SF_SMALL)
    conv = catalog.tbl(spark, SF_SMALL, "conversations").select("conv_id", "turn", "text")
    p = Predictor(catalog.fitted(spark, SF_SMALL, "Logistic Regression"), td.vocab, td.options)
    cols = ["conv_id", "turn", "prediction", "probability"]
    want = _rows(catalog.round_doubles(p.transform(conv, "text", ("conv_id", "turn"))), cols)
    assert _rows(catalog.QUERIES["bundle_roundtrip_lr"](spark, SF_SMALL), cols) == want
    top = catalog.QUERIES["lr_coefficients"](spark, SF_SMALL).collect()
    assert {r.side for r in top} == {"spam", "ham"}


def test_full_preprocessing_is_an_option(spark):
    from textsieve.config import Options

    conv = spark.createDataFrame([(0, "The cats were running"), (1, None)], "row_id bigint, text string")
    p = catalog.predictor(spark, SF_SMALL)
    p = type(p)(p.model, p.vocab, Options(preprocess="full"))
    rows = {r.row_id: r.preprocessed_text for r in p.transform(conv).collect()}
    assert rows == {0: "cats running", 1: ""}


def test_grid_search(spark):
    import pytest

    from textsieve.plans import models

    td = catalog.training(spark, SF_SMALL)
    res, best = models.grid_search("Multinomial Naive Bayes", td, {"alpha": [0.1, 1.0]}, k=3)
    ranked = {r.params: r.mean_score for r in res.collect()}
    assert len(ranked) == 2 and ranked[str(best)] == max(ranked.values())
    for name, grid in (("Random Forest", {"max_leaf_nodes": [2]}), ("Gradient Boosting", {"nonsense": [1]}),
                       ("Neural Network", {"alpha": [0.1]}), ("K-Nearest Neighbors", {"leaf_size": [1]})):
        with pytest.raises(ValueError):
            models.grid_search(name, td, grid)
    assert len(models.grid_points(models.REGISTRY["Logistic Regression"].grid)) == 32


def test_ml_models_beat_nothing(spark):
    for q in ("logistic_regression", "decision_tree"):
        out = catalog.QUERIES[q](spark, SF_SMALL)
        assert out.count() == catalog.training(spark, SF_SMALL).docs_test.count()
        assert set(r[0] for r in out.select("prediction").distinct().collect()) <= {0, 1}


def test_same_result_twice(spark):
    a = catalog.QUERIES["mnb_score"](spark, SF_SMALL).collect()
    catalog.reset_state(spark)
    b = catalog.QUERIES["mnb_score"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_leaky_order_weights(spark):
    """The reference's order: copies are split, so test weights add up to the
    test share of the upsampled rows, and every held-out copy is scored."""
    import math

    td = catalog.training(spark, SF_SMALL, catalog.LEAKY)
    n_up = td.docs_train.agg(F.sum("weight")).first()[0] + td.docs_test.agg(F.sum("weight")).first()[0]
    counts = {r[0]: r[1] for r in catalog.train.labelled_messages(spark, SF_SMALL).groupBy("label").count().collect()}
    assert n_up == 2 * max(counts.values())
    assert td.docs_test.agg(F.sum("weight")).first()[0] == math.ceil(0.3 * n_up)
    cm = catalog.QUERIES["leaky_confusion_matrix"](spark, SF_SMALL).collect()
    assert abs(sum(r["n"] for r in cm) - math.ceil(0.3 * n_up)) < 1e-9


def test_model_queries_use_the_defaults_of_the_registry(spark, monkeypatch):
    import pytest

    from textsieve.plans import models

    class Asked(Exception):
        pass

    def asked(name, params=None, create=models.create_model):
        raise Asked(name, create(name, params).params)

    monkeypatch.setattr(models, "create_model", asked)
    for q, name, key, value in (("random_forest", "Random Forest", "n_estimators", 100), ("gbt", "Gradient Boosting", "n_estimators", 100),
                                ("tree_importances", "Random Forest", "n_estimators", 100), ("mlp", "Neural Network", "max_iter", 1000)):
        with pytest.raises(Asked) as e:
            catalog.QUERIES[q](spark, "no data")
        assert e.value.args == (name, models.REGISTRY[name].default) and e.value.args[1][key] == value


def test_folds_of_platt_are_fitted_as_the_model_itself(spark, monkeypatch):
    import pytest
    from pyspark.ml.linalg import Vectors

    from textsieve.plans import models

    class Fitted(Exception):
        pass

    def fit(self, rows):
        raise Fitted(self.getMaxIter())

    monkeypatch.setattr(models.LinearSVC, "_fit", fit)
    rows = spark.createDataFrame([(i, i % 2, 1, Vectors.dense([float(i)])) for i in range(12)], ["row_id", "label", "weight", "features"])
    with pytest.raises(Fitted) as e:  # the first fold's
        models.fit_platt_svm(models._svc({"_n": 12}), rows)
    assert e.value.args == (100,)


def test_a_retried_batch_counts_once(spark, tmp_path):
    """A batch that is written again after a crash, in other files, replaces what the counts had of it."""
    from textsieve.streaming import score as st

    schema = "label string, text string"
    out, ckpt, state = (str(tmp_path / n) for n in ("out", "ckpt", "state"))

    def write(epoch, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    def counts():
        st.scored_stream_counts(spark, out, f"{schema}, epoch long", state, ckpt)
        return {r.label: r.n for r in st.running_counts(spark, state).collect()}

    write(0, [("SPAM", "a"), ("HAM", "b")])
    assert counts() == {"SPAM": 1, "HAM": 1}
    write(0, [("SPAM", "a"), ("HAM", "b")])
    assert counts() == {"SPAM": 1, "HAM": 1}
    write(0, [("SPAM", "a"), ("HAM", "b")])
    write(1, [("HAM", "c"), ("HAM", "d")])
    assert counts() == {"SPAM": 1, "HAM": 3}
    # a retry that comes out otherwise replaces the earlier counts of its batch
    write(0, [("HAM", "b")])
    assert counts() == {"HAM": 3}


def test_counts_survive_a_crash_between_write_and_commit(spark, tmp_path):
    import pytest

    from textsieve.streaming import score as st

    schema = "label string, text string"
    out, ckpt, state = (str(tmp_path / n) for n in ("out", "ckpt", "state"))
    spark.createDataFrame([("SPAM", "a")], schema).write.parquet(f"{out}/epoch=0")
    real = st.write_epoch_counts

    def crash(*args):
        real(*args)
        raise RuntimeError("lost after the write")

    st.write_epoch_counts = crash
    try:
        with pytest.raises(Exception, match="lost after the write"):
            st.scored_stream_counts(spark, out, f"{schema}, epoch long", state, ckpt)
    finally:
        st.write_epoch_counts = real
    # the batch was not committed: it runs again, and its epoch is counted again, not added to
    st.scored_stream_counts(spark, out, f"{schema}, epoch long", state, ckpt)
    assert [(r.label, r.n) for r in st.running_counts(spark, state).collect()] == [("SPAM", 1)]


def test_weights_reach_every_metric(spark):
    """A weight of n is n copies of the row, in every metric and curve."""
    from pyspark.sql import functions as F

    from textsieve.operators import evaluate

    rows = [(i, i % 2, int(i % 3 == 0), round((i * 37 % 11) / 11, 3), float(1 + i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, label int, prediction int, probability double, weight double")
    copies = df.withColumn("c", F.explode(F.expr("sequence(1, cast(weight as int))"))).drop("c", "weight")
    got, want = evaluate.evaluate(df, weight_col="weight"), evaluate.evaluate(copies)
    assert set(got) == set(want) and len(got) == 7
    for name in want:
        a, b = (sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d[name].collect()], key=str)
                for d in (got, want))
        assert a == b, name


def test_streams_read_a_table_in_part_files(spark, tmp_path):
    """a table may be a folder of part files."""
    import os

    from textsieve.streaming import score as st

    rows = [(i, 0, "user", f"free prize number {i}") for i in range(40)]
    whole = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    whole.repartition(4).write.parquet(str(tmp_path / "parts" / "conversations.parquet"))
    os.makedirs(tmp_path / "one")
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"conv_id": [r[0] for r in rows], "turn": pa.array([0] * 40, pa.int32()),
                             "role": ["user"] * 40, "text": [r[3] for r in rows]}), str(tmp_path / "one" / "conversations.parquet"))
    for kind in ("parts", "one"):
        out, seen = str(tmp_path / f"{kind}-out"), []
        src = st.stream_table(spark, str(tmp_path / kind), "conversations", whole.schema)
        q = (src.writeStream.foreachBatch(lambda b, e: seen.append(b.write.mode("append").parquet(out)))  # noqa: B023
             .option("checkpointLocation", str(tmp_path / f"{kind}-ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
        assert len(seen) == 1  # files are put together
        assert sorted(map(tuple, spark.read.parquet(out).collect())) == rows
