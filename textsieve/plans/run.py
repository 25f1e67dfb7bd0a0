"""The default run: train the chosen models, compare them, save the best with
its registry entry and a run summary (F13-F16, W7, W11, S8, S10-S12)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsieve.config import Options
from textsieve.operators import evaluate, prepare, rank
from textsieve.plans import models as M
from textsieve.plans import train
from textsieve.plans.predict import Predictor, record_model
from textsieve.session import cut_lineage
from textsieve.sources import io


@dataclass
class Run:
    results: DataFrame  # one row per model, see ``models.RESULT_SCHEMA``
    fitted: dict  # the models that could be fitted, by name
    td: train.TrainingData

    def curves(self, name: str) -> dict:
        """Every metric and curve of one model by name; an unknown name and a model that failed are errors."""
        row = self.results.where(F.col("model") == name).first()
        if row is None:
            raise ValueError(f"no model named {name!r} in this run")
        if row["error"] is not None:
            raise ValueError(f"{name} failed: {row['error']}")
        sc = cut_lineage(M.scored(self.fitted[name], self.td))
        return evaluate.evaluate(sc, weight_col="weight" if "weight" in sc.columns else None)

    def predictor(self, name: str) -> Predictor:
        return Predictor(self.fitted[name], self.td.vocab, self.td.options)


def train_models(base: DataFrame, selected: list[str] | None = None, params: dict | None = None,
                 opts: Options = Options(), td: train.TrainingData | None = None) -> Run:
    """Fit and evaluate the selected models (the recommended ones by default) on ``base(row_id, message, label)``."""
    td = (td or train.prepare(base, opts)).settled()
    results, fitted = M.train_and_evaluate(M.get_models(selected or M.RECOMMENDED, params), td)
    return Run(results, fitted, td)


def default_run(base: DataFrame, path: str, metric: str = "f1", run: Run | None = None, **options) -> tuple[Run, str]:
    """``train_models`` (unless a ``run`` is given), then under ``path``: the best model's bundle, a row in ``registry`` and ``summary``. Returns the run
    and the best model's name."""
    spark = base.sparkSession
    run = run or train_models(base, **options)
    best = rank.best_model(run.results, metric).first()
    bundle = f"{path}/models/{best['model'].replace(' ', '_').lower()}"
    run.predictor(best["model"]).save(bundle)
    record_model(spark, f"{path}/registry", best["model"], bundle, best[metric])
    io.write_run_summary(run.results.withColumn("is_best", F.col("model") == best["model"]),
                         prepare.dataset_info(base), f"{path}/summary")
    return run, best["model"]
