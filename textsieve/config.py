"""Run options. The defaults are the reference's default run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    seed: int = 42
    test_size: float = 0.3
    cv_folds: int = 5
    upsample: bool = True
    max_features: int | None = 5000
    min_df: int = 5
    method: str = "tfidf"  # "tfidf" or "count"
    # before vectorizing, train and score alike: True cleans (T1-T7), "full" also tokenizes, drops stop words and
    # lemmatizes (T13), False keeps the raw text
    preprocess: bool | str = True
    leaky_order: bool = False  # True: fit vocabulary and upsample before the split
