"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame

from frostline.llm import factor_machine as fm


def train(docs: DataFrame, labels: DataFrame, **settings) -> fm.Model:
    """Learn ``labels.quality``; words, form and the number of characters interact, language, source and ids are no inputs.

    Nulls, repeated rows and empty tables as :func:`frostline.llm.factor_machine.train` states them.
    """
    return fm.train(docs, labels, "quality", statistics=True, **({"metadata": ("n_chars",)} | settings))


def score(docs: DataFrame, model: fm.Model) -> DataFrame:
    """``doc_id, score`` of every row; a null text counts as empty, equal rows score alike, an empty table gives none."""
    return fm.score(docs, model)
