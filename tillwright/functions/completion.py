"""Hook for a batch text-completion model; without one, a fixed template answers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Model = Callable[[pd.Series], pd.Series]


def draft(prompt: Column) -> Column:
    """Stands in for a model: says how long the prompt was and repeats it."""
    return F.concat(F.lit("Draft for "), F.length(prompt).cast("string"), F.lit(" characters: "), prompt)


def complete(prompt: Column, model: Model | None = None) -> Column:
    """Answers to the prompts; a NULL prompt has a NULL answer.

    ``model`` gets an Arrow batch of non-NULL prompts and returns as many answers; without one a fixed template
    answers, as a column expression.
    """
    if model is None:
        return draft(prompt)

    @F.pandas_udf("string")
    def answers(prompts: pd.Series) -> pd.Series:
        result = pd.Series([None] * len(prompts), index=prompts.index, dtype=object)
        asked = prompts.notna()
        if asked.any():
            result[asked] = model(prompts[asked]).astype(object)
        return result

    return answers(prompt)
