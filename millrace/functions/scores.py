"""Character BLEU.  Counting n-grams of two texts is beyond array expressions, which would recount for every n-gram; it is an Arrow batch function."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER, EPSILON = 4, 0.1


def sentence_bleu(reference: str, said: str, order: int = ORDER, epsilon: float = EPSILON) -> float:
    """Sentence BLEU over characters; zero counts become ``epsilon`` (smoothing method 1); 0 without a common character."""
    if not said:
        return 0.0
    logs = 0.0
    for n in range(1, order + 1):
        ours, theirs = (Counter(t[i : i + n] for i in range(len(t) - n + 1)) for t in (said, reference))
        hits = sum((ours & theirs).values())
        if n == 1 and not hits:
            return 0.0
        logs += math.log((hits or epsilon) / max(1, sum(ours.values()))) / order
    return min(1.0, math.exp(1 - len(reference) / len(said))) * math.exp(logs)


def char_bleu(reference: Column, said: Column) -> Column:
    """BLEU of two columns; nulls are empty."""
    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([sentence_bleu(x or "", y or "") for x, y in zip(a, b)], dtype=float)

    return score(reference, said)


def mean_of_first(df: DataFrame, score: Column, *order: str, n: int = 500) -> DataFrame:
    """One row with ``mean``: the scores of the first ``n`` rows in the order given, over ``n`` even if there are fewer."""
    first = df.orderBy(*order).limit(n)
    return first.agg((F.coalesce(F.sum(score), F.lit(0.0)) / F.lit(float(n))).alias("mean"))
