"""Standardisation with the population standard deviation (zero std -> 1)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class StandardModel:
    stats: dict            # column -> (mean, scale)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s)
                               for c, (m, s) in self.stats.items() if c in df.columns})


class Standardizer:
    """One aggregation pass (avg, stddev_pop per column), collected as scalars."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> StandardModel:
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(self.cols)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(self.cols)]).first()
        stats = {}
        for i, c in enumerate(self.cols):
            m, s = row[f"m{i}"], row[f"s{i}"]
            stats[c] = (m or 0.0, s if s else 1.0)
        return StandardModel(stats)
