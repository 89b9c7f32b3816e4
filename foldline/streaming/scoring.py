"""Apply a fitted recipe to a Structured Streaming DataFrame.

The reference has no streaming operator; what carries over is that every
*fitted* step (mode and median fills, target encodings, skew list) becomes a
stateless projection or a stream-static lookup join once its statistics are
learned on the batch training table. So new rows arriving as a stream are
prepared exactly like the batch scoring table, without a state store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame

from foldline.operators.encode import TargetEncoderModel
from foldline.operators.features import add_advanced_features, add_features
from foldline.operators.impute import (FillGroupMedian, FillMode, cast_to_string, fill_constant)
from foldline.operators.skew import SkewModel
from foldline.plans import housing
from foldline.plans.recipe import run_steps

Step = Callable[[DataFrame], DataFrame]


def fitted_cleaning(train: DataFrame) -> list[Step]:
    """The cleaning step with modes and medians learned on ``train``."""
    modes = FillMode(housing.MODE_FILL_COLUMNS).fit(train)
    steps: list[Step] = [
        partial(fill_constant, cols=housing.NONE_FILL_COLUMNS, value="None"),
        partial(fill_constant, cols=housing.ZERO_FILL_COLUMNS, value=0),
        modes.transform,
        partial(fill_constant, cols=["Functional"], value=housing.FUNCTIONAL_DEFAULT),
    ]
    if "LotFrontage" in train.columns and "Neighborhood" in train.columns:
        # the median fit runs on the train table after the fills above
        filled = run_steps(train, steps)
        steps.append(FillGroupMedian("LotFrontage", "Neighborhood").fit(filled).transform)
    steps.append(partial(cast_to_string, cols=housing.CODE_AS_STRING))
    return steps


def fitted_recipe(train: DataFrame, encoders: Sequence[TargetEncoderModel] = (),
                  skew: SkewModel | None = None) -> list[Step]:
    steps = fitted_cleaning(train) + [housing.encode_ordinals, add_features, add_advanced_features]
    steps += [m.transform_score for m in encoders]
    if skew is not None:
        steps.append(skew.transform)
    return steps


def prepare_stream(stream: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Same steps on a streaming DataFrame (projections and static joins only)."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return run_steps(stream, steps)
