"""Ordered record stages: (priority, DataFrame -> DataFrame) applied low priority first.

A row removed by one stage is not seen by later stages; each stage is an
ordinary lazy transform, so the whole chain is one plan for Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame


def run_stages(df: DataFrame, stages: Iterable[tuple[int, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    for _, stage in sorted(stages, key=lambda s: s[0]):
        df = df.transform(stage)
    return df
