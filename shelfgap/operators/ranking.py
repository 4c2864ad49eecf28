"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in ``rank``.

    The filter on ``row_number`` lets Spark keep ``n`` rows per group and task before the
    shuffle, so one huge group sends at most ``n`` rows per task to its reducer. ``order``
    should end in a column that breaks ties.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
