"""Data-quality rules: one pass marks each row, then good rows and quarantine are filters."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfgap.sources.text import MALFORMED
from shelfgap.specs import Rule

REASON = "dq_failure_reason"
ROW_MALFORMED = "row_malformed"
_FAILED = "_dq_failed"
_HELD = ""
_UNJUDGED = "?"


class Split(NamedTuple):
    good: DataFrame
    quarantine: DataFrame


def _day(as_of: datetime.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def passes(rules: Sequence[Rule], as_of: datetime.date | str | None = None) -> Column:
    """Whether a row meets all rules; NULL if a rule over NULL leaves it open."""
    day = _day(as_of)
    return reduce(and_, [rule.holds(day) for rule in rules])


def _outcome(rule: Rule, day: Column, null_policy: str) -> Column:
    holds = rule.holds(day)
    if null_policy == "reject":
        return F.when(holds, F.lit(_HELD)).otherwise(F.lit(rule.reason))
    failed = F.when(~holds, F.lit(rule.reason)).otherwise(F.lit(_UNJUDGED))
    return F.when(holds, F.lit(_HELD)).otherwise(failed)


def judge(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime.date | str | None = None,
    null_policy: str = "reject",
) -> DataFrame:
    """Each row with the reasons of the rules it fails.

    A rule over a NULL value is neither true nor false. ``reject`` counts it as failed;
    ``ignore`` counts it as neither, and such a row can then miss both outputs. A malformed row fails
    for that alone, as its values may stand in the wrong columns.
    """
    if null_policy not in ("reject", "ignore"):
        raise ValueError(f"null policy must be 'reject' or 'ignore', not {null_policy!r}")
    day = _day(as_of)
    outcomes = F.array(*[_outcome(rule, day, null_policy) for rule in rules])
    if MALFORMED in df.columns:
        outcomes = F.when(F.col(MALFORMED).isNull(), outcomes).otherwise(F.array(F.lit(ROW_MALFORMED)))
    return df.withColumn(_FAILED, F.array_remove(outcomes, _HELD))


# Both outputs filter on the exploded reason. A filter on the list itself would be pushed below
# the parsing of the columns and parse each of them a second time.


def accepted(judged: DataFrame) -> DataFrame:
    exploded = judged.withColumn(REASON, F.explode_outer(_FAILED))
    return exploded.filter(F.col(REASON).isNull()).drop(_FAILED, REASON)


def rejected(judged: DataFrame, distinct_rows: bool = False) -> DataFrame:
    """One row per failed rule; exact repeats are removed unless there are known to be none."""
    reasons = F.explode_outer(F.array_remove(_FAILED, _UNJUDGED))
    failures = judged.withColumn(REASON, reasons).filter(F.col(REASON).isNotNull())
    failures = failures.drop(_FAILED)
    return failures if distinct_rows else failures.distinct()


def split(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime.date | str | None = None,
    null_policy: str = "reject",
    distinct_rows: bool = False,
) -> Split:
    judged = judge(df, rules, as_of, null_policy)
    return Split(accepted(judged), rejected(judged, distinct_rows))


def quality_counts() -> list[Column]:
    """Counts over judged rows; ``failed_rules`` counts a row once per rule it fails."""
    doubts = F.size(_FAILED)
    failed = F.size(F.array_remove(_FAILED, _UNJUDGED))
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(doubts == 0).alias("good_rows"),
        F.count_if(failed > 0).alias("rejected_rows"),
        F.count_if((doubts > 0) & (failed == 0)).alias("unjudged_rows"),
        F.coalesce(F.sum(failed), F.lit(0)).cast("bigint").alias("failed_rules"),
    ]


def quality_metrics(judged: DataFrame) -> DataFrame:
    """One row of ``quality_counts``."""
    return judged.agg(*quality_counts())


def _all_counts(judged: DataFrame) -> list[Column]:
    malformed = F.col(MALFORMED).isNotNull() if MALFORMED in judged.columns else F.lit(False)
    return [*quality_counts(), F.count_if(malformed).alias("malformed_rows")]


def counted(judged: DataFrame) -> dict[str, int]:
    """``quality_counts`` and the number of malformed rows."""
    return judged.agg(*_all_counts(judged)).first().asDict()


def observed(judged: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and the same counts, which whoever writes the rows gets by the way. To be put behind
    the last shuffle, where a repeated task does not count twice."""
    seen = Observation()
    return judged.observe(seen, *_all_counts(judged)), seen
