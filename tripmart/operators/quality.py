"""Validation rules, reject reasons, the per-period quality report and the gate.

A rule is a named boolean Column; a NULL result counts as a failure (a filter drops it).
The quality report is computed in one pass over the input with a two-level aggregate:

1. group by (period, business key): row count and "any row valid" - partial aggregation
   collapses duplicates before the shuffle, so hot keys stay cheap;
2. group by period: input rows = sum of counts, accepted rows = keys with a valid row.

That equals ``count(input)`` and ``count(dedupe(filter(valid)))`` per period.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.keys import month_window, own_period_window
from tripmart.functions.measures import pct
from tripmart.schemas import (
    DATASET_NAME,
    GATE_MAX_REJECT_PCT,
    GATE_MIN_ROWS,
    MAX_DISTANCE,
    MIN_DISTANCE,
)


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def trip_rules(
    year: int | None = None,
    month: int | None = None,
    period_cols: tuple[str, str] | None = ("year", "month"),
    cast_failed: str | None = None,
) -> list[Rule]:
    """Valid trip = pickup inside its month AND dropoff after pickup AND 0 <= distance < 500,
    and, where ``cast_failed`` names the array of uncastable columns, every value was cast.

    The month is fixed (``year``/``month``) for a single-period run, or taken per row from
    ``period_cols`` when many periods are processed together; ``period_cols=None`` with no
    fixed month skips the window rule.
    """
    rules = []
    if year is not None and month is not None:
        rules.append(Rule("pickup_in_period", month_window("pickup_datetime", year, month)))
    elif period_cols is not None:
        rules.append(Rule("pickup_in_period", own_period_window("pickup_datetime", *period_cols)))
    rules.append(Rule("dropoff_after_pickup", F.col("dropoff_datetime") > F.col("pickup_datetime")))
    rules.append(
        Rule(
            "distance_in_range",
            (F.col("trip_distance") >= F.lit(MIN_DISTANCE))
            & (F.col("trip_distance") < F.lit(MAX_DISTANCE)),
        )
    )
    if cast_failed is not None:
        rules.append(Rule("values_cast", F.size(cast_failed) == 0))
    return rules


def all_valid(rules: Sequence[Rule]) -> Column:
    """Conjunction of the rules with NULL treated as failure (never NULL itself).

    For a value column (e.g. a flag that is aggregated). To *filter*, use
    :func:`valid_filter`, which parquet can evaluate in the scan.
    """
    pred = F.lit(True)
    for r in rules:
        pred = pred & F.coalesce(r.predicate, F.lit(False))
    return pred


def valid_filter(rules: Sequence[Rule]) -> Column:
    """Plain conjunction of the rules for ``filter``: a NULL result drops the row just as
    FALSE does, and simple comparisons stay pushable to the parquet reader."""
    pred = None
    for r in rules:
        pred = r.predicate if pred is None else pred & r.predicate
    return pred if pred is not None else F.lit(True)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a ``reject_reasons`` array). Both lazy."""
    return df.filter(valid_filter(rules)), with_reject_reasons(df, rules).filter(
        F.size("reject_reasons") > 0
    )


def with_reject_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reasons``: names of all failed rules (empty array = valid)."""
    failed = [
        F.when(~F.coalesce(r.predicate, F.lit(False)), F.lit(r.name)) for r in rules
    ]
    return df.withColumn("reject_reasons", F.filter(F.array(*failed), lambda x: x.isNotNull()))


def reject_reason_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows failing each rule (a row failing two rules counts under both), one pass."""
    wide = df.agg(
        *[F.count_if(~F.coalesce(r.predicate, F.lit(False))).alias(r.name) for r in rules]
    )
    return wide.unpivot([], [r.name for r in rules], "reason", "rejected_rows")


def quality_report(
    df: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str],
    period_cols: tuple[str, str] = ("year", "month"),
    dataset: str = DATASET_NAME,
    processed_at: str | None = None,
) -> DataFrame:
    """One report row per period: input, accepted (valid and de-duplicated), rejected, %."""
    if processed_at is None:
        processed_at = dt.datetime.now(dt.UTC).isoformat()
    y, m = period_cols
    per_key = (
        df.select(F.col(y), F.col(m), *[F.col(k) for k in keys], all_valid(rules).alias("_ok"))
        .groupBy(y, m, *keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.bool_or("_ok").alias("_ok"))
    )
    per_period = per_key.groupBy(y, m).agg(
        F.sum("_n").alias("total_input_rows"), F.count_if("_ok").alias("accepted_rows")
    )
    return per_period.select(
        F.lit(dataset).alias("dataset"),
        F.col(y).cast("int").alias("year"),
        F.col(m).cast("int").alias("month"),
        F.col("total_input_rows").cast("long").alias("total_input_rows"),
        F.col("accepted_rows").cast("long").alias("accepted_rows"),
        (F.col("total_input_rows") - F.col("accepted_rows")).cast("long").alias("rejected_rows"),
        pct("accepted_rows", "total_input_rows").alias("acceptance_rate_pct"),
        F.lit(processed_at).alias("processed_at_utc"),
    )


def quality_report_from_counts(
    inputs: DataFrame,
    accepted: DataFrame,
    dataset: str = DATASET_NAME,
    processed_at: str | None = None,
) -> DataFrame:
    """Report from per-period row counts: ``inputs``/``accepted`` have (year, month, rows).

    Used by the pipeline after the silver write: both counts come from data at rest (row
    counts read no column data), so the numbers are exact even when tasks were retried.
    """
    if processed_at is None:
        processed_at = dt.datetime.now(dt.UTC).isoformat()
    acc = accepted.select("year", "month", F.col("rows").alias("_acc"))
    j = inputs.join(acc, ["year", "month"], "left").fillna(0, ["_acc"])
    return j.select(
        F.lit(dataset).alias("dataset"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("rows").cast("long").alias("total_input_rows"),
        F.col("_acc").cast("long").alias("accepted_rows"),
        (F.col("rows") - F.col("_acc")).cast("long").alias("rejected_rows"),
        pct("_acc", "rows").alias("acceptance_rate_pct"),
        F.lit(processed_at).alias("processed_at_utc"),
    )


def quality_gate(
    report: DataFrame,
    min_rows: int = GATE_MIN_ROWS,
    max_reject_pct: float = GATE_MAX_REJECT_PCT,
) -> DataFrame:
    """Circuit breaker per report row: pass iff accepted >= min_rows and
    (100 - acceptance %) <= max_reject_pct. Missing fields count as 0 (-> fail)."""
    accepted = F.coalesce(F.col("accepted_rows"), F.lit(0))
    rejection = F.lit(100.0) - F.coalesce(F.col("acceptance_rate_pct"), F.lit(0.0))
    too_few = accepted < F.lit(min_rows)
    too_many = rejection > F.lit(float(max_reject_pct))
    return report.select(
        "dataset",
        "year",
        "month",
        accepted.cast("long").alias("accepted_rows"),
        F.round(rejection, 2).alias("rejection_rate_pct"),
        (~too_few & ~too_many).alias("passed"),
        F.when(too_few, F.lit("too_few_rows"))
        .when(too_many, F.lit("rejection_rate_too_high"))
        .otherwise(F.lit("ok"))
        .alias("gate_reason"),
    )


def assert_gate(gate: DataFrame, expected: Sequence[tuple[int, int]] = ()) -> None:
    """Raise if any period failed the gate, or if an ``expected`` (year, month) has no gate row
    (one short row per period reaches the driver)."""
    rows = gate.select("year", "month", "passed", "gate_reason").collect()
    failed = [(r.year, r.month, r.gate_reason) for r in rows if not r.passed]
    there = {(r.year, r.month) for r in rows}
    failed += [(y, m, "no quality report") for y, m in expected if (y, m) not in there]
    if failed:
        detail = ", ".join(f"{y:04d}-{m:02d}: {reason}" for y, m, reason in failed)
        raise ValueError(f"quality gate failed for {detail}")
