"""Conform raw feeds to a fixed schema: rename, safe cast, impute; drift and lineage.

Order of operations per mapped column: rename -> ``try_cast`` to the target type ->
``coalesce`` with the default. A value that cannot be cast therefore becomes NULL (and is
imputed where a default exists) instead of failing the job; ``conform_with_rejects`` names
such columns per row, so that the pipeline rejects those rows, and ``cast_failures`` counts
them per column in a single pass. Missing columns are tolerated and unmapped columns
pass through unchanged. All mapped columns are rewritten in one projection.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schemas import UNKNOWN_TEXT, ZONE_RENAME, ConformSpec


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map, matching source names case-insensitively; absent names are ignored."""
    folded = {k.lower(): v for k, v in mapping.items()}
    renames = {
        c: folded[c.lower()] for c in df.columns if c.lower() in folded and folded[c.lower()] != c
    }
    return df.withColumnsRenamed(renames) if renames else df


def _conformed(col: str, target: T.DataType, current: T.DataType, default) -> Column:
    c = F.col(col)
    expr = c if current == target else c.try_cast(target)
    if default is not None:
        expr = F.coalesce(expr, F.lit(default).cast(target))
    return expr


def conform(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Rename, safe-cast and impute every mapped column that is present."""
    df = rename_columns(df, spec.rename)
    current = {f.name: f.dataType for f in df.schema.fields}
    exprs = {
        col: _conformed(col, target, current[col], spec.defaults.get(col))
        for col, target in spec.types.items()
        if col in current
    }
    return df.withColumns(exprs) if exprs else df


#: Per-row array of the mapped columns whose value could not be cast.
CAST_FAILED = "cast_failed_columns"


def conform_with_rejects(df: DataFrame, spec: ConformSpec, reject_col: str = CAST_FAILED) -> DataFrame:
    """:func:`conform` plus a per-row array naming the mapped columns whose non-null source
    value could not be cast (empty when the row converted cleanly). Both are computed in the
    same projection from the raw values."""
    renamed = rename_columns(df, spec.rename)
    current = {f.name: f.dataType for f in renamed.schema.fields}
    checks = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(spec.types[c]).isNull(), F.lit(c))
        for c in spec.types
        if c in current and current[c] != spec.types[c]
    ]
    flagged = renamed.withColumn(
        reject_col,
        F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks
        else F.array().cast("array<string>"),
    )
    return conform(flagged, spec)


def conform_groups(groups: list[DataFrame], spec: ConformSpec) -> DataFrame:
    """Frames of different raw schemas, each conformed with its rejects, as one frame.

    A column that only some frames have is NULL in the others; one outside the spec that has
    several types becomes text."""
    frames = [conform_with_rejects(g, spec) for g in groups]
    types: dict[str, set] = {}
    for f in frames:
        for field in f.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType)
    mixed = {name for name, found in types.items() if len(found) > 1}
    frames = [f.withColumns({c: F.col(c).cast("string") for c in mixed & set(f.columns)}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def cast_failures(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Per mapped column: non-null source values that do not cast to the target type.

    One aggregate over the raw data, returned long: (column_name, failures).
    """
    df = rename_columns(df, spec.rename)
    current = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in spec.types if c in current]
    aggs = []
    for c in cols:
        if current[c] == spec.types[c]:
            bad = F.lit(False)
        else:
            bad = F.col(c).isNotNull() & F.col(c).try_cast(spec.types[c]).isNull()
        aggs.append(F.count_if(bad).alias(c))
    wide = df.agg(*aggs)
    return wide.unpivot([], cols, "column_name", "failures")


def schema_drift_report(spark: SparkSession, df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Compare a raw feed with the spec.

    status: ``mapped`` (present under a spec name), ``missing`` (expected, absent) or
    ``extra`` (present, not in the spec; passes through conform unchanged), plus
    ``non_null_rows`` per present column from one aggregate over the data.
    """
    present = {c.lower(): c for c in df.columns}
    source_names = {k.lower(): k for k in spec.rename}
    rows = []
    for low, name in source_names.items():
        if low in present:
            rows.append((name, present[low], spec.rename[name], "mapped"))
        else:
            rows.append((name, None, spec.rename[name], "missing"))
    targets = {v.lower() for v in spec.rename.values()}
    for low, actual in present.items():
        if low not in source_names and low not in targets:
            rows.append((None, actual, None, "extra"))
    schema = "expected_column string, source_column string, target_column string, status string"
    report = spark.createDataFrame(rows, schema)
    # Data side of the drift check: a present but never-filled column is drift too.
    counted = [c for c in df.columns]
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in counted]).unpivot(
        [], counted, "source_column", "non_null_rows"
    )
    return report.join(filled, "source_column", "left")


def add_lineage(
    df: DataFrame,
    run_id: str,
    processed_at: str | None = None,
    source_file: str | Column | None = None,
    year: int | None = None,
    month: int | None = None,
    year_col: str = "year",
    month_col: str = "month",
) -> DataFrame:
    """Append source_file, source_year, source_month, processed_at_utc, pipeline_run_id.

    Period columns come from literals (single-period run) or from the partition columns
    ``year``/``month`` (multi-period run; those are dropped afterwards). ``source_file``
    defaults to the physical file of each row (``_metadata.file_path``) when not given.
    ``run_id`` and ``processed_at`` are driver-side values, identical for every row.
    """
    if processed_at is None:
        processed_at = dt.datetime.now(dt.UTC).isoformat()
    if year is not None and month is not None:
        y, m = F.lit(year), F.lit(month)
    else:
        y, m = F.col(year_col), F.col(month_col)
    if source_file is None:
        src = F.col("_metadata.file_path")
    elif isinstance(source_file, str):
        src = F.lit(source_file)
    else:
        src = source_file
    out = df.withColumns(
        {
            "source_file": src,
            "source_year": y.cast("short"),
            "source_month": m.cast("short"),
            "processed_at_utc": F.lit(processed_at),
            "pipeline_run_id": F.lit(run_id),
        }
    )
    drop = [c for c in (year_col, month_col) if c in df.columns]
    return out.drop(*drop) if drop else out


def conform_zone_lookup(df: DataFrame) -> DataFrame:
    """Zone lookup: rename, integer id, text attributes default to 'Unknown'."""
    df = rename_columns(df, ZONE_RENAME)
    text = lambda c: F.coalesce(F.col(c), F.lit(UNKNOWN_TEXT)).cast("string")
    return df.select(
        F.col("location_id").try_cast("int").alias("location_id"),
        text("borough").alias("borough"),
        text("zone").alias("zone"),
        text("service_zone").alias("service_zone"),
    )
