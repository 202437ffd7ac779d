"""Data contracts the warehouse declares but never enforces, made executable.

Each contract returns a small DataFrame of findings (zero = clean). Fact-wide contracts
scan the fact once. ``contract_findings`` puts them all in one form, and ``assert_contracts``
stops a load on those that it is told to block on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import DIM_KEYS, FACT_FOREIGN_KEYS, VARCHAR_LIMITS


def contract_not_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column (zero-null policy), one pass: (column_name, null_count)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def contract_foreign_keys(fact: DataFrame, dims: dict[str, DataFrame],
                          fks=FACT_FOREIGN_KEYS) -> DataFrame:
    """Fact rows whose key has no dimension row, per foreign key.

    One pass over the fact's key columns: each is left-joined to the distinct keys of its
    dimension (how is left to the planner), and the unmatched rows are counted. A NULL key
    has no dimension row either.
    """
    rows = fact.select(*[c for c, _, _ in fks])
    for k, (c, table, key) in enumerate(fks):
        known = dims[table].select(F.col(key).alias(f"_k{k}")).distinct()
        rows = rows.join(known, F.col(c) == F.col(f"_k{k}"), "left")
    wide = rows.agg(*[F.count_if(F.col(f"_k{k}").isNull()).alias(f"_n{k}") for k in range(len(fks))])
    found = F.array(*[
        F.struct(F.lit(c).alias("fk_column"), F.lit(t).alias("dim_table"), F.lit(key).alias("dim_key"),
                 F.col(f"_n{k}").alias("dangling_rows"))
        for k, (c, t, key) in enumerate(fks)
    ])
    return wide.select(F.explode(found).alias("_r")).select("_r.*")


def contract_unique_keys(tables: dict[str, DataFrame], keys: dict[str, Sequence[str] | str] | None = None) -> DataFrame:
    """Per table: number of key values that occur more than once (primary-key check)."""
    keys = keys or DIM_KEYS
    out = None
    for name, df in tables.items():
        k = keys[name]
        k = [k] if isinstance(k, str) else list(k)
        dup = (
            df.groupBy(*k)
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(
                F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
            )
            .select(F.lit(name).alias("table_name"), "duplicate_keys",
                    F.col("duplicate_rows").cast("long").alias("duplicate_rows"))
        )
        out = dup if out is None else out.unionByName(dup)
    return out


def contract_lengths(tables: dict[str, DataFrame], limits=VARCHAR_LIMITS) -> DataFrame:
    """Longest value per limited text column vs its declared limit (one pass per table)."""
    out = None
    by_table: dict[str, list[tuple[str, int]]] = {}
    for t, c, n in limits:
        if t in tables:
            by_table.setdefault(t, []).append((c, n))
    for t, cols in by_table.items():
        wide = tables[t].agg(*[F.max(F.length(c)).alias(c) for c, _ in cols])
        rows = F.array(
            *[
                F.struct(
                    F.lit(t).alias("table_name"),
                    F.lit(c).alias("column_name"),
                    F.col(c).cast("int").alias("max_length"),
                    F.lit(n).alias("max_allowed"),
                )
                for c, n in cols
            ]
        )
        part = wide.select(F.explode(rows).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out.withColumn(
        "within_limit", F.coalesce(F.col("max_length") <= F.col("max_allowed"), F.lit(True))
    )


def contract_unknown_row(dims: dict[str, DataFrame], keys: dict[str, str] | None = None,
                         fact: DataFrame | None = None, fks=FACT_FOREIGN_KEYS) -> DataFrame:
    """Per dimension: rows with key 0 (the unknown member should exist exactly once) and,
    with ``fact``, how many fact rows point at key 0 through that dimension's foreign keys
    (one pass over the fact)."""
    keys = keys or DIM_KEYS
    out = None
    for name, df in dims.items():
        part = df.agg(F.count_if(F.col(keys[name]) == 0).alias("unknown_rows")).select(
            F.lit(name).alias("table_name"), F.col("unknown_rows").cast("long").alias("unknown_rows")
        )
        out = part if out is None else out.unionByName(part)
    out = out.withColumn("has_single_unknown", F.col("unknown_rows") == 1)
    if fact is None:
        return out
    by_dim: dict[str, list[str]] = {}
    for col, table, _ in fks:
        by_dim.setdefault(table, []).append(col)
    def on_unknown(cols: list[str]):
        cond = F.col(cols[0]) == 0
        for c in cols[1:]:
            cond = cond | (F.col(c) == 0)
        return cond

    hits = fact.agg(*[
        F.count_if(on_unknown(cols)).alias(table) for table, cols in by_dim.items()
    ]).unpivot([], list(by_dim), "table_name", "fact_rows_on_unknown")
    return out.join(hits, "table_name", "left").withColumn(
        "fact_rows_on_unknown", F.coalesce(F.col("fact_rows_on_unknown"), F.lit(0)).cast("long")
    )


def unique_business_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business-key uniqueness after de-duplication: duplicate groups and rows (0, 0 = ok)."""
    return contract_unique_keys({"trips": df}, {"trips": list(keys)}).drop("table_name")



#: The names under which :func:`contract_findings` lists the contracts.
CONTRACTS = ("not_null", "foreign_key", "primary_key", "length", "unknown_member", "business_key")


class ContractBreach(ValueError):
    """A load was stopped; ``findings`` are its rows ``(contract, subject, findings)``."""

    def __init__(self, findings: list[tuple[str, str, int]]):
        self.findings = findings
        super().__init__("contracts broken: " + ", ".join(f"{c} {s}: {n}" for c, s, n in findings))


def contract_findings(
    fact: DataFrame, dims: dict[str, DataFrame], contracts: Sequence[str] = CONTRACTS,
    fact_key: str = "trip_key", business_key: Sequence[str] = (),
) -> DataFrame:
    """``contract, subject, findings``: a row per check of the named contracts, 0 = clean.

    Findings are null values, rows with a dangling key, repeated keys, columns over their length,
    dimensions without exactly one unknown member, and repeated business keys."""
    unknown = set(contracts) - set(CONTRACTS)
    if unknown:
        raise ValueError(f"no such contracts: {sorted(unknown)}")

    def form(df: DataFrame, contract: str, subject: Column | str, count: Column | str) -> DataFrame:
        subject = F.col(subject) if isinstance(subject, str) else subject
        count = F.col(count) if isinstance(count, str) else count
        return df.select(F.lit(contract).alias("contract"), subject.alias("subject"), count.cast("long").alias("findings"))

    found = []
    if "not_null" in contracts:
        found.append(form(contract_not_null(fact), "not_null", "column_name", "null_count"))
    if "foreign_key" in contracts:
        found.append(form(contract_foreign_keys(fact, dims), "foreign_key", "fk_column", "dangling_rows"))
    if "primary_key" in contracts:
        keyed = {**dims, "fact_trip": fact}
        keys = contract_unique_keys(keyed, {**DIM_KEYS, "fact_trip": fact_key})
        found.append(form(keys, "primary_key", "table_name", "duplicate_keys"))
    if "length" in contracts:
        lengths = contract_lengths({**dims, "fact_trip": fact})
        column = F.concat_ws(".", "table_name", "column_name")
        found.append(form(lengths, "length", column, (~F.col("within_limit")).cast("int")))
    if "unknown_member" in contracts:
        found.append(form(contract_unknown_row(dims), "unknown_member", "table_name", (~F.col("has_single_unknown")).cast("int")))
    if "business_key" in contracts and business_key:
        found.append(form(unique_business_keys(fact, business_key), "business_key", F.lit("fact_trip"), "duplicate_keys"))
    return reduce(DataFrame.unionByName, found)


def assert_contracts(findings: DataFrame) -> None:
    """Raise :class:`ContractBreach` if any check has findings (one short row per broken check
    reaches the driver)."""
    broken = sorted(tuple(r) for r in findings.where("findings > 0").select("contract", "subject", "findings").collect())
    if broken:
        raise ContractBreach(broken)
