"""The star schema's constraints as reports: counts per rule, and the rows behind them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_rules(
    not_null: list[str] | None = None,
    max_length: dict[str, int] | None = None,
    types: dict[str, str] | None = None,
    domain: dict[str, list] | None = None,
) -> dict[str, Column]:
    """Rules that one row can break by itself, as name -> "is broken" condition."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in not_null or []}
    rules |= {f"length:{c}": F.length(c) > n for c, n in (max_length or {}).items()}
    rules |= {f"type:{c}": F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in (types or {}).items()}
    rules |= {f"domain:{c}": F.col(c).isNotNull() & ~F.col(c).isin(v) for c, v in (domain or {}).items()}
    return rules


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that break any rule, with the names of the broken rules as comma-separated text."""
    broken = F.concat_ws(",", *[F.when(condition, F.lit(name)) for name, condition in rules.items()])
    return df.withColumn("_rules", broken).filter(F.col("_rules") != "")


def rule_counts(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """(table, rule, n_violations) for all row rules in one pass."""
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_violations").select(
        F.lit(table).alias("table"), "rule", F.col("n_violations").cast("bigint")
    )


def duplicate_keys(df: DataFrame, keys: list[str], out: str = "n_rows") -> DataFrame:
    """Keys that occur more than once. Keys with a NULL part are never duplicates."""
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def _unknown(rows: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    known = dim.select(*[F.col(d).alias(f"__d_{d}") for d in on.values()])
    condition = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__d_{d}") for f, d in on.items()])
    return rows.dropna(subset=list(on)).join(known, condition, "left_anti")


def orphans(fact: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """Fact rows whose reference (fact column -> dimension column) is not in ``dim``; a NULL reference is allowed."""
    return _unknown(fact, dim, on)


def referenced(fact: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """The fact rows that `orphans` does not return: known or NULL reference."""
    known = dim.select(*[F.col(d).alias(f"__d_{d}") for d in on.values()])
    condition = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__d_{d}") for f, d in on.items()])
    missing = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in on])
    return fact.join(known, condition, "left_semi").unionByName(fact.filter(missing))


def orphan_count(fact: DataFrame, dim: DataFrame, on: dict[str, str], out: str = "n_violations") -> DataFrame:
    """How many fact rows `orphans` would return, in one row.

    The fact is first reduced to a count per reference on the map side, so only distinct
    references are shuffled and a very common one costs nothing.
    """
    counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    return _unknown(counts, dim, on).agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias(out))


def domain_misses(df: DataFrame, column: str, dim: DataFrame, dim_column: str) -> DataFrame:
    """Rows whose value is not among the dimension's values."""
    return orphans(df, dim, {column: dim_column})


def _named(count: DataFrame, table: str, rule: str) -> DataFrame:
    return count.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), "n_violations")


def constraint_report(
    df: DataFrame,
    table: str,
    rules: dict[str, Column] | None = None,
    unique: list[str] | None = None,
    references: dict[str, tuple[DataFrame, dict[str, str]]] | None = None,
) -> DataFrame:
    """All constraints of one table as (table, rule, n_violations).

    Row rules share one pass; uniqueness counts the repeated keys; each reference is an anti
    join of the distinct references.
    """
    parts = []
    if rules:
        parts.append(rule_counts(df, table, rules))
    if unique:
        repeated = duplicate_keys(df, unique).agg(F.count(F.lit(1)).alias("n_violations"))
        parts.append(_named(repeated, table, "unique:" + ",".join(unique)))
    for name, (dim, on) in (references or {}).items():
        parts.append(_named(orphan_count(df, dim, on), table, f"reference:{name}"))
    return reduce(DataFrame.unionByName, parts)
