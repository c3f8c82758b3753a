"""Run rule suites over tables; results are rows.

Nulls are skipped by the range, set and unique rules. Any unexpected row fails
a rule. A rule on a column that does not exist fails and does not raise; all
rows then count as unexpected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.rules import (
    BETWEEN,
    EXISTS,
    IN_SET,
    NOT_NULL,
    OF_TYPE,
    UNIQUE,
    Rule,
    Suite,
)
from tributary.schemas import TYPE_FAMILIES


def _name(rule: Rule) -> Column:
    return F.col(f"`{rule.column}`")


def _out_of_range(rule: Rule, data_type: T.DataType) -> Column:
    value = _name(rule)
    bounds = [b for b in (rule.low, rule.high) if b is not None]
    if isinstance(data_type, T.StringType) and not any(isinstance(b, str) for b in bounds):
        # Text held against numbers: what cannot be read as a number is out of range.
        number = value.try_cast("decimal(38,9)")
        return value.isNotNull() & F.coalesce(_outside(number, rule), F.lit(True))
    return _outside(value, rule)


def _outside(value: Column, rule: Rule) -> Column:
    tests = []
    if rule.low is not None:
        tests.append(value < F.lit(rule.low))
    if rule.high is not None:
        tests.append(value > F.lit(rule.high))
    return reduce(lambda a, b: a | b, tests)


def _not_in_set(rule: Rule, data_type: T.DataType) -> Column:
    value = _name(rule)
    text = value if isinstance(data_type, T.StringType) else value.cast("string")
    return ~text.isin(*rule.allowed)


def unexpected(rule: Rule, schema: T.StructType) -> Column | None:
    """What makes a single row unexpected; None for rules that no row can decide alone."""
    if rule.column not in schema.names:
        return F.lit(True)
    data_type = schema[rule.column].dataType
    if rule.kind == NOT_NULL:
        return _name(rule).isNull()
    if rule.kind == BETWEEN:
        return _out_of_range(rule, data_type)
    if rule.kind == IN_SET:
        return _not_in_set(rule, data_type)
    if rule.kind == OF_TYPE and not isinstance(data_type, TYPE_FAMILIES[rule.family]):
        return F.lit(True)
    if rule.kind == UNIQUE:
        return None
    return F.lit(False)


def _schema_verdict(rule: Rule, schema: T.StructType) -> bool:
    """Known from the schema alone; value rules only need their column."""
    if rule.column not in schema.names:
        return False
    if rule.kind == OF_TYPE:
        return isinstance(schema[rule.column].dataType, TYPE_FAMILIES[rule.family])
    return True


def _result(suite: Suite, table: str, idx: int, n_unexpected: Column, fits: bool) -> Column:
    rule = suite.rules[idx]
    return F.struct(
        F.lit(suite.name).alias("suite"),
        F.lit(table).alias("table"),
        F.lit(idx).alias("idx"),
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.column).alias("column"),
        F.col("n_rows").alias("n_rows"),
        n_unexpected.alias("n_unexpected"),
        ((n_unexpected == 0) & F.lit(fits)).alias("success"),
    )


def run_suite(frame: DataFrame, suite: Suite, table: str) -> DataFrame:
    """One row per rule: suite, table, idx, rule, column, n_rows, n_unexpected, success.

    All row rules share one aggregate. A unique rule needs its own shuffle; copies
    are counted before it, so a repeated key costs one row per task.
    """
    schema = frame.schema
    shared: dict[int, Column] = {}
    parts: list[DataFrame] = []
    for idx, rule in enumerate(suite.rules):
        test = unexpected(rule, schema)
        if test is None:
            parts.append(_unique_result(frame, suite, table, idx))
        else:
            shared[idx] = F.count_if(test)
    if shared:
        counts = frame.agg(
            F.count("*").alias("n_rows"), *[c.alias(f"r{idx}") for idx, c in shared.items()]
        )
        rows = [
            _result(suite, table, idx, F.col(f"r{idx}"), _schema_verdict(suite.rules[idx], schema))
            for idx in shared
        ]
        parts.insert(0, counts.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def _unique_result(frame: DataFrame, suite: Suite, table: str, idx: int) -> DataFrame:
    key = _name(suite.rules[idx])
    copies = frame.groupBy(key.alias("key")).agg(F.count("*").alias("copies"))
    repeated = F.col("key").isNotNull() & (F.col("copies") > 1)
    nothing = F.lit(0).cast("bigint")
    counts = copies.agg(
        F.coalesce(F.sum("copies"), nothing).alias("n_rows"),
        F.coalesce(F.sum(F.when(repeated, F.col("copies"))), nothing).alias("repeated"),
    )
    return counts.select(F.inline(F.array(_result(suite, table, idx, F.col("repeated"), True))))


def run_checkpoint(
    tables: dict[str, DataFrame],
    suites: dict[str, Suite],
    validations: list[tuple[str, str]] | tuple[tuple[str, str], ...],
    run: str | None = None,
) -> DataFrame:
    """Every (table, suite) pair in one result, one job when it is read."""
    parts = []
    for table, suite in validations:
        if table not in tables:
            raise ValueError(f"checkpoint names table {table!r}, which was not given")
        if suite not in suites:
            raise ValueError(f"checkpoint names suite {suite!r}, which was not given")
        parts.append(run_suite(tables[table], suites[suite], table))
    results = reduce(DataFrame.unionByName, parts)
    return results if run is None else results.withColumn("run", F.lit(run))


def evaluation_parameters(results: DataFrame) -> DataFrame:
    """Observed values of a run as (run, suite, table, idx, rule, column, metric, value)."""
    metrics = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
            for m in ("n_rows", "n_unexpected")
        ]
    )
    return results.select(
        "run", "suite", "table", "idx", "rule", "column", F.inline(metrics)
    )


def tally(checks: DataFrame, *by: str) -> DataFrame:
    """Passed, failed and the overall verdict; no checks is no pass."""
    return checks.groupBy(*by).agg(
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.bool_and("success"), F.lit(False)).alias("success"),
    )


def row_tags(frame: DataFrame, suite: Suite, column: str = "dq_failures") -> DataFrame:
    """Add the names of the row rules each row breaks, in suite order."""
    tags = []
    for rule in suite.rules:
        test = unexpected(rule, frame.schema)
        if test is not None:
            tags.append(F.when(test, F.lit(f"{rule.kind}:{rule.column}")))
    return frame.withColumn(column, F.array_compact(F.array(*tags)))


def single_rule(name: str, kind: str, column: str, **settings) -> Suite:
    return Suite(name, (Rule(kind, column, **settings),))


__all__ = [
    "EXISTS",
    "NOT_NULL",
    "UNIQUE",
    "BETWEEN",
    "IN_SET",
    "OF_TYPE",
    "evaluation_parameters",
    "row_tags",
    "run_checkpoint",
    "run_suite",
    "single_rule",
    "tally",
    "unexpected",
]
