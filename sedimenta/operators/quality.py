"""Gates, quarantine, profiles and result records.

A gate is a DataFrame of violations plus a severity. Blocking gates raise; the
others are only recorded. Violations are always aggregated by key before any
join or count, so a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fn
from .scd2 import DIM_APPLICANT, DimensionSpec, current_rows

BLOCKING = frozenset({"CRITICAL", "FAIL"})

# Error numbers callers match on.
MULTIPLE_CURRENT = 51001
NO_CURRENT = 51002
BUREAU_GRAIN = 51010
INSTALMENT_GRAIN = 51011
LOAN_GRAIN = 51012


@dataclass(frozen=True)
class Gate:
    name: str
    violations: DataFrame
    severity: str = "CRITICAL"
    code: int | None = None


class GateFailure(RuntimeError):
    """Raised when a blocking gate has violations; ``failures`` maps gate name to count."""

    def __init__(self, failures: Mapping[str, int], codes: Sequence[int] = ()):
        self.failures = dict(failures)
        self.codes = list(codes)
        detail = ", ".join(f"{name}: {count} violation(s)" for name, count in self.failures.items())
        super().__init__(f"quality gate failed [{', '.join(map(str, self.codes))}] {detail}")


def gate_counts(gates: Sequence[Gate]) -> DataFrame:
    """One row per gate: name, severity, number of violating rows."""
    rows = [
        g.violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(g.name).alias("gate"), F.lit(g.severity).alias("severity"), "violations"
        )
        for g in gates
    ]
    return reduce(DataFrame.unionByName, rows)


def gate_results(gates: Sequence[Gate]) -> DataFrame:
    """Gates as check rows, for recording: no violation is expected."""
    return gate_counts(gates).select(
        F.col("gate").alias("check_name"), "severity", F.col("violations").alias("observed"),
        F.lit(0).cast("bigint").alias("expected"), (F.col("violations") == 0).alias("passed"),
    )


def enforce(gates: Sequence[Gate]) -> dict[str, int]:
    """Evaluate all gates in one job; raise if a blocking one is violated."""
    if not gates:
        return {}
    names = [g.name for g in gates]
    if repeated := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"gates need names of their own: {repeated}")
    counts = {r["gate"]: r["violations"] for r in gate_counts(gates).collect()}  # one row per gate
    failed = [g for g in gates if g.severity in BLOCKING and counts[g.name] > 0]
    if failed:
        raise GateFailure({g.name: counts[g.name] for g in failed}, [g.code for g in failed if g.code is not None])
    return counts


# --- violations -----------------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.filter(missing).select(*keys)


def multiple_current(dim: DataFrame, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Entities with more than one current version."""
    return duplicate_keys(current_rows(dim, spec), [spec.key])


def no_current(dim: DataFrame, src: DataFrame, spec: DimensionSpec = DIM_APPLICANT) -> DataFrame:
    """Source entities without a current version."""
    return (
        src.select(spec.key)
        .filter(F.col(spec.key).isNotNull())
        .distinct()
        .join(current_rows(dim, spec).select(spec.key), [spec.key], "left_anti")
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent row, with the number of child rows.

    Both sides are reduced to their distinct key values before the join, so
    neither width nor a hot value reaches it. NULL is "no reference".
    """
    references = (
        child.select(F.col(child_key).alias("key"))
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("key")).distinct()
    return references.join(parents, ["key"], "left_anti")


def sentinel_leaks(df: DataFrame, sentinels: Mapping[str, object], suffix: str = "_MASKED") -> DataFrame:
    """Rows whose masked value is the digest of a sentinel, which any reader could recompute."""
    leaked = F.lit(False)
    for column, sentinel in sentinels.items():
        if f"{column}{suffix}" in df.columns:
            leaked = leaked | F.coalesce(F.col(f"{column}{suffix}") == fn.sha256_text(F.lit(sentinel)), F.lit(False))
    return df.filter(leaked)


def fact_gates(fact: DataFrame, name: str, grain: Sequence[str], code: int) -> list[Gate]:
    return [
        Gate(f"{name}_grain", duplicate_keys(fact, grain), code=code),
        Gate(f"{name}_key_not_null", null_keys(fact, grain)),
    ]


# --- checks that record a number ------------------------------------------------------------------


def measure(df: DataFrame, checks: Mapping[str, tuple[str, Column, object]]) -> DataFrame:
    """Evaluate many scalar checks in one pass over ``df``.

    ``checks`` maps a name to (severity, aggregate, expected value). Result:
    one row per check with ``observed``, ``expected`` and ``passed``.
    """
    names = list(checks)
    totals = df.agg(*[checks[n][1].cast("bigint").alias(f"_c{i}") for i, n in enumerate(names)])
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("check_name"),
                F.lit(checks[n][0]).alias("severity"),
                F.col(f"_c{i}").alias("observed"),
                F.lit(checks[n][2]).cast("bigint").alias("expected"),
            )
            for i, n in enumerate(names)
        ]
    )
    return totals.select(F.inline(rows)).withColumn("passed", F.col("observed").eqNullSafe(F.col("expected")))


def _key_checks(keys: Sequence[str], ts: str) -> dict[str, tuple[str, Column, object]]:
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return {
        "missing_timestamps": ("CRITICAL", F.count_if(F.col(ts).isNull()), 0),
        "missing_keys": ("CRITICAL", F.count_if(missing), 0),
        "repeated_keys": ("HIGH", F.count_if(~missing) - F.count_distinct(*keys), 0),
    }


def bronze_checks(df: DataFrame, keys: Sequence[str], ts: str = "ingestion_ts",
                  expected_rows: int | None = None) -> DataFrame:
    """Row count, missing timestamps, missing keys and repeated keys, in one pass."""
    checks = _key_checks(keys, ts)
    if expected_rows is not None:
        checks["row_count"] = ("CRITICAL", F.count(F.lit(1)), expected_rows)
    return measure(df, checks)


def silver_checks(df: DataFrame, keys: Sequence[str], rules: Mapping[str, str], masked: Sequence[str] = (),
                  sentinels: Mapping[str, object] | None = None, ts: str = "ingestion_ts",
                  suffix: str = "_MASKED") -> DataFrame:
    """Keys, domain rules, raw columns and sentinel digests of a silver table, in one pass."""
    checks = _key_checks(keys, ts)
    checks.update({name: ("HIGH", F.count_if(F.expr(predicate)), 0) for name, predicate in rules.items()})
    for column in masked:
        checks[f"raw_{column}"] = ("CRITICAL", F.max(F.lit(int(column in df.columns))), 0)
        if column in (sentinels or {}):
            leaked = F.col(f"{column}{suffix}") == fn.sha256_text(F.lit(sentinels[column]))
            checks[f"sentinel_digest_{column}"] = ("CRITICAL", F.count_if(leaked), 0)
    return measure(df, checks)


def mask_checks(raw: DataFrame, masked: DataFrame, keys: Sequence[str], column: str, sentinel=None,
                suffix: str = "_MASKED") -> DataFrame:
    """Verify a masked column against its input, row by row on the key.

    Sentinels are counted on the input side: after masking there are none left
    to count. ``raw`` and ``masked`` are both unique on ``keys``.
    """
    out = f"{column}{suffix}"
    pairs = raw.select(*keys, F.col(column).alias("_raw")).join(masked.select(*keys, F.col(out).alias("_out")),
                                                                list(keys), "inner")
    is_sent = fn.is_sentinel("_raw", sentinel) if sentinel is not None else F.lit(False)
    clean = F.when(~is_sent, F.col("_raw"))
    checks = {
        "sentinels_in_minus_nulled_out": (
            "CRITICAL",
            F.count_if(is_sent) - F.count_if(is_sent & F.col("_out").isNull()),
            0,
        ),
        "masked_equals_original": ("CRITICAL", F.count_if(F.col("_out") == F.col("_raw").cast("string")), 0),
        "digest_mismatches": ("CRITICAL", F.count_if(~fn.sha256_text(clean).eqNullSafe(F.col("_out"))), 0),
        "raw_column_present": ("CRITICAL", F.max(F.lit(int(column in masked.columns))), 0),
    }
    if sentinel is not None:
        leaked = F.col("_out") == fn.sha256_text(F.lit(sentinel))
        checks["sentinel_digests"] = ("CRITICAL", F.count_if(leaked), 0)
    return measure(pairs, checks)


def enforce_checks(results: DataFrame) -> None:
    """Raise if a blocking check of ``check_results`` failed; the others stay recorded only."""
    failed = results.filter(~F.col("passed") & F.col("severity").isin(*BLOCKING)).select("table_name", "check_name", "observed", "expected")
    found = failed.collect()  # at most one row per table and check
    if found:
        raise GateFailure({f"{r['table_name']}.{r['check_name']}": abs((r["observed"] or 0) - (r["expected"] or 0)) for r in found})


def check_results(run_id: str, checks: Mapping[str, DataFrame]) -> DataFrame:
    """Rows for the ``dq_results`` table: one per check, tagged with run and table."""
    parts = [
        rows.select(
            F.lit(run_id).alias("run_id"), F.lit(table).alias("table_name"), "check_name", "severity", "observed",
            "expected", "passed",
        )
        for table, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def threshold_breaches(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``metrics(metric, value)`` against ``thresholds(metric, low, high)``; NULL bound = open.

    One row per threshold and value; a threshold whose metric is missing is breached.
    """
    value = F.col("value")
    return metrics.join(thresholds, ["metric"], "right_outer").select(
        "metric", "value", "low", "high",
        (F.coalesce(value < F.col("low"), F.lit(False)) | F.coalesce(value > F.col("high"), F.lit(False))
         | value.isNull()).alias("breached"),
    )


# --- quarantine -----------------------------------------------------------------------------------


def with_failed_rules(df: DataFrame, rules: Mapping[str, str], column: str = "failed_rules") -> DataFrame:
    """Names of the rules a row breaks. A rule is a predicate that is true for a bad row."""
    failed = [F.when(F.expr(predicate), F.lit(name)) for name, predicate in rules.items()]
    return df.withColumn(column, F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>"))


def split_quarantine(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``failed_rules``); the two are a partition of ``df``."""
    tagged = with_failed_rules(df, rules)
    bad = F.size("failed_rules") > 0
    return tagged.filter(~bad).drop("failed_rules"), tagged.filter(bad)


# --- profile --------------------------------------------------------------------------------------


def profile(df: DataFrame, columns: Sequence[str] | None = None, *, exact: bool = False) -> DataFrame:
    """Rows, nulls, null rate, completeness and distinct count per column.

    One pass with sketched distinct counts by default. ``exact`` counts
    distinct values by grouping (column, value) pairs, which costs a shuffle.
    """
    names = list(columns or df.columns)
    if not exact:
        totals = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(names)],
            *[F.approx_count_distinct(F.col(c)).alias(f"_d{i}") for i, c in enumerate(names)],
        )
        per_column = totals.select(
            "_rows",
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("_present"),
                                 F.col(f"_d{i}").alias("distinct_values"))
                        for i, c in enumerate(names)
                    ]
                )
            ),
        )
    else:
        values = df.select(
            F.inline(
                F.array(
                    *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("_value")) for c in names]
                )
            )
        )
        per_column = (
            values.groupBy("column_name", "_value")
            .agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("column_name")
            .agg(
                F.sum("_n").alias("_rows"),
                F.sum(F.when(F.col("_value").isNotNull(), F.col("_n")).otherwise(0)).alias("_present"),
                F.count("_value").alias("distinct_values"),
            )
        )
    rows, present = F.col("_rows"), F.col("_present")
    return per_column.select(
        "column_name",
        rows.alias("row_count"),
        (rows - present).alias("null_count"),
        "distinct_values",
        F.round((rows - present).cast("double") / F.nullif(rows, F.lit(0)).cast("double"), 6).alias("null_rate"),
        F.round(present.cast("double") / F.nullif(rows, F.lit(0)).cast("double"), 6).alias("completeness"),
    )
