"""Expectations: drop rules, warn rules and their per-rule metrics.

All rules of a set are evaluated in one projection; metrics come from one
aggregate pass (``count_if`` per rule), unpivoted to one row per rule, so
their cost is one scan regardless of the number of rules. In streams and on
pipeline writes the same counts ride along with ``observe`` (no extra scan).
Observed counts are monitoring figures: a stage re-run after a lost executor
may count some rows twice. ``rule_metrics`` is the exact, auditable form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.rules import RuleSet

METRIC_SCHEMA = "dataset STRING, rule_name STRING, action STRING, passed_records BIGINT, failed_records BIGINT"


def all_pass(rules) -> Column:
    """TRUE iff every rule is TRUE, never NULL (one expression for the whole set)."""
    rules = list(rules)
    return F.expr(" AND ".join(r.passed_sql for r in rules)) if rules else F.lit(True)


def apply_rules(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Keep rows that satisfy every drop rule (warn rules keep everything)."""
    drops = rules.drop_rules
    # A plain conjunction: a filter drops NULL like FALSE, and bare predicates
    # can be pushed into the scan, which coalesce() would prevent.
    return df.filter(" AND ".join(f"({r.predicate})" for r in drops)) if drops else df


def rule_count_exprs(rules: RuleSet) -> list[Column]:
    """``p<i>`` = rows passing rule i, ``n`` = all rows."""
    return [F.count_if(r.passed()).alias(f"p{i}") for i, r in enumerate(rules)] + \
        [F.count(F.lit(1)).alias("n")]


def rule_metrics(df: DataFrame, rules: RuleSet, dataset: str | None = None) -> DataFrame:
    """One row per rule: passed and failed record counts over ``df``
    (``passed + failed`` = rows of ``df``)."""
    name = dataset or rules.dataset
    counts = df.agg(*rule_count_exprs(rules))
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("dataset"), F.lit(r.name).alias("rule_name"),
                 F.lit(r.action).alias("action"),
                 F.col(f"p{i}").alias("passed_records"),
                 (F.col("n") - F.col(f"p{i}")).alias("failed_records"))
        for i, r in enumerate(rules)])
    return counts.select(F.inline(per_rule))


KEPT = "_tripflow_kept"


def flagged(df: DataFrame, rules: RuleSet) -> DataFrame:
    """All rows, those that pass every drop rule flagged as ``KEPT``."""
    return df.withColumn(KEPT, all_pass(rules.drop_rules))


def committed_metrics(every: list[DataFrame], rules: RuleSet, dataset: str | None = None) -> list[dict]:
    """Per-rule counts of rows as they were committed, the dropped ones included: a task
    or stage that ran twice, whose output was committed once, counts once."""
    total = {r.name: [0, 0] for r in rules}
    for rows in every:
        for m in rule_metrics(rows, rules).collect():  # a row per rule
            total[m.rule_name][0] += m.passed_records
            total[m.rule_name][1] += m.failed_records
    return [{"dataset": dataset or rules.dataset, "rule_name": r.name, "action": r.action,
             "passed_records": total[r.name][0], "failed_records": total[r.name][1]} for r in rules]


def observe_rules(df: DataFrame, rules: RuleSet, name: str) -> DataFrame:
    """Attach per-rule pass counts as observed metrics (batch or stream).

    Read them back from ``StreamingQueryProgress.observedMetrics[name]``
    (summed over micro-batches) or from an ``Observation``.
    """
    return df.observe(name, *rule_count_exprs(rules))


def metrics_from_observed(observed: dict, rules: RuleSet, dataset: str | None = None) -> list[dict]:
    """Turn observed ``{p0.., n}`` counts into per-rule metric dicts."""
    n = int(observed.get("n", 0) or 0)
    out = []
    for i, r in enumerate(rules):
        p = int(observed.get(f"p{i}", 0) or 0)
        out.append({"dataset": dataset or rules.dataset, "rule_name": r.name, "action": r.action,
                    "passed_records": p, "failed_records": n - p})
    return out
