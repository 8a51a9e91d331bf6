"""Counts and profiles that explain a reconciliation."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.domain import code_class
from tallymill.operators.first_hit import best_hits, key_profile
from tallymill.operators.lookup import NO_MONTH, NO_NUMBER, dealt_by_unit, first_reports
from tallymill.operators.reconcile import KEYS, keyed, ways_to_reports
from tallymill.plans.rules import WATERFALL, Rule

_MATCH_INPUT = [
    "INSTALACAO", "IRREGULARIDADE", "CLASSIFICACAO_IRREG", "DATA_EXECUCAO", "DATA_BAIXA",
]


def unit_profiles(reports: DataFrame) -> DataFrame:
    """Distinct known codes and classes per unit, as sorted comma-joined text.

    Values are made distinct before they are collected, so a unit's group is
    as large as its code list, not as its reports.
    """
    code = F.expr("bigint(irregularidade)")
    return (
        reports.select(F.expr("bigint(instalacao)").alias("instalacao"), code.alias("code"))
        .distinct()
        .groupBy("instalacao")
        .agg(
            F.array_sort(F.collect_set("code")).alias("codes"),
            F.array_sort(F.collect_set(code_class(F.col("code")))).alias("classes"),
        )
        .selectExpr(
            "instalacao",
            "array_join(transform(codes, c -> string(c)), ',') AS codes",
            "array_join(classes, ',') AS classes",
        )
    )


def _eligible(rule: Rule) -> str:
    month = f"_{rule.inc_month} <> {NO_MONTH}"
    if rule.by == "class":
        return month
    return f"{month} AND _code NOT IN (0, bigint('{NO_NUMBER}'))"


def rule_metrics(
    increments: DataFrame,
    reports: DataFrame,
    rules: Sequence[Rule] = WATERFALL,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Rows tried and resolved by each step of the waterfall, in one pass.

    A step tries the eligible rows that no earlier step has matched.  What a
    row comes to depends on its keys alone, so the keys are counted and walked;
    the rows themselves are not shuffled.
    """
    profile = key_profile(keyed(increments.select(_MATCH_INPUT)), KEYS, "_unit")
    firsts = dealt_by_unit(first_reports(reports.where("instalacao <> 0"), tie_breakers))
    ways = ways_to_reports(firsts, rules)
    found = best_hits(profile, ways)
    counts = []
    for step, rule in enumerate(rules, start=1):
        tried = f"coalesce(hit.step, {len(rules) + 1}) >= {step} AND {_eligible(rule)}"
        for name, test in (("tried", tried), ("resolved", f"hit.step = {step}")):
            rows = f"coalesce(sum(if({test}, _rows, 0)), 0)"
            counts.append(F.expr(rows).alias(f"{name}{step}"))
    rows = ", ".join(
        f"named_struct('step', {step}, 'rule', '{rule.id}',"
        f" 'tried', tried{step}, 'resolved', resolved{step})"
        for step, rule in enumerate(rules, start=1)
    )
    return found.agg(*counts).selectExpr(f"inline(array({rows}))")


def group_counts(result: DataFrame) -> DataFrame:
    """Rows, matched and pending rows per group."""
    return result.groupBy("GRUPO").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("MATCH_OK").alias("matched"),
        F.count_if(~F.col("MATCH_OK")).alias("pending"),
    )


def open_report_count(reports: DataFrame) -> DataFrame:
    """Reports in all, and those without a closing date (the R4/R5 base)."""
    return reports.agg(
        F.count(F.lit(1)).alias("reports"),
        F.count_if(F.col("data_baixa_rep").isNull()).alias("open_reports"),
    )
