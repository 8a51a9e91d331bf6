"""What the reports offer to the rules: one row per key a rule can ask for."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.domain import code_class, month_number
from tallymill.plans.rules import Rule
from tallymill.schema import CODE_CLASS, EXEC_TIME

# Key values that stand for "missing"; no real value equals them.
NO_NUMBER = -(2**63)
NO_MONTH = -1
NO_CLASS = ""  # a class that is there has a mark before it, see class_key

# There are few classes, so the classes of a unit fit the bits of a number.
_CLASSES = sorted(set(CODE_CLASS.values()))


@dataclass(frozen=True)
class Family:
    """Rules that ask with the same key of the increment share one lookup key."""

    by: str
    inc_month: str
    null_safe: bool
    steps: tuple[tuple[int, Rule], ...]


def families(rules: Sequence[Rule]) -> list[Family]:
    grouped: dict[tuple, list] = {}
    for step, rule in enumerate(rules, start=1):
        key = (rule.by, rule.inc_month, rule.null_safe)
        grouped.setdefault(key, []).append((step, rule))
    return [Family(*key, tuple(steps)) for key, steps in grouped.items()]


def keep_first_order(reports: DataFrame, tie_breakers: Sequence[str] = ()) -> list[Column]:
    """Ascending sort keys: newest execution first, dateless last, then ties.

    Where the time of execution is known it counts, not the day alone.  Without
    tie-breakers the remaining columns decide, so equal times give the same
    winner in every run; of rows that differ in the team only, one with a team
    is first.
    """
    order = ["data_exec_rep IS NULL", "-unix_date(data_exec_rep)"]
    if EXEC_TIME in reports.columns:
        seconds = f"extract(SECOND FROM {EXEC_TIME})"
        order.append(f"-(hour({EXEC_TIME}) * 3600 + minute({EXEC_TIME}) * 60 + {seconds})")
    ties = tie_breakers or [
        "data_baixa_rep IS NULL",
        "-unix_date(data_baixa_rep)",
        "irregularidade",
        "equipe IS NULL",
        "equipe",
    ]
    return [F.expr(c) for c in (*order, *ties)]


def keep_first(
    reports: DataFrame, keys: Sequence[str], tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """First report per key; a missing key is a key like any other.

    Spark limits each group on the map side before shuffling, so a hot key
    sends one row per task.
    """
    order = [c.asc_nulls_first() for c in keep_first_order(reports, tie_breakers)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        reports.withColumn("_rank", F.row_number().over(window))
        .where("_rank = 1")
        .drop("_rank")
    )


def first_reports(reports: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """First report per unit, code, execution month and closing month.

    All that a rule looks at is a function of these four, so no other report
    can be the first of any rule's key.  Copies and hot units shrink here, on
    the map side, before reports are unfolded.
    """
    order = [c.alias(f"o{i}") for i, c in enumerate(keep_first_order(reports, tie_breakers))]
    return (
        reports.withColumn("irregularidade", F.expr("bigint(irregularidade)"))
        .select(
            F.expr("bigint(instalacao)").alias("unit"),
            F.col("irregularidade").alias("code"),
            month_number(F.col("data_exec_rep")).alias("exec_month"),
            month_number(F.col("data_baixa_rep")).alias("baixa_month"),
            F.struct(*order, "equipe", "data_exec_rep", "irregularidade").alias("report"),
        )
        .groupBy("unit", "code", "exec_month", "baixa_month")
        .agg(F.min("report").alias("report"))
        # The code itself, as there always is a report.  Written like this, no
        # lookup's filter or column list sinks below the shuffle, so all lookups
        # read one shuffle of the reports instead of scanning them again each.
        .withColumn("code", F.expr("if(report IS NULL, null, code)"))
    )


def dealt_by_unit(firsts: DataFrame) -> DataFrame:
    """``first_reports``, all of a unit in one partition.

    Every lookup key begins with the unit, so the lookups made of it, and joins of them
    with keys that are dealt by unit as well, need no shuffle of their own.  A unit's
    reports are few by now: one per code and months.
    """
    # The code itself, as there always is a report.  An expression that is not
    # deterministic and reads all columns keeps every lookup's filter and column list above
    # the shuffle, so all read the same one.
    code = "if(report IS NULL, exec_month + baixa_month + bigint(rand()), code)"
    return firsts.repartition("unit").withColumn("code", F.expr(code))


def hit_struct(step: str, equipe="string(null)", day="date(null)", code="bigint(null)"):
    """SQL of a hit: its step and what a match takes from the report."""
    return (
        f"named_struct('step', {step}, 'equipe', {equipe},"
        f" 'data_exec_rep', {day}, 'irregularidade', {code})"
    )


def family_lookup(reports: DataFrame, family: Family) -> DataFrame:
    """Per unit, code or class, and month: the hit that the family's rules give.

    ``reports`` are ``first_reports``.  A report is unfolded into the months it
    answers for.  One grouped ``min`` per rule keeps the first report of its
    key (before the team is looked at: a first report without a team hides
    later ones); the first rule whose report has a team gives the ``hit``.
    """
    months = list(dict.fromkeys((r.rep_month, r.lag) for _, r in family.steps))
    entries = []
    for part, (month, lag) in enumerate(months):
        rivals = [r for _, r in family.steps if (r.rep_month, r.lag) == (month, lag)]
        at = f"{month}_month + {lag}"
        if all(r.open_only for r in rivals):
            at = f"if(open, {at}, null)"
        entries.append(f"named_struct('part', {part}, 'month', {at})")

    firsts, hits = [], ""
    for step, rule in family.steps:
        accepted = f"part = {months.index((rule.rep_month, rule.lag))}"
        if rule.open_only:
            accepted += " AND open"
        firsts.append(F.expr(f"min(if({accepted}, report, null)) AS first{step}"))
        hit = hit_struct(
            str(step),
            f"first{step}.equipe",
            f"first{step}.data_exec_rep",
            f"first{step}.irregularidade",
        )
        hits += f" WHEN first{step}.equipe IS NOT NULL THEN {hit}"

    by_code = family.by == "code"
    attr = F.expr("nullif(code, 0)") if by_code else class_key(code_class(F.col("code")))
    if family.null_safe:
        attr = F.coalesce(attr, F.lit(NO_CLASS))
    return (
        reports.withColumns({"attr": attr, "open": F.expr("baixa_month IS NULL")})
        .where("attr IS NOT NULL")
        .selectExpr(
            "unit",
            "attr",
            "report",
            "open",
            f"inline(array({', '.join(entries)}))",
        )
        .where("month IS NOT NULL")
        .groupBy("unit", "attr", "month")
        .agg(*firsts)
        .selectExpr("unit", "attr", "month", f"CASE{hits} END AS hit")
        .where("hit IS NOT NULL")
    )


def class_key(cls: Column) -> Column:
    """A class as a key: marked, so that no text equals the missing one."""
    return F.concat(F.lit("="), cls)


def class_bit(key: str) -> str:
    """SQL of the bit of a class key, 0 for any other text."""
    whens = " ".join(f"WHEN '={c}' THEN {1 << i}" for i, c in enumerate(_CLASSES))
    return f"CASE {key} {whens} ELSE 0 END"


def unit_lookup(firsts: DataFrame) -> DataFrame:
    """Units of the report table, and the classes each has in any month.

    ``firsts`` are ``first_reports``, which hold every unit and code.
    """
    return (
        firsts.select("unit", class_key(code_class(F.col("code"))).alias("class"))
        .groupBy("unit")
        .agg(F.expr(f"bit_or({class_bit('class')}) AS class_bits"))
    )


def unit_code_lookup(firsts: DataFrame, hit: str) -> DataFrame:
    """Units and the codes each has in any month, with a fixed ``hit``."""
    return (
        firsts.selectExpr("unit", "code AS attr")
        .where("attr IS NOT NULL")
        .distinct()
        .selectExpr("unit", "attr", f"{hit} AS hit")
    )
