"""Reconcile increments with reports by the rule waterfall.

No step changes a row that a later step reads, so the waterfall equals "the
first matching step wins".  The reasons for unmatched rows follow the same
pattern (same code in another month, same class, same unit) and simply are the
steps after the last rule.  Rules and reasons are thus answered together.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.operators.first_hit import Way, first_hit
from tallymill.operators.lookup import (
    NO_CLASS,
    NO_MONTH,
    NO_NUMBER,
    class_bit,
    dealt_by_unit,
    families,
    family_lookup,
    first_reports,
    hit_struct,
    unit_code_lookup,
    unit_lookup,
)
from tallymill.operators.narrow import narrowed, widened
from tallymill.plans.rules import WATERFALL, Rule
from tallymill.schema import (
    NO_MATCH,
    REASON_CODE,
    REASON_MONTH,
    REASON_NO_UNIT,
    REASON_OTHER,
    RESULT_COLUMNS,
)

# Columns that become join keys, with the value that stands for "missing".
# Keys replace their column while rows are shuffled; see _restored.
_KEYED = {
    "INSTALACAO": ("_unit", f"bigint('{NO_NUMBER}')"),
    "IRREGULARIDADE": ("_code", f"bigint('{NO_NUMBER}')"),
    "CLASSIFICACAO_IRREG": ("_class", f"'{NO_CLASS}'"),
}
_MONTHS = {"DATA_EXECUCAO": "_exec", "DATA_BAIXA": "_baixa"}
KEYS = [key for key, _ in _KEYED.values()] + list(_MONTHS.values())


def keyed(increments: DataFrame) -> DataFrame:
    kept = [f"`{c}`" for c in increments.columns if c not in _KEYED]
    keys = []
    for name, (key, missing) in _KEYED.items():
        typed = f"concat('=', {name})" if key == "_class" else f"bigint({name})"
        keys.append(f"coalesce({typed}, {missing}) AS {key}")
    for name, key in _MONTHS.items():
        keys.append(f"coalesce(year({name}) * 12 + month({name}), {NO_MONTH}) AS {key}")
    return increments.selectExpr(*kept, *keys)


def _restored(found: DataFrame) -> DataFrame:
    """The columns back under their names, with nulls where they were."""
    back = []
    for name, (key, missing) in _KEYED.items():
        value = f"nullif({key}, {missing})"
        back.append(f"{f'substring({value}, 2)' if key == '_class' else value} AS {name}")
    return found.selectExpr("*", *back)


def ways_to_reports(firsts: DataFrame, rules: Sequence[Rule]) -> list[Way]:
    """``firsts`` are ``first_reports``, made now or kept."""
    ways = [
        Way(
            family_lookup(firsts, family),
            {"unit": "_unit", "attr": f"_{family.by}", "month": f"_{family.inc_month}"},
        )
        for family in families(rules)
    ]
    n = len(rules)
    same_class = f"if(class_bits & {class_bit('_class')} <> 0, {n + 2}, {n + 3})"
    known_unit = f"if(class_bits IS NOT NULL, {hit_struct(same_class)}, null)"
    known_code = hit_struct(str(n + 1))
    ways.append(Way(unit_lookup(firsts), {"unit": "_unit"}, known_unit))
    ways.append(
        Way(unit_code_lookup(firsts, known_code), {"unit": "_unit", "attr": "_code"})
    )
    return ways


def match(
    increments: DataFrame,
    reports: DataFrame | None,
    rules: Sequence[Rule] = WATERFALL,
    tie_breakers: Sequence[str] = (),
    kept: DataFrame | None = None,
) -> DataFrame:
    """Increments with their keys and ``hit``: the step reached and its report.

    Steps up to ``len(rules)`` are rules; the next three mean that the report
    table knows the unit with this code, with this class, or at all.

    Unit 0 stands for a missing or unreadable unit, and cleaned reports never
    have it.  Such increments have no hit and are not shuffled.

    ``kept`` are the first reports of a kept table, in place of ``reports``.
    """
    facts = keyed(increments)
    nowhere = f"_unit IN (0, {_KEYED['INSTALACAO'][1]})"
    dealt_by = "_unit" if kept is None else None  # kept ones lie in buckets of their own
    if kept is None:
        kept = dealt_by_unit(first_reports(reports.where("instalacao <> 0"), tie_breakers))
    ways = ways_to_reports(kept, rules)
    found = first_hit(narrowed(facts.where(f"NOT {nowhere}")), KEYS, ways, dealt_by)
    found = widened(found, facts)
    missed = facts.where(nowhere).withColumn("hit", F.lit(None).cast(found.schema["hit"].dataType))
    return _restored(found.unionByName(missed))


def reconcile(
    increments: DataFrame,
    reports: DataFrame | None,
    rules: Sequence[Rule] = WATERFALL,
    tie_breakers: Sequence[str] = (),
    kept: DataFrame | None = None,
) -> DataFrame:
    """All increments, matched or not, with team, rule and pending reason.

    A match fills the execution date where it was missing and the code where it
    was 0, both from the winning report; class and months stay as they were.
    One report may serve many increments.  See ``match`` for ``kept``.
    """
    found = match(increments, reports, rules, tie_breakers, kept)
    n = len(rules)
    matched = f"coalesce(hit.step <= {n}, false)"
    ids = ", ".join(f"'{r.id}'" for r in rules)
    reasons = (
        f"WHEN hit.step = {n + 1} THEN '{REASON_MONTH}'"
        f" WHEN hit.step = {n + 2} THEN '{REASON_CODE}'"
        f" WHEN hit.step = {n + 3} THEN '{REASON_OTHER}' ELSE '{REASON_NO_UNIT}'"
    )
    enriched = found.withColumns(
        {
            "MATCH_OK": F.expr(matched),
            # Not coalesce(array(...)[...], ...): Spark takes an element of an
            # array without nulls for non-null, even at a null index.
            "REGRA_ORIGEM": F.expr(
                f"if({matched}, element_at(array({ids}), hit.step), '{NO_MATCH}')"
            ),
            "MOTIVO_PENDENCIA": F.expr(
                f"CASE WHEN {matched} THEN string(null) {reasons} END"
            ),
            "EQUIPE": F.expr("hit.equipe"),
            "DATA_EXECUCAO": F.expr("coalesce(DATA_EXECUCAO, hit.data_exec_rep)"),
            "IRREGULARIDADE": F.expr(
                f"if({matched} AND IRREGULARIDADE = 0, hit.irregularidade, IRREGULARIDADE)"
            ),
        }
    )
    return final_projection(enriched)


def final_projection(df: DataFrame) -> DataFrame:
    """The result's column order, keeping what is there; working columns go."""
    return df.select([c for c in RESULT_COLUMNS if c in df.columns])
